"""Ticks, fills and bars from the star-schema tables ``events``, ``orders`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.core import KEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


def ticks_of(events: DataFrame) -> DataFrame:
    """Unified stream rows: msg_type tick, gap or snapshot; event_type trade, update or snapshot."""
    e = events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    error = F.col("event_type") == "error"
    gap, snap = error & (F.col("event_id") % 10 == 0), error & (F.col("event_id") % 10 == 5)
    trade = F.col("event_type").isin("purchase", "click", "view")
    buy = F.col("event_id") % 2 == 0
    price = F.when(trade, F.round(F.col("value") / 5) * 5 + 100).when(buy, 100 - F.col("k") % 10).otherwise(101 + F.col("k") % 10).cast("double")
    real = ~gap & ~snap
    return e.select(
        F.when(F.col("user_id") % 2 == 0, "kucoin").otherwise("bybit").alias("exchange"),
        F.concat(F.lit("S"), (F.floor(F.col("user_id") / 2) % 2).cast("string")).alias("symbol"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(gap, "gap").when(snap, "snapshot").otherwise("tick").alias("msg_type"),
        F.when(snap, "snapshot").when(trade, "trade").when(real, "update").alias("event_type"),
        F.when(real, F.when(buy, "buy").otherwise("sell")).alias("side"),
        F.when(real, price).alias("price"),
        F.when(real, F.col("k").cast("double")).alias("size"),
        F.when(real, price.cast("long").cast("string")).alias("price_str"),
        F.when(real, F.col("k").cast("string")).alias("size_str"),
        F.when(gap, F.col("event_id") - 1 - F.col("k")).alias("seq_before"),
        F.when(gap, F.col("event_id")).alias("seq_after"),
        F.when(gap, F.when(F.col("k") % 3 == 0, "internal_merge_error").when(F.col("k") % 3 == 1, "sequence_gap").otherwise("stream_disconnect")).alias("gap_cause"),
        F.col("event_id").alias("ingest_id"),
    )


def trades(t: DataFrame) -> DataFrame:
    """Trades of positive size."""
    return t.where("msg_type = 'tick' and event_type = 'trade' and size > 0 and price is not null")


def updates(t: DataFrame) -> DataFrame:
    return t.where("msg_type = 'tick' and event_type = 'update'")


def gaps(t: DataFrame) -> DataFrame:
    return t.where("msg_type = 'gap'").select(*KEY, "seq", "ts", "seq_before", "seq_after", "gap_cause")


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fill per line of an order; (ts, fill_seq) is a total order up to equal rows."""
    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    buy = F.col("l_linenumber") % 2 == 1
    return line.join(o.hint("shuffle_hash"), line["l_orderkey"] == o["o_orderkey"]).select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("o_orderpriority").alias("strategy"),
        F.when(F.col("l_suppkey") % 2 == 0, "kucoin").otherwise("bybit").alias("exchange"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 20).cast("string")).alias("symbol"),
        F.when(buy, "buy").otherwise("sell").alias("side"),
        F.when(F.col("l_returnflag") == "R", "rejected").when(F.col("l_returnflag") == "A", "placed").otherwise("filled").alias("status"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("size"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount") / 10)).alias("limit_price"),
        F.when(F.col("l_linestatus") == "O", F.lit(True)).otherwise(F.lit(False)).alias("paper"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("seq"),
    )
