"""Exchange envelopes (exchange, received_at, body as JSON) to tick rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quote currencies of unseparated symbols, longest first where one ends in another.
QUOTES = ["USDT", "USDC", "BUSD", "TUSD", "USD", "BTC", "ETH", "EUR", "DAI"]


def canonical_symbol(exchange: Column, raw: Column) -> Column:
    """``BASEQUOTE`` becomes ``BASE-QUOTE`` with a non-empty base; others are upper-cased."""
    upper = F.upper(raw)
    return F.when(upper.contains("-"), upper).otherwise(F.regexp_replace(upper, rf"^(.+?)({'|'.join(QUOTES)})$", "$1-$2"))


def side_of(raw: Column) -> Column:
    """bid, Buy and buy are buys; ask, Sell and sell are sells."""
    low = F.lower(raw)
    return F.when(low.isin("bid", "buy", "b"), "buy").when(low.isin("ask", "sell", "a"), "sell")


def from_millis(c: Column) -> Column:
    return F.timestamp_millis(c.cast("long"))


TICK = ["exchange", "symbol", "seq", "msg_seq_start", "msg_seq_end", "ts", "msg_type", "event_type", "side", "price_str", "size_str", "price", "size"]


def _shaped(df: DataFrame) -> DataFrame:
    d = df.withColumn("price", F.expr("try_cast(price_str as double)")).withColumn("size", F.expr("try_cast(size_str as double)"))
    return d.select(*[F.col(c) if c in d.columns else F.lit(None).cast("long").alias(c) for c in TICK])


def normalize_bybit_book(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Level rows, and the bad rows (unreadable body, or a level without a price) with their reason."""
    shape = "topic string, type string, ts long, data struct<s:string, b:array<array<string>>, a:array<array<string>>, u:long>"
    r = raw.where("exchange = 'bybit'").withColumn("m", F.from_json("body", shape))
    bad = r.where("m is null or m.topic is null").select("exchange", "body", F.lit("unreadable").alias("reason"))

    def side(name: str, as_side: str) -> DataFrame:
        return r.select("exchange", "body", "m", F.explode(F.col("m.data")[name]).alias("level"), F.lit(as_side).alias("side"))

    levels = side("b", "buy").unionByName(side("a", "sell")).withColumn("price_str", F.get("level", F.lit(0))).withColumn("size_str", F.get("level", F.lit(1)))
    empty = F.col("price_str").isNull() | (F.col("price_str") == "")
    bad = bad.unionByName(levels.where(empty).select("exchange", "body", F.lit("empty price").alias("reason")))
    good = levels.where(~empty).select(
        "exchange", canonical_symbol(F.col("exchange"), F.substring_index("m.topic", ".", -1)).alias("symbol"), F.col("m.data.u").alias("seq"), F.col("m.data.u").alias("msg_seq_start"), F.col("m.data.u").alias("msg_seq_end"), from_millis(F.col("m.ts")).alias("ts"),
        F.when(F.col("m.type") == "snapshot", "snapshot").otherwise("tick").alias("msg_type"), F.when(F.col("m.type") == "snapshot", "snapshot").otherwise("update").alias("event_type"), "side", "price_str", "size_str",
    )
    return _shaped(good), bad


def normalize_bybit_trades(raw: DataFrame) -> DataFrame:
    """Every trade of a message; no sequence."""
    shape = "topic string, data array<struct<T:long, p:string, v:string, S:string, i:string>>"
    r = raw.where("exchange = 'bybit'").withColumn("m", F.from_json("body", shape))
    t = r.select("exchange", F.col("m.topic").alias("topic"), F.posexplode("m.data").alias("nth", "t"))
    out = t.select("exchange", canonical_symbol(F.col("exchange"), F.substring_index("topic", ".", -1)).alias("symbol"), F.lit(None).cast("long").alias("seq"), from_millis(F.col("t.T")).alias("ts"), F.lit("tick").alias("msg_type"), F.lit("trade").alias("event_type"), side_of(F.col("t.S")).alias("side"), F.col("t.p").alias("price_str"), F.col("t.v").alias("size_str"))
    return _shaped(out)


def normalize_kucoin_book(raw: DataFrame) -> DataFrame:
    """[price, size, sequence] tuples, sequence a number or a text; only the first level of a message carries its start."""
    shape = "topic string, data struct<sequenceStart:long, sequenceEnd:long, time:long, changes:struct<bids:array<array<string>>, asks:array<array<string>>>>"
    r = raw.where("exchange = 'kucoin'").withColumn("m", F.from_json("body", shape))

    def levels(name: str, side: str) -> Column:
        own = F.coalesce(F.col("m.data.changes")[name], F.array().cast("array<array<string>>"))
        return F.transform(own, lambda x: F.struct(F.lit(side).alias("side"), x.alias("x")))

    bids, asks = levels("bids", "buy"), levels("asks", "sell")
    t = r.select("exchange", "m", F.posexplode(F.concat(bids, asks)).alias("nth", "l"))
    return _shaped(t.select(
        "exchange", canonical_symbol(F.col("exchange"), F.substring_index("m.topic", ":", -1)).alias("symbol"), F.expr("try_cast(l.x[2] as bigint)").alias("seq"), F.when(F.col("nth") == 0, F.col("m.data.sequenceStart")).alias("msg_seq_start"), F.col("m.data.sequenceEnd").alias("msg_seq_end"),
        from_millis(F.col("m.data.time")).alias("ts"), F.lit("tick").alias("msg_type"), F.lit("update").alias("event_type"), F.col("l.side").alias("side"), F.get("l.x", F.lit(0)).alias("price_str"), F.get("l.x", F.lit(1)).alias("size_str"),
    ))


def normalize_kucoin_trades(raw: DataFrame) -> DataFrame:
    """Nanosecond times as text."""
    shape = "topic string, data struct<sequence:string, price:string, size:string, side:string, time:string, symbol:string, tradeId:string>"
    r = raw.where("exchange = 'kucoin'").withColumn("m", F.from_json("body", shape))
    d = "m.data."
    return _shaped(r.select("exchange", canonical_symbol(F.col("exchange"), F.col(d + "symbol")).alias("symbol"), F.expr("try_cast(m.data.sequence as bigint)").alias("seq"), F.timestamp_micros(F.expr("try_cast(m.data.time as bigint) div 1000")).alias("ts"), F.lit("tick").alias("msg_type"), F.lit("trade").alias("event_type"), side_of(F.col(d + "side")).alias("side"), F.col(d + "price").alias("price_str"), F.col(d + "size").alias("size_str")))


def decode_messages(raw: DataFrame) -> DataFrame:
    """Text fields of the unified stream; level 0 is a trade, 1 an update; an unknown type is flagged; unreadable integers are 0."""
    def whole(name: str) -> Column:
        return F.coalesce(F.expr(f"try_cast({name} as bigint)"), F.lit(0).cast("long"))

    known = F.col("type").isin("tick", "gap", "snapshot")
    return raw.select(
        "exchange", "symbol", F.when(known, F.col("type")).alias("msg_type"), (~F.coalesce(known, F.lit(False))).alias("unknown"), F.when(F.col("type") == "tick", F.when(whole("level") == 0, "trade").otherwise("update")).when(F.col("type") == "snapshot", "snapshot").alias("event_type"),
        whole("seq").alias("seq"), F.timestamp_micros(F.expr("coalesce(try_cast(ts_ns as bigint), 0) div 1000")).alias("ts"), side_of(F.col("side")).alias("side"), F.col("price").alias("price_str"), F.col("size").alias("size_str"),
    )


def clean_messages(df: DataFrame) -> DataFrame:
    """Trades of size 0 go; of rows that repeat a message id within its second, the first stays."""
    zero = (F.col("event_type") == "trade") & (F.coalesce("size", F.lit(0.0)) <= 0)
    return df.where(~F.coalesce(zero, F.lit(False))).withColumn("second", F.unix_seconds("ts")).dropDuplicates(["exchange", "symbol", "ingest_id", "second"]).drop("second")


def normalize_funding(raw: DataFrame) -> DataFrame:
    """Rate and next funding time; KuCoin gives a time point and a granularity in ms."""
    shape = "symbol string, fundingRate string, nextFundingTime long, value string, timePoint long, granularity long, ts long"
    m = raw.withColumn("m", F.from_json("body", shape))
    ku = F.col("exchange") == "kucoin"
    rate = F.expr("try_cast(coalesce(m.value, m.fundingRate) as double)")
    nxt = F.when(ku, F.col("m.timePoint") + F.col("m.granularity")).otherwise(F.col("m.nextFundingTime"))
    return m.select("exchange", canonical_symbol(F.col("exchange"), F.col("m.symbol")).alias("symbol"), from_millis(F.col("m.ts")).alias("ts"), rate.alias("funding_rate"), from_millis(nxt).alias("next_funding_ts"))
