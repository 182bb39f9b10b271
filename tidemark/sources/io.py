"""Reads, sinks, upserts, retention and exports over Parquet tables partitioned by key and date."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, TIMEFRAMES, after

PARTITION = [*KEY, "date"]
#: Days that bars are kept.
RETENTION = {"1s": 30, "1m": 365, "15m": 1825}


_OWN_ROOTS: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``). Where none is set a local session gets a temporary one of this application;
    on a cluster that is an error, as each executor would write to a disk of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="spark-")
        root = _OWN_ROOTS[app]
    return f"{root}/{name}-{uuid.uuid4().hex}"


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("ts"))


def write_ticks(df: DataFrame, path: str) -> None:
    """Ticks and gap rows by exchange and day."""
    with_date(df).write.mode("append").partitionBy("exchange", "date").parquet(path)


def write_bars(df: DataFrame, path: str, mode: str = "append") -> None:
    with_date(df).write.mode(mode).partitionBy(*PARTITION).parquet(path)


def _of(df: DataFrame, exchange: str, symbol: str) -> DataFrame:
    return df.where((F.col("exchange") == exchange) & (F.col("symbol") == symbol))


def read_bars(spark: SparkSession, path: str, exchange: str, symbol: str, start: Column, end: Column) -> DataFrame:
    """Ascending bars of a key in [start, end); the dates prune partitions."""
    b = _of(spark.read.parquet(path), exchange, symbol)
    return b.where(F.col("date").between(F.to_date(start), F.to_date(end))).where((F.col("ts") >= start) & (F.col("ts") < end)).orderBy("ts")


def read_day(spark: SparkSession, path: str, exchange: str, symbol: str, day: str) -> DataFrame:
    """S09."""
    return _of(spark.read.parquet(path), exchange, symbol).where(F.col("date") == F.lit(day).cast("date"))


def read_features(spark: SparkSession, path: str, exchange: str, symbol: str, first: str, last: str) -> DataFrame:
    """Days from ``first`` to ``last``, both included."""
    return _of(spark.read.parquet(path), exchange, symbol).where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def latest_rows(df: DataFrame, by: list[str], version: str) -> DataFrame:
    """The row of each key with the largest version."""
    w = Window.partitionBy(*by).orderBy(F.desc(version))
    return df.withColumn("back", F.row_number().over(w)).where("back = 1").drop("back")


def upsert_bars(spark: SparkSession, path: str, new: DataFrame, version: str = "version") -> None:
    """Rows of ``new`` replace those of the same (key, ts); only the touched partitions are rewritten, from a staged copy."""
    new = with_date(new)
    touched = new.select(*PARTITION).distinct()
    try:
        old = spark.read.parquet(path).join(touched, PARTITION, "left_semi")
        merged = latest_rows(old.unionByName(new, allowMissingColumns=True), [*KEY, "ts"], version)
    except Exception as e:  # noqa: BLE001  no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        merged = latest_rows(new, [*KEY, "ts"], version)
    stage = scratch(spark, "upsert")
    merged.write.parquet(stage)  # the old files are read before they are replaced
    spark.read.schema(merged.schema).parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(path)


def upsert_sink(path: str, version: str | None = None):
    """S12 for ``foreachBatch``: rows replace those of the same (key, ts) if their ``version`` is higher, or equal and their batch is not older; without ``version`` the batch alone decides.

    The table keeps each row's ``batch``, so a batch that is given again, after a failure or from a checkpoint that knows less, changes nothing. Rows of one batch that tie are told apart by their content.
    """
    def put(rows: DataFrame, number: int) -> None:
        if rows.isEmpty():
            return
        b = rows.withColumn("batch", F.lit(number).cast("long"))
        rank = F.struct(*([version] if version else []), "batch", F.xxhash64(*rows.columns).alias("content"))
        upsert_bars(rows.sparkSession, path, b.withColumn("rank_", rank), "rank_")

    return put


def upsert_stream(bars: DataFrame, path: str, checkpoint: str, version: str | None = None):
    """S12 as a sink: a query that upserts what its source has now into the table under ``path``; started again from its checkpoint it goes on where it was."""
    return bars.writeStream.foreachBatch(upsert_sink(path, version)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_bars(bars: DataFrame, tf: str, as_of: Column) -> DataFrame:
    """Bars inside the retention of their length; a filter on dates."""
    return with_date(bars).where(F.col("date") >= F.date_sub(F.to_date(as_of), RETENTION[tf])).drop("date")


def expire_bars(spark: SparkSession, path: str, tf: str, as_of: Column) -> int:
    """Deletes the date folders beyond retention through the table's file system; returns how many."""
    old = spark.read.parquet(path).where(F.col("date") < F.date_sub(F.to_date(as_of), RETENTION[tf])).select(*PARTITION).distinct().collect()  # days, not rows
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for r in old:
        at = hadoop(f"{path}/exchange={r['exchange']}/symbol={r['symbol']}/date={r['date']}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(old)


def export_day(bars: DataFrame, day: str, path: str) -> int:
    """One UTC day as ``date=D`` in zstd; an empty day writes nothing. Returns the rows."""
    d = with_date(bars).where(F.col("date") == F.lit(day).cast("date"))
    n = d.count()
    if n:
        d.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    return n


def missing_export_days(manifest: DataFrame, today: Column) -> DataFrame:
    """Days from the manifest's first up to the day before ``today`` without a success."""
    span = manifest.agg(F.min("day").alias("a"))
    days = span.select(F.explode(F.sequence("a", F.date_sub(today, 1))).alias("day"))
    return days.join(manifest.where("success").select("day").distinct(), "day", "left_anti")


def append_manifest(rows: DataFrame, path: str) -> None:
    """S16."""
    rows.write.mode("append").parquet(path)


def export_alerts(manifest: DataFrame) -> DataFrame:
    """Failed exports, the error cut to 512 characters."""
    return manifest.where("not success").select("day", F.lit("export_failed").alias("alert_type"), F.substring("error", 1, 512).alias("detail"))


def bar_feed(bars: DataFrame, as_of: Column, tf: str) -> DataFrame:
    """Cascade fields with ``is_complete``."""
    return bars.select(*KEY, "ts", "open", "high", "low", "close", "volume", "trade_count", (after(F.col("ts"), TIMEFRAMES[tf]) <= as_of).alias("is_complete"))


def book_feature_feed(bars: DataFrame) -> DataFrame:
    """S20."""
    return bars.select(*KEY, "ts", "best_bid", "best_ask", ((F.col("best_bid") + F.col("best_ask")) / 2).alias("mid_price"), "bid_depth_l1_close", "ask_depth_l1_close", "ofi_l1", "microprice")


def wide_bar_feed(bars: DataFrame, core: list[str], groups: list[list[str]], flags: list[str]) -> DataFrame:
    """Core numbers with 0 for null, optional groups only when complete, flags only when true, as one JSON text without nulls."""
    parts = [F.coalesce(c, F.lit(0.0)).alias(c) for c in core]
    for g in groups:
        whole = F.lit(True)
        for c in g:
            whole = whole & F.col(c).isNotNull()
        parts += [F.when(whole, F.col(c)).alias(c) for c in g]
    parts += [F.when(F.col(c), F.lit(True)).alias(c) for c in flags]
    return bars.select(*KEY, "ts", F.to_json(F.struct(*parts), {"ignoreNullFields": "true"}).alias("body"))


def write_run(metrics: DataFrame, equity: DataFrame, path: str) -> None:
    """Summary and equity rows, by month of the run."""
    month = F.date_format("run_at", "yyyy-MM")
    metrics.withColumn("month", month).write.mode("append").partitionBy("month").parquet(f"{path}/runs")
    equity.withColumn("month", month).write.mode("append").partitionBy("month").parquet(f"{path}/equity")
