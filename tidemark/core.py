"""Names, bar lengths and small column helpers that all operators share.

Order inside a key is (ts, seq). Bars are cut in event time, weeks start on Monday 00:00 UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["exchange", "symbol"]
#: Bar lengths in seconds.
TIMEFRAMES = {"1s": 1, "5s": 5, "10s": 10, "15s": 15, "30s": 30, "1m": 60, "2m": 120, "3m": 180, "5m": 300, "10m": 600, "15m": 900, "30m": 1800, "1h": 3600, "2h": 7200, "4h": 14400, "6h": 21600, "8h": 28800, "12h": 43200, "1d": 86400, "1w": 604800}
CASCADE = ["1m", "5m", "15m", "1h", "4h", "1d", "1w"]
#: Rows of a key that one task windows at a time (``in_blocks``).
BLOCK = 100_000
#: The first Monday after the epoch.
MONDAY = 4 * 86400


def seconds(tf: str) -> int:
    return TIMEFRAMES[tf]


def bucket(ts: Column, tf: str) -> Column:
    """Open time of the bar of length ``tf`` that holds ``ts``."""
    width = TIMEFRAMES[tf]
    s = F.unix_seconds(ts)
    start = MONDAY if tf == "1w" else 0
    return F.timestamp_seconds(s - F.pmod(s - start, F.lit(width)))


def after(ts: Column, by: float) -> Column:
    """``by`` seconds later."""
    return F.timestamp_micros(F.unix_micros(ts) + int(by * 1_000_000))


def in_order(*more: str):
    """The window of one key (and ``more``) in stream order."""
    return Window.partitionBy(*KEY, *more).orderBy("ts", "seq")


def with_bar(df: DataFrame, tf: str) -> DataFrame:
    """Adds ``bar``, the open time of the row's bar."""
    return df.withColumn("bar", bucket(F.col("ts"), tf))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.when(b != 0, a / b)


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder, for plans that read them several times."""
    from tidemark.sources.io import scratch

    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def over_days(df: DataFrame, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, priors: dict[str, Column] | None = None, tops: dict[str, Column] | None = None, by: list[str] = KEY, order: tuple[str, ...] = ("ts", "seq"), ties: bool = True, time: str = "ts", unit: str = "day", stored: bool = False) -> DataFrame:
    """Adds running values in the order of each key, with a key's day as the unit of work.

    ``sums`` and ``lasts`` (non-null values) run up to the row and its ties (without ``ties``, up to the row in any order of equal ones), ``priors`` (last non-null value) and ``tops`` (maximum) up to the row before.
    ``time`` is the time that comes first in the order; ``unit`` may be longer (month) for rows that are sparse. A window over each key's days, which are few, carries the ends of days to the days after them; so no task holds a key's whole history.
    With ``stored`` the rows are written once with their days' running values, so that what they come from is computed once; else they are computed for the days' ends as well.
    """
    kinds = [(n, c, k) for k, given in enumerate((sums, lasts, priors, tops)) for n, c in (given or {}).items()]
    t = df.select("*", F.trunc(F.to_date(time), unit).alias("day_") if unit != "day" else F.to_date(time).alias("day_"), *[c.alias(f"{n}_own") for n, c, _ in kinds])
    own, where = Window.partitionBy(*by, "day_").orderBy(*order), F.struct(*order)
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    if not ties:
        own = own.rowsBetween(Window.unboundedPreceding, 0)
    days = Window.partitionBy(*by).orderBy("day_").rowsBetween(Window.unboundedPreceding, -1)
    ends, heads, now = [], [], []
    for n, _, k in kinds:
        c = F.col(f"{n}_own")
        ends.append((F.sum(c), F.max_by(c, F.when(c.isNotNull(), where)), F.max_by(c, F.when(c.isNotNull(), where)), F.max(c))[k].alias(n))
        heads.append((F.sum(n), F.last(n, ignorenulls=True), F.last(n, ignorenulls=True), F.max(n))[k].over(days).alias(f"{n}_head"))
        now.append((F.sum(c).over(own), F.last(c, ignorenulls=True).over(own), F.last(c, ignorenulls=True).over(earlier), F.max(c).over(earlier))[k].alias(f"{n}_now"))
    local = t.select(*df.columns, "day_", *[f"{n}_own" for n, _, _ in kinds] if stored else [], *now)
    if stored:
        local = t = written(local, "days")
    carried = t.groupBy(*by, "day_").agg(*ends).select(*by, "day_", *heads)
    both = local.join(written(carried, "ends") if stored else carried, [*by, "day_"], "left")

    def value(n: str, k: int) -> Column:
        head, local = F.col(f"{n}_head"), F.col(f"{n}_now")
        return (F.coalesce(head + local, head, local), F.coalesce(local, head), F.coalesce(local, head), F.greatest(head, local))[k].alias(n)

    return both.select(*df.columns, *[value(n, k) for n, _, k in kinds])


def in_blocks(df: DataFrame, back: int, fn: Callable[[DataFrame, list[str]], DataFrame], by: list[str] = KEY, order: tuple[str, ...] = ("ts",), ahead: int = 0) -> DataFrame:
    """``fn(rows, keys)`` for windows of at most ``back`` rows before and ``ahead`` rows after each row, over blocks of ``BLOCK`` rows of a key.

    Rows are numbered over days; the last ``back`` rows of a block are repeated as the head of the next one and the first ``ahead`` as the tail of the one before, so that
    every row sees what it would in its key's whole history. ``fn`` gets the keys to partition by and keeps the column ``own_``.
    """
    block = max(BLOCK, back, ahead)
    t = over_days(df, sums={"nth_": F.lit(1).cast("long")}, by=by, order=order).withColumn("nth_", F.col("nth_") - 1)
    home, place = F.floor(F.col("nth_") / block), F.col("nth_") % block
    there = F.array_compact(F.array(home, F.when(place >= block - back, home + 1), F.when((place < ahead) & (home > 0), home - 1)))
    t = t.withColumn("home_", home).withColumn("block_", F.explode(there)).withColumn("own_", F.col("home_") == F.col("block_")).drop("home_", "nth_")
    return fn(t, [*by, "block_"]).where("own_").drop("own_", "block_")


def in_chunks(df: DataFrame, by: list[str] = KEY, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Adds ``nth_`` (from 0) and ``block_``: recursions are summed up by blocks of ``BLOCK`` rows of a key, then run through each block from its own start."""
    t = over_days(df, sums={"nth_": F.lit(1).cast("long")}, by=by, order=order, ties=False)
    return t.withColumn("nth_", F.col("nth_") - 1).withColumn("block_", F.floor(F.col("nth_") / BLOCK))
