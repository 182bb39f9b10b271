"""Longer bars from shorter ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.core import CASCADE, KEY, after, bucket, seconds
from tidemark.operators.bars import fill_empty_bars

#: How a column is folded; any other keeps its last value.
FOLD = {
    "sum": ["volume", "quote_volume", "trade_count", "buy_volume", "sell_volume", "buy_count", "gap_count", "ofi", "ofi_l1", "bar_count"],
    "first": ["open", "mid_price_open", "best_bid_open", "best_ask_open"],
    "max": ["high", "mid_price_high", "spread_high", "max_trade_size", "max_consecutive_run"],
    "min": ["low", "mid_price_low", "spread_low"],
    "any": ["is_partial", "absorption_detected", "unfinished_top", "unfinished_bottom"],
}


def cascade_one(bars: DataFrame, tf: str) -> DataFrame:
    """F40 for one bar length."""
    b = bars.select("*", bucket(F.col("ts"), tf).alias("slot"))
    known = F.when(F.col("open").isNotNull(), F.col("ts"))
    return b.groupBy(*KEY, F.lit(tf).alias("tf"), "slot").agg(
        F.min_by("open", known).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", known).alias("close"), F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
        F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trade_count"), F.coalesce(F.sum("buy_volume"), F.lit(0.0)).alias("buy_volume"), F.coalesce(F.sum("sell_volume"), F.lit(0.0)).alias("sell_volume"),
        F.avg("spread_mean").alias("spread_mean"), F.coalesce(F.sum("gap_count"), F.lit(0)).alias("gap_count"), F.count(F.lit(1)).alias("bar_count"),
    ).withColumnRenamed("slot", "ts")


def cascade(bars: DataFrame, tfs: list[str] | None = None) -> DataFrame:
    """bars of each longer length (weeks from Monday)."""
    return reduce(DataFrame.unionByName, [cascade_one(bars, tf) for tf in tfs or CASCADE])


def open_bars(bars: DataFrame, tf: str, as_of: Column) -> DataFrame:
    """the bars of ``tf`` that have not ended at ``as_of``."""
    out = cascade_one(bars.where(F.col("ts") <= as_of), tf)
    return out.withColumn("is_complete", after(F.col("ts"), seconds(tf)) <= as_of).where("not is_complete")


def completeness(bars: DataFrame, base: str, tf: str, as_of: Column) -> DataFrame:
    """base bars found against expected ones between each bar's open and its end or ``as_of``."""
    b = bars.where(F.col("ts") < as_of).select(*KEY, bucket(F.col("ts"), tf).alias("slot"), "ts")
    found = b.groupBy(*KEY, "slot").agg(F.countDistinct("ts").alias("found"))
    end = F.least(F.unix_seconds("slot") + seconds(tf), F.unix_seconds(as_of))
    expected = F.ceil((end - F.unix_seconds("slot")) / seconds(base))
    return found.select(*KEY, F.col("slot").alias("ts"), "found", expected.alias("expected"), (F.col("found") / expected).alias("completeness"))


def resample(bars: DataFrame, tf: str, as_of: Column | None = None) -> DataFrame:
    """fold every column by its class; first and last skip nulls and the sum of none is 0. Windows that end after ``as_of`` are dropped."""
    kind = {c: k for k, names in FOLD.items() for c in names}
    b = bars.select("*", bucket(F.col("ts"), tf).alias("slot"))
    aggs = []
    for c in bars.columns:
        if c in (*KEY, "ts", "tf"):
            continue
        at = F.when(F.col(c).isNotNull(), F.col("ts"))
        fold = {"sum": lambda c=c: F.coalesce(F.sum(c), F.lit(0)), "first": lambda c=c, at=at: F.min_by(c, at), "max": lambda c=c: F.max(c), "min": lambda c=c: F.min(c), "any": lambda c=c: F.coalesce(F.bool_or(c), F.lit(False))}
        aggs.append(fold.get(kind.get(c), lambda c=c, at=at: F.max_by(c, at))().alias(c))
    out = b.groupBy(*KEY, "slot").agg(*aggs).withColumnRenamed("slot", "ts")
    return out if as_of is None else out.where(after(F.col("ts"), seconds(tf)) <= as_of)


def resample_spine(bars: DataFrame, tf: str, as_of: Column | None = None) -> DataFrame:
    """as ``resample``, with empty windows between a key's first and last (sums 0, the rest null)."""
    out = fill_empty_bars(resample(bars, tf, as_of), tf)
    return out.fillna(0, [c for c in FOLD["sum"] if c in out.columns])
