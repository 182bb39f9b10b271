"""Profiles and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, ratio


def volume_levels(bars: DataFrame, buckets: int = 100, floor: float = 0.01) -> DataFrame:
    """Volume by price bucket of width ``max(range / buckets, floor)`` over closes, per key, with its share, rank by volume and whether it lies in the top-volume 70 % area."""
    b = bars.where("close is not null and volume is not null")
    ends = b.groupBy(*KEY).agg(F.min("low").alias("lo"), F.max("high").alias("hi"))
    width = F.greatest((F.col("hi") - F.col("lo")) / buckets, F.lit(floor))
    x = b.join(ends, KEY).withColumn("price", F.round(F.col("close") / width) * width)
    v = x.groupBy(*KEY, F.round("price", 8).alias("price")).agg(F.sum("volume").alias("volume"))
    w = Window.partitionBy(*KEY)
    by = w.orderBy(F.desc("volume"), F.desc("price"))
    v = v.select("*", F.row_number().over(by).alias("rank"), (F.sum("volume").over(by) - F.col("volume")).alias("before"), F.sum("volume").over(w).alias("total"))
    return v.select(*KEY, "price", "volume", "rank", (F.col("rank") == 1).alias("poc"), (F.col("before") < 0.7 * F.col("total")).alias("in_area"))


def volume_profile(bars: DataFrame, n: int = 50) -> DataFrame:
    """Volume in ``n`` equal buckets of the close range."""
    b = bars.where("close is not null and volume is not null")
    ends = b.groupBy(*KEY).agg(F.min("close").alias("lo"), F.max("close").alias("hi"))
    x = b.join(ends, KEY).withColumn("slot", F.coalesce(F.least(F.floor(ratio(F.col("close") - F.col("lo"), F.col("hi") - F.col("lo")) * n), F.lit(n - 1)), F.lit(0)))
    return x.groupBy(*KEY, "slot").agg(F.sum("volume").alias("volume"), F.sum("buy_volume").alias("buy_volume"))


def volume_bubbles(bars: DataFrame) -> DataFrame:
    """Bubble size against the key's largest volume, and the stronger side."""
    b = bars.where("volume > 0")
    most = b.groupBy(*KEY).agg(F.max("volume").alias("most"))
    b = b.join(most, KEY)
    return b.select(*KEY, "ts", "close", F.greatest(F.col("volume") / F.col("most") * 30, F.lit(4.0)).alias("bubble"), F.when(F.col("buy_volume") / F.col("volume") > 0.5, "buy").otherwise("sell").alias("side"))


def delta_surface(bars: DataFrame) -> DataFrame:
    """P04."""
    return bars.where("close is not null").select(*KEY, "ts", "close", (2 * F.col("buy_volume") - F.col("volume")).alias("delta"))


def depth_surface(bars: DataFrame) -> DataFrame:
    """P05."""
    return bars.where("best_bid is not null").select(*KEY, "ts", "best_bid", (F.coalesce("bid_depth_l1_close", F.lit(0.0)) + F.coalesce("ask_depth_l1_close", F.lit(0.0))).alias("depth"))


def bidask_panel(bars: DataFrame) -> DataFrame:
    """P06."""
    return bars.where("volume is not null").select(*KEY, "ts", "buy_volume", (-F.col("sell_volume")).alias("sell_bar"), ratio(F.col("buy_volume"), F.col("volume")).alias("buy_ratio"))


def signal_panel(imbalance: DataFrame, auction: DataFrame) -> DataFrame:
    """Positive and negative part of the imbalance ratio, unfinished flags."""
    j = imbalance.join(auction, [*KEY, "ts"])
    return j.select(*KEY, "ts", F.greatest("imbalance_ratio", F.lit(0.0)).alias("imbalance_pos"), F.least("imbalance_ratio", F.lit(0.0)).alias("imbalance_neg"), "unfinished_top", "unfinished_bottom")


def event_overlay(bars: DataFrame) -> DataFrame:
    """Bars with an iceberg or an absorption."""
    hit = F.col("iceberg_bid_detected") | F.col("iceberg_ask_detected") | F.col("absorption_detected")
    kind = F.when(F.col("iceberg_bid_detected"), "iceberg_bid").when(F.col("iceberg_ask_detected"), "iceberg_ask").otherwise("absorption")
    return bars.where(hit).select(*KEY, "ts", kind.alias("event"), F.coalesce("iceberg_price", "close").alias("price"))


def last_liquidity(areas: DataFrame) -> DataFrame:
    """P10: each key's last known value area."""
    return areas.where("poc_price is not null").groupBy(*KEY).agg(F.max("ts").alias("ts"), *[F.max_by(c, "ts").alias(c) for c in ("poc_price", "value_area_high", "value_area_low")])


def importance_summary(registry: DataFrame, slot: list[str], top: int = 20) -> DataFrame:
    """Mean importance of each feature over a slot's models, the ``top`` largest. ``importances`` is a map."""
    x = registry.select(*slot, F.explode("importances").alias("feature", "importance")).groupBy(*slot, "feature").agg(F.avg("importance").alias("importance"))
    rank = F.row_number().over(Window.partitionBy(*slot).orderBy(F.desc("importance"), "feature"))
    return x.withColumn("rank", rank).where(F.col("rank") <= top)


def bar_status(bars: DataFrame, as_of: Column) -> DataFrame:
    """P12."""
    return bars.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.max("ts").alias("last_bar"), (F.unix_seconds(as_of) - F.unix_seconds(F.max("ts"))).alias("age_seconds"))
