"""As-of, membership and lookup joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.core import KEY, over_days


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], value: list[str], tolerance: float | None = None) -> DataFrame:
    """Each row of ``left`` with ``value`` and ``right_ts`` of the latest row of ``right`` at its ``ts`` or before, at most ``tolerance`` seconds; null otherwise.

    Both sides are one table, ordered by time with the right side first; nothing is joined. Ties on the right: the largest value struct.
    """
    names = [c for c in left.columns if c not in by and c != "ts"]
    # Only the newest row per (by, ts) of the right side can be found.
    r = right.groupBy(*by, "ts").agg(F.max(F.struct(*value)).alias("v"))
    row = left.select(*by, "ts", F.struct(*[left[c] for c in names]).alias("row"), F.lit(1).alias("side"))
    ref = r.select(*by, "ts", F.struct(F.col("ts").alias("right_ts"), *[F.col("v")[c].alias(c) for c in value]).alias("ref"), F.lit(0).alias("side"))
    both = row.unionByName(ref, allowMissingColumns=True)
    out = over_days(both, lasts={"seen": F.col("ref")}, by=by, order=("ts", "side")).withColumn("ref", F.col("seen")).where("side = 1")
    near = F.col("ref") if tolerance is None else F.when(F.unix_micros("ts") - F.unix_micros("ref.right_ts") <= int(tolerance * 1e6), F.col("ref"))
    out = out.withColumn("ref", near)
    return out.select(*by, "ts", *[F.col("row")[c].alias(c) for c in names], F.col("ref.right_ts").alias("right_ts"), *[F.col("ref")[c].alias(c) for c in value])


def asof_pair(a: DataFrame, b: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Bars of two symbols side by side on one exchange; rows without both quotes are dropped."""
    left = a.select("exchange", "ts", F.col("mid").alias("mid_a"))
    right = b.select("exchange", "ts", F.col("mid").alias("mid_b"))
    return asof_backward(left, right, ["exchange"], ["mid_b"], tolerance).where("mid_a is not null and mid_b is not null").drop("right_ts")


def funding_cost(positions: DataFrame, rates: DataFrame) -> DataFrame:
    """Size x mark price x the rate as of each position's time; 0 without a rate."""
    out = asof_backward(positions, rates, KEY, ["funding_rate"])
    return out.withColumn("funding_cost", F.col("size") * F.col("price") * F.coalesce("funding_rate", F.lit(0.0))).drop("right_ts")


def orders_confirmed(nonterminal: DataFrame, open_orders: DataFrame) -> DataFrame:
    """Open orders that the exchange still has."""
    return nonterminal.join(open_orders.select("order_id").distinct(), "order_id", "left_semi")


def orders_missing(nonterminal: DataFrame, open_orders: DataFrame) -> DataFrame:
    """Open orders that the exchange lacks."""
    return nonterminal.join(open_orders.select("order_id").distinct(), "order_id", "left_anti")


def orders_orphaned(open_orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """Alert rows for orders that the exchange has and the ledger does not know."""
    lost = open_orders.join(ledger.select("order_id").distinct(), "order_id", "left_anti")
    return lost.select("order_id", F.lit("orphan_order").alias("alert_type"), F.concat_ws(" ", "exchange", "symbol", "side").alias("detail"), F.lit(False).alias("resolved"))


def uncovered_positions(orders: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Keys with orders that nobody subscribes to."""
    return orders.select(*KEY).distinct().join(subscriptions.select(*KEY).distinct(), KEY, "left_anti")


def merge_stats(running: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Running strategies with their trade statistics, zeros where they have none."""
    joined = running.join(stats, by, "left")
    return joined.fillna(0, [c for c in stats.columns if c not in by and dict(stats.dtypes)[c] in ("bigint", "int", "double")])


def with_regime(bars: DataFrame, regimes: DataFrame, ttl: float = 180.0) -> DataFrame:
    """The regime published last, for ``ttl`` seconds; RANGING otherwise."""
    out = asof_backward(bars, regimes, KEY, ["regime"], ttl)
    return out.withColumn("regime", F.coalesce("regime", F.lit("RANGING"))).drop("right_ts")


def with_model(features: DataFrame, registry: DataFrame, slot: list[str]) -> DataFrame:
    """The registered model of each row's slot with the largest cv_score, then the largest model_id."""
    best = registry.groupBy(*slot).agg(F.max(F.struct("cv_score", "model_id")).alias("m")).select(*slot, F.col("m.model_id").alias("model_id"), F.col("m.cv_score").alias("cv_score"))
    return features.join(best, slot, "left")


def asof_condition(ts: Column, as_of: Column, back: float) -> Column:
    """Inside the ``back`` seconds up to ``as_of``."""
    return (F.unix_micros(ts) <= F.unix_micros(as_of)) & (F.unix_micros(ts) > F.unix_micros(as_of) - int(back * 1e6))
