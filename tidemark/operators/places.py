"""Positions of rows in an order, without a window over a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.io import scratch


def in_ranks(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds nth_ (from 0) of each row in its group by ``order``, and the group's rows n_; a null is a group of its own, rows that tie in ``order`` take any order among themselves.

    Rows are sorted by range and written with their place; a window over the ranges' counts, of which there are as many as shuffle partitions, tells where a group's part of a range begins.
    """
    path = scratch(df.sparkSession, "ranks")
    df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("at_", F.monotonically_increasing_id()).write.parquet(path)
    t = df.sparkSession.read.parquet(path).withColumn("part_", F.shiftright("at_", 33)).withColumn("group_", F.struct(*by) if by else F.lit(0))
    parts = t.groupBy("group_", "part_").agg(F.min("at_").alias("first_"), F.count(F.lit(1)).alias("m_"))
    all_parts = Window.partitionBy("group_")
    earlier = all_parts.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("group_", "part_", "first_", F.coalesce(F.sum("m_").over(earlier), F.lit(0)).alias("before_"), F.sum("m_").over(all_parts).alias("n_"))
    return t.join(starts, ["group_", "part_"]).select(*df.columns, (F.col("at_") - F.col("first_") + F.col("before_")).alias("nth_"), "n_")
