"""Data-quality reports and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.core import KEY, bucket, over_days
from tidemark.operators.rolling import time_gaps


def days_back(ts: Column, as_of: Column, days: int) -> Column:
    return F.to_date(ts) > F.date_sub(F.to_date(as_of), days)


def rows_per_day(bars: DataFrame, as_of: Column, days: int = 35, least: int = 80_000) -> DataFrame:
    """D01."""
    out = bars.where(days_back(F.col("ts"), as_of, days)).groupBy(*KEY, F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return out.withColumn("short", F.col("rows") < least)


def null_rates(bars: DataFrame, cols: list[str], as_of: Column, days: int = 7, most: float = 0.05) -> DataFrame:
    """One pass; one row per column."""
    rates = bars.where(days_back(F.col("ts"), as_of, days)).groupBy(*KEY).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = rates.unpivot(KEY, cols, "column", "null_rate")
    return long.withColumn("bad", F.col("null_rate") > most)


def readiness(bars: DataFrame, cols: list[str], as_of: Column, good_days: int = 28, least: int = 80_000, gap_hours: float = 6.0) -> DataFrame:
    """Each key's failures among days, nulls and gaps, and whether it is ready."""
    days = rows_per_day(bars, as_of, 35, least).groupBy(*KEY).agg(F.count_if(~F.col("short")).alias("good"))
    few = days.where(F.col("good") < good_days).select(*KEY, F.lit("days").alias("failure"))
    nulls = null_rates(bars, cols, as_of).where("bad").select(*KEY, F.concat(F.lit("nulls:"), "column").alias("failure"))
    gaps = time_gaps(bars.where(days_back(F.col("ts"), as_of, 29)), int(gap_hours * 3600)).select(*KEY, F.lit("gap").alias("failure")).distinct()
    found = few.unionByName(nulls).unionByName(gaps).groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_list("failure")), ",").alias("failures"))
    return bars.select(*KEY).distinct().join(found, KEY, "left").select(*KEY, F.coalesce("failures", F.lit("")).alias("failures"), F.col("failures").isNull().alias("ready"))


def contract_check(spark: SparkSession, tables: dict[str, DataFrame], contract: dict[str, dict[str, tuple[str, Column | None]]]) -> DataFrame:
    """Required columns of each table, with their type and what their values must meet (a condition, or None): status ok, missing, type or values, and the rows, nulls and
    values that fail (a null fails no condition). One pass over each table."""
    out = None
    for name, needed in contract.items():
        df, have = tables[name], dict(tables[name].dtypes)
        facts = []
        for c, (kind, rule) in needed.items():
            fits = have.get(c) == kind
            bad = F.count_if(~rule) if fits and rule is not None else F.lit(0)
            state = F.lit("missing" if c not in have else "type") if not fits else F.when(bad > 0, "values").otherwise("ok")
            nulls = F.count_if(F.col(c).isNull()) if c in have else F.count(F.lit(1))
            facts.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("expected"), F.lit(have.get(c)).cast("string").alias("found"), state.alias("status"), nulls.cast("long").alias("nulls"), bad.cast("long").alias("failing")))
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*facts).alias("facts")).select(F.lit(name).alias("table"), F.explode("facts").alias("f"), "rows").select("table", "f.*", "rows")
        out = one if out is None else out.unionByName(one)
    return out


def freshness(bars: DataFrame, as_of: Column, most: int = 60) -> DataFrame:
    """Age of each key's newest row against ``most`` seconds."""
    age = F.unix_seconds(as_of) - F.unix_seconds(F.max("ts"))
    return bars.groupBy(*KEY).agg(age.alias("age_seconds"), (age <= most).alias("fresh"))


def rates(ticks: DataFrame, tf: str = "1m") -> DataFrame:
    """Ticks in each slot that has any."""
    return ticks.where("msg_type = 'tick'").groupBy(*KEY, bucket(F.col("ts"), tf).alias("ts")).agg(F.count(F.lit(1)).alias("ticks"), F.count_if(F.col("event_type") == "trade").alias("trades"))


def sustained(series: DataFrame, seconds: int) -> DataFrame:
    """Spans in which ``healthy`` is 0 for at least ``seconds`` (from the first to the last row of the span)."""
    s = over_days(series, sums={"island": F.when(F.col("healthy") == 0, 0).otherwise(1)}, order=("ts",)).where("healthy = 0")
    spans = s.groupBy(*KEY, "island").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("rows")).drop("island")
    return spans.where(F.unix_seconds("end") - F.unix_seconds("start") >= seconds)
