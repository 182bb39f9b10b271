"""Footprints: traded volume by price and side inside a bar, in long form (key, ts, price_str, price, b, s), and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, bucket, ratio, with_bar

BAR = [*KEY, "ts"]
MAP = "map<string,struct<b:double,s:double>>"


def footprint_long(trades: DataFrame, tf: str) -> DataFrame:
    """F24, working form: levels are kept apart by price text."""
    buy = F.col("side") == "buy"
    out = with_bar(trades, tf).groupBy(*KEY, F.col("bar").alias("at"), "price_str").agg(F.sum(F.when(buy, F.col("size")).otherwise(0.0)).alias("b"), F.sum(F.when(buy, 0.0).otherwise(F.col("size"))).alias("s"))
    return out.select(*KEY, F.col("at").alias("ts"), "price_str", F.col("price_str").cast("double").alias("price"), "b", "s")


def footprint(long: DataFrame) -> DataFrame:
    """``{price: {b, s}}`` as JSON, keys in text order."""
    entries = F.array_sort(F.collect_list(F.struct("price_str", F.struct("b", "s").alias("v"))))
    return long.groupBy(*BAR).agg(F.to_json(F.map_from_entries(entries)).alias("footprint_json"))


def value_area(long: DataFrame, share: float = 0.7) -> DataFrame:
    """the point of control (largest volume, then the higher price) and the greedy area around it.

    The area grows by the larger neighbour, the upper one if equal, until it holds ``share`` of the volume. A bar's levels are one array.
    """
    levels = F.array_sort(F.collect_list(F.struct("price", (F.col("b") + F.col("s")).alias("v"))))
    top = F.max(F.struct((F.col("b") + F.col("s")).alias("v"), "price"))
    bars = long.groupBy(*BAR).agg(levels.alias("lv"), top.alias("top"), F.sum(F.col("b") + F.col("s")).alias("total"))
    start = F.array_position(F.transform("lv", lambda x: x["price"]), F.col("top.price")).cast("int")
    bars = bars.withColumn("at", start).withColumn("n", F.size("lv"))

    def volume(i: Column) -> Column:
        return F.when((i >= 1) & (i <= F.col("n")), F.get("lv", (i - 1).cast("int"))["v"]).otherwise(F.lit(-1.0))

    def grow(acc: Column, _: Column) -> Column:
        up, down = volume(acc["hi"] + 1), volume(acc["lo"] - 1)
        done = (acc["acc"] >= share * F.col("total")) | ((up < 0) & (down < 0))
        higher = up >= down
        return F.struct(
            F.when(done | higher, acc["lo"]).otherwise(acc["lo"] - 1).alias("lo"), F.when(~done & higher, acc["hi"] + 1).otherwise(acc["hi"]).alias("hi"),
            F.when(done, acc["acc"]).when(higher, acc["acc"] + up).otherwise(acc["acc"] + down).alias("acc"),
        )

    area = F.aggregate("lv", F.struct(F.col("at").alias("lo"), F.col("at").alias("hi"), F.col("top.v").alias("acc")), grow)
    bars = bars.withColumn("area", area)
    return bars.select(*BAR, F.col("top.price").alias("poc_price"), F.get("lv", F.col("area.hi") - 1)["price"].alias("value_area_high"), F.get("lv", F.col("area.lo") - 1)["price"].alias("value_area_low"), F.col("top.v").alias("poc_volume"))


def imbalance_flags(long: DataFrame, factor: float = 3.0) -> DataFrame:
    b, s = F.col("b"), F.col("s")
    return long.withColumn("buy_flag", (s > 0) & (b > factor * s)).withColumn("sell_flag", (b > 0) & (s > factor * b))


def imbalance(long: DataFrame) -> DataFrame:
    """levels where one side is over three times the other (which is not 0), longest stacks of neighbouring levels, net share of levels."""
    f = imbalance_flags(long)
    nth = F.row_number().over(Window.partitionBy(*BAR).orderBy("price"))
    f = f.withColumn("nth", nth)

    def stacks(flag: str, name: str) -> DataFrame:
        own = f.where(flag).withColumn("island", F.col("nth") - F.row_number().over(Window.partitionBy(*BAR).orderBy("price")))
        return own.groupBy(*BAR, "island").agg(F.count(F.lit(1)).alias("n")).groupBy(*BAR).agg(F.max("n").alias(name))

    out = f.groupBy(*BAR).agg(F.count_if("buy_flag").alias("imbalance_buy_count"), F.count_if("sell_flag").alias("imbalance_sell_count"), F.count(F.lit(1)).alias("levels"))
    out = out.join(stacks("buy_flag", "x"), BAR, "left").join(stacks("sell_flag", "y"), BAR, "left")
    return out.select(*BAR, "imbalance_buy_count", "imbalance_sell_count", F.coalesce("x", F.lit(0)).alias("imbalance_stack_buy"), F.coalesce("y", F.lit(0)).alias("imbalance_stack_sell"), ((F.col("imbalance_buy_count") - F.col("imbalance_sell_count")) / F.col("levels")).alias("imbalance_ratio"))


def auction_signals(long: DataFrame, bars: DataFrame) -> DataFrame:
    """single prints (volume below a tenth of the mean level, between low and high) and unfinished auctions at the extremes."""
    v = F.col("b") + F.col("s")
    mean = F.avg(v).over(Window.partitionBy(*BAR))
    j = long.withColumn("mean", mean).join(bars.select(*BAR, "high", "low"), BAR)
    single = (v < 0.1 * F.col("mean")) & (F.col("price") > F.col("low")) & (F.col("price") < F.col("high"))
    sold_high = F.sum(F.when(F.col("price") == F.col("high"), F.col("s")).otherwise(0.0))
    bought_low = F.sum(F.when(F.col("price") == F.col("low"), F.col("b")).otherwise(0.0))
    return j.groupBy(*BAR).agg(
        F.count_if(single).alias("single_print_count"), F.to_json(F.array_sort(F.collect_list(F.when(single, F.col("price"))))).alias("single_print_levels_json"),
        (sold_high == 0).alias("unfinished_top"), (bought_low == 0).alias("unfinished_bottom"),
    )


def parsed(json: Column) -> Column:
    return F.from_json(json, MAP)


def merge_footprints(bars: DataFrame, tf: str) -> DataFrame:
    """footprints of a longer bar; unreadable ones count as none, and a bar without any has null."""
    b = bars.select(*KEY, bucket(F.col("ts"), tf).alias("ts"), parsed(F.col("footprint_json")).alias("m"))
    cells = b.select(*BAR, F.explode("m").alias("price_str", "v")).where("v is not null").groupBy(*BAR, "price_str").agg(F.sum(F.coalesce("v.b", F.lit(0.0))).alias("b"), F.sum(F.coalesce("v.s", F.lit(0.0))).alias("s"))
    return b.select(*BAR).distinct().join(footprint(cells), BAR, "left")


def merge_single_prints(bars: DataFrame, tf: str) -> DataFrame:
    """distinct levels of a longer bar in numeric order, as JSON."""
    levels = F.from_json("single_print_levels_json", "array<double>")
    b = bars.select(*KEY, bucket(F.col("ts"), tf).alias("ts"), levels.alias("l"))
    return b.groupBy(*BAR).agg(F.to_json(F.array_sort(F.array_distinct(F.flatten(F.collect_list("l"))))).alias("single_print_levels_json"))


def footprint_ladder(long: DataFrame) -> DataFrame:
    """Levels from high to low with their flags and whether they are single prints."""
    f = imbalance_flags(long)
    v = F.col("b") + F.col("s")
    w = Window.partitionBy(*BAR)
    inside = (F.col("price") > F.min("price").over(w)) & (F.col("price") < F.max("price").over(w))
    return f.withColumn("single_print", inside & (v < 0.1 * F.avg(v).over(w))).withColumn("rung", F.row_number().over(w.orderBy(F.desc("price"))))


def value_area_topvol(levels: DataFrame, share: float = 0.7) -> DataFrame:
    """The chart's other definition: the largest levels (price, volume) until they hold ``share`` of the volume; their extremes."""
    by_volume = Window.partitionBy(*KEY).orderBy(F.desc("volume"), F.desc("price"))
    whole = Window.partitionBy(*KEY)
    x = levels.select("*", (F.sum("volume").over(by_volume) - F.col("volume")).alias("before"), F.sum("volume").over(whole).alias("total"))
    return x.where(F.col("before") < share * F.col("total")).groupBy(*KEY).agg(F.max("price").alias("value_area_high"), F.min("price").alias("value_area_low"))
