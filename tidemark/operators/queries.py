"""Point and range reads over bars, runs and fills. Limits are the feature: latest rows, pages and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, after, over_days, ratio, seconds


def of_key(df: DataFrame, exchange: str, symbol: str) -> DataFrame:
    return df.where((F.col("exchange") == exchange) & (F.col("symbol") == symbol))


def latest_bars(bars: DataFrame, exchange: str, symbol: str, n: int) -> DataFrame:
    """Q01: the newest ``n``, ascending."""
    return of_key(bars, exchange, symbol).orderBy(F.desc("ts")).limit(n).orderBy("ts")


def bars_since(bars: DataFrame, exchange: str, symbol: str, cursor: Column, limit: int = 100) -> DataFrame:
    """Q02."""
    return of_key(bars, exchange, symbol).where(F.col("ts") > cursor).orderBy("ts").limit(limit)


def last_source_ts(bars: DataFrame, base: str, tf: str) -> DataFrame:
    """Q03: the time of the last base bar inside each bar: open + (n - 1) base lengths."""
    return bars.withColumn("source_ts", after(F.col("ts"), seconds(tf) - seconds(base)))


def bars_around(bars: DataFrame, exchange: str, symbol: str, at: Column, tf: str, window: int) -> DataFrame:
    """Q04: ``window`` bars each side, at most ``2 window + 50``."""
    span = window * seconds(tf)
    return of_key(bars, exchange, symbol).where((F.col("ts") >= after(at, -span)) & (F.col("ts") <= after(at, span))).orderBy("ts").limit(2 * window + 50)


def bar_detail(bars: DataFrame, exchange: str, symbol: str, at: Column, tf: str) -> DataFrame:
    """Q05: the bar that holds an instant: opens from a bar and a second before to half a second after, the nearest to it."""
    near = of_key(bars, exchange, symbol).where((F.col("ts") <= after(at, 0.5)) & (F.col("ts") > after(at, -seconds(tf) - 1)))
    return near.orderBy(F.abs(F.unix_micros("ts") - F.unix_micros(at)), "ts").limit(1)


def available_symbols(bars: DataFrame, exchange: str | None = None) -> DataFrame:
    """Q06."""
    b = bars if exchange is None else bars.where(F.col("exchange") == exchange)
    return b.groupBy(*KEY).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("rows"))


def run_history(runs: DataFrame, name: str | None = None, limit: int = 50) -> DataFrame:
    """Q07: newest first."""
    r = runs if name is None else runs.where(F.col("strategy") == name)
    return r.orderBy(F.desc("run_at"), "run_id").limit(limit)


def equity_of(equity: DataFrame, run_id: str) -> DataFrame:
    """Q08."""
    return equity.where(F.col("run_id") == run_id).orderBy("ts")


def recent_trades(fills: DataFrame, paper: bool, n: int) -> DataFrame:
    """Q09: newest filled rows, pnl to four places."""
    f = fills.where((F.col("paper") == paper) & (F.col("status") == "filled"))
    return f.withColumn("realized_pnl", F.round("realized_pnl", 4)).orderBy(F.desc("ts"), F.desc("nth"), "strategy", *KEY).limit(n)


def strategy_trades(fills: DataFrame, strategy: str, exchange: str, symbol: str) -> DataFrame:
    """Q10: oldest first."""
    return of_key(fills, exchange, symbol).where(F.col("strategy") == strategy).orderBy("ts", "nth")


def deviation_series(bars: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Q11: microprice deviation of the last day before ``as_of``."""
    b = bars.where((F.col("ts") > after(as_of, -hours * 3600)) & (F.col("ts") <= as_of) & F.col("microprice_mid_delta").isNotNull())
    return b.select(*KEY, "ts", "microprice_mid_delta").orderBy(*KEY, "ts")


def history(bars: DataFrame, exchange: str, symbol: str, n: int) -> DataFrame:
    """Q12: latest bars with is_complete and has_gap."""
    return latest_bars(bars, exchange, symbol, n).withColumn("is_complete", ~F.col("is_partial")).withColumn("has_gap", F.coalesce("gap_count", F.lit(0)) > 0)


def with_derived(bars: DataFrame) -> DataFrame:
    """Q13: columns that are derived and not stored."""
    mid = (F.col("best_bid") + F.col("best_ask")) / 2
    b, a = F.col("bid_depth_top10_close"), F.col("ask_depth_top10_close")
    return (
        over_days(bars, priors={"before": F.struct("ofi_l1")}, order=("ts",)).withColumn("vwap", ratio(F.col("quote_volume"), F.col("volume"))).withColumn("mid", mid).withColumn("spread_abs", F.col("best_ask") - F.col("best_bid")).withColumn("spread_bps", (F.col("best_ask") - F.col("best_bid")) / mid * 10_000)
        .withColumn("sell_volume", F.greatest(F.col("volume") - F.col("buy_volume"), F.lit(0.0))).withColumn("sell_count", F.col("trade_count") - F.col("buy_count")).withColumn("imbalance_top10", ratio(b - a, b + a))
        .withColumn("has_gap", F.coalesce("gap_count", F.lit(0)) > 0).withColumn("ofi_delta", F.col("ofi_l1") - F.col("before.ofi_l1")).drop("before")
    )


def latest_signals(signals: DataFrame, n: int) -> DataFrame:
    """Q14: the newest ``n`` of each key."""
    w = Window.partitionBy(*KEY).orderBy(F.desc("ts"))
    return signals.withColumn("back", F.row_number().over(w)).where(F.col("back") <= n)
