"""Rolling statistics, labels and signals over bars (key, ts, ...).

Windows of so many rows run over blocks of a key's rows (``in_blocks``), running values over its days (``over_days``), and
recursions from block to block (``in_chunks``), so that a key's history is spread over tasks.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tidemark.core import KEY, clip, in_blocks, in_chunks, over_days, ratio


def ordered(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("ts")


def last_n(keys: list[str], n: int):
    return ordered(keys).rowsBetween(1 - n, 0)


def numbered(df: DataFrame, name: str = "nth") -> DataFrame:
    """Adds the row's number in its key."""
    return over_days(df, sums={name: F.lit(1).cast("long")}, order=("ts",))


def _nearest_rank(n: int, min_n: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ts", "seq"], kind="stable")
        sizes, held, out = rows["size"].tolist(), [], []
        for i, x in enumerate(sizes):
            insort(held, x)
            if i >= n:
                del held[bisect_left(held, sizes[i - n])]
            out.append(held[(len(held) * 99 + 99) // 100 - 1] if len(held) >= min_n else None)
        return rows.assign(threshold=pd.Series(out, rows.index, "float64"))

    return run


def block_threshold(trades: DataFrame, n: int = 1000, min_n: int = 100) -> DataFrame:
    """Nearest-rank 99th percentile of the last ``n`` sizes with the current one; null below ``min_n``. A worker keeps one sorted list of ``n`` sizes."""
    def run(t: DataFrame, keys: list[str]) -> DataFrame:
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.schema)
        return t.groupBy(*keys).applyInPandas(_nearest_rank(n, min_n), f"{shape}, threshold double")

    return in_blocks(trades, n - 1, run, order=("ts", "seq"))


def classify_regime(bars: DataFrame, n: int = 10) -> DataFrame:
    """Regime of the last ``n`` bars: THIN_BOOK, HIGH_VOL, TRENDING_UP, TRENDING_DOWN or RANGING, tested in this order."""
    def run(b: DataFrame, keys: list[str]) -> DataFrame:
        w, near = ordered(keys), last_n(keys, n)
        b = b.withColumn("r", F.log(F.col("close") / F.lag("close").over(w)))
        b = b.select("*", F.count("close").over(near).alias("valid"), F.sort_array(F.collect_list(F.coalesce("spread_mean", F.lit(0.0))).over(near)).alias("spreads"), F.lag("close", 4).over(w).alias("close4"), F.stddev_pop("r").over(w.rowsBetween(2 - n, 0)).alias("vol"))
        m = F.size("spreads")
        median = (F.get("spreads", F.floor((m - 1) / 2).cast("int")) + F.get("spreads", F.floor(m / 2).cast("int"))) / 2
        change = (F.col("close") - F.col("close4")) / F.col("close4")
        regime = (
            F.when(F.col("valid") < 5, "RANGING").when((median > 0) & (F.coalesce("spread_mean", F.lit(0.0)) > 2 * median), "THIN_BOOK").when(F.col("vol") > 0.002, "HIGH_VOL").when(change > 0.001, "TRENDING_UP").when(change < -0.001, "TRENDING_DOWN").otherwise("RANGING")
        )
        return b.withColumn("regime", regime).drop("r", "valid", "spreads", "close4", "vol")

    return in_blocks(bars, n, run)


#: Savitzky-Golay weights of window 5 and order 2 (times 35), for the middle and for positions 0 and 1 from an edge.
SAVGOL = {"middle": [-3, 12, 17, 12, -3], "edge": [31, 9, -3, -5, 3], "next": [9, 13, 12, 6, -5]}


def savgol5(df: DataFrame, col: str, mode: str = "causal", keys: list[str] | None = None) -> DataFrame:
    """Adds ``<col>_sg``. ``centered`` looks two bars ahead (fitted edges), ``causal`` fits the last five bars; nulls are 0; raw below five rows."""
    x = F.coalesce(F.col(col), F.lit(0.0))

    if keys is None:
        return in_blocks(df, 4, lambda d, k: savgol5(d, col, mode, k), ahead=0 if mode == "causal" else 2)
    w = ordered(keys)
    # Only a key's first rows have fewer than five before them, and only its last ones fewer than two behind.
    nth, n = F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy(*keys))
    behind = F.count(F.lit(1)).over(w.rowsBetween(1, 2))

    def at(k: int) -> Column:
        return F.lag(x, -k).over(w) if k < 0 else F.lead(x, k).over(w) if k else x

    def fit(name: str, offsets: list[int]) -> Column:
        return sum((weight * at(k) for weight, k in zip(SAVGOL[name], offsets, strict=True)), F.lit(0.0)) / 35

    if mode == "causal":
        return df.withColumn(f"{col}_sg", F.when(nth < 5, x).otherwise(fit("edge", [0, -1, -2, -3, -4])))
    value = F.when(n < 5, x).when(nth == 1, fit("edge", [0, 1, 2, 3, 4])).when(nth == 2, fit("next", [-1, 0, 1, 2, 3]))
    value = value.when(behind == 0, fit("edge", [0, -1, -2, -3, -4])).when(behind == 1, fit("next", [1, 0, -1, -2, -3])).otherwise(fit("middle", [-2, -1, 0, 1, 2]))
    return df.withColumn(f"{col}_sg", value)


def flow_ratios(df: DataFrame) -> DataFrame:
    """W04."""
    b, a = F.col("bid_depth_l1_close"), F.col("ask_depth_l1_close")
    return df.withColumn("net_buy_fraction", F.coalesce(ratio(F.col("buy_volume"), F.col("volume")), F.lit(0.5))).withColumn("depth_imbalance_l1", (b - a) / (b + a + 1e-9))


def ffill_quotes(df: DataFrame) -> DataFrame:
    """best_bid and best_ask carried forward, and their mid."""
    out = over_days(df, lasts={"bid_": F.col("best_bid"), "ask_": F.col("best_ask")}, order=("ts",))
    out = out.withColumns({"best_bid": F.col("bid_"), "best_ask": F.col("ask_")}).drop("bid_", "ask_")
    return out.withColumn("mid", (F.col("best_bid") + F.col("best_ask")) / 2)


def of_arrays(fn, missing: float | None):
    """A vectorised UDF of an array column: ``fn`` of each array, ``missing`` for null."""
    def run(series: pd.Series) -> pd.Series:
        return pd.Series([missing if s is None else fn(np.asarray(s, float)) for s in series], dtype="float64")

    return pandas_udf(run, DoubleType())


def hurst_of(r: np.ndarray) -> float:
    """Rescaled-range exponent of one series of returns."""
    n, lags = len(r), [4, 8, 16, min(32, len(r) // 2)]
    xs, ys = [], []
    for lag in sorted({k for k in lags if 4 <= k <= n // 2}):
        rs = []
        for start in range(0, n - lag, lag):
            part = r[start : start + lag]
            s = part.std()
            if s >= 1e-10:
                walk = np.cumsum(part - part.mean())
                rs.append((walk.max() - walk.min()) / s)
        if rs and np.mean(rs) > 0:
            xs.append(math.log(lag))
            ys.append(math.log(np.mean(rs)))
    return float(np.clip(np.polyfit(xs, ys, 1)[0], 0, 1)) if len(xs) >= 2 else 0.5


def hurst(df: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """Rolling Hurst exponent of ``n`` log returns of ``mid``; null until the frame is full."""
    if keys is None:
        return in_blocks(df, n, lambda d, k: hurst(d, n, k))
    w = ordered(keys)
    r = df.withColumn("r", F.coalesce(F.log(F.col("mid") / F.lag("mid").over(w)), F.lit(0.0)))
    r = r.withColumn("rs", F.when(F.row_number().over(w) > n, F.collect_list("r").over(last_n(keys, n))))
    return r.withColumn(f"hurst_{n}", of_arrays(hurst_of, None)("rs")).drop("r", "rs")


def ou_halflife(df: DataFrame, n: int = 60, col: str = "mid", keys: list[str] | None = None) -> DataFrame:
    """Half-life of mean reversion from the slope of x on its previous value in the last ``n`` rows."""
    if keys is None:
        return in_blocks(df, n, lambda d, k: ou_halflife(d, n, col, k))
    w = ordered(keys)
    x0 = df.withColumn("x0", F.lag(col).over(w))
    slope = F.regr_slope(F.col(col), F.col("x0")).over(w.rowsBetween(2 - n, 0))
    phi = x0.withColumn("phi", slope).withColumn("nth", F.row_number().over(w))
    half = F.when((F.col("phi") > 0) & (F.col("phi") < 1), clip(-math.log(2) / F.log("phi"), 1.0, 300.0)).otherwise(60.0)
    return phi.withColumn("ou_halflife", F.when(F.col("nth") >= n, half)).drop("x0", "phi", "nth")


def kyle_lambda(df: DataFrame, n: int = 60, keys: list[str] | None = None) -> DataFrame:
    """Slope of mid changes on smoothed order flow; 0 below ten pairs or without variance."""
    if keys is None:
        return in_blocks(df, n, lambda d, k: kyle_lambda(d, n, k))
    w, near = ordered(keys), last_n(keys, n)
    df = df.withColumn("dm", F.col("mid") - F.lag("mid").over(w)).withColumn("nth", F.row_number().over(w))
    slope, pairs = F.regr_slope("dm", "ofi_l1_sg").over(near), F.regr_count("dm", "ofi_l1_sg").over(near)
    return df.withColumn("kyle_lambda", F.when(F.col("nth") >= n, F.when(pairs < 10, 0.0).otherwise(F.coalesce(slope, F.lit(0.0))))).drop("dm", "nth")


def interactions(df: DataFrame, ofi: str = "ofi_l1", spread: str = "spread_mean") -> DataFrame:
    """Products; where the whole column is null or not there, microprice delta follows from the closing depth and cancel bias from the cancel counts (0 without those). The products take the given delta, 0 for such a column."""
    for c in ("microprice_mid_delta", "cancel_bias", "hawkes_intensity"):
        df = df if c in df.columns else df.withColumn(c, F.lit(None).cast("double"))
    counts = df.agg(F.count("microprice_mid_delta").alias("n_m"), F.count("cancel_bias").alias("n_c"))
    d = df.join(F.broadcast(counts))  # one row
    given = F.when(F.col("n_m") == 0, 0.0).otherwise(F.col("microprice_mid_delta"))
    d = d.withColumn("ofi_x_spread", F.col(ofi) * F.col(spread)).withColumn("microprice_x_hawkes", given * F.col("hawkes_intensity"))
    micro = bias = F.lit(0.0)
    if {"best_bid", "best_ask", "bid_depth_l1_close", "ask_depth_l1_close"} <= set(df.columns):
        b, a = (F.coalesce(f"{side}_depth_l1_close", F.lit(0.0)) for side in ("bid", "ask"))
        mid = (F.col("best_bid") + F.col("best_ask")) / 2
        micro = F.when(mid > 0, ((F.col("best_ask") * b + F.col("best_bid") * a) / (b + a + 1e-9) - mid) / mid * 10000).otherwise(0.0)
    if {"bid_cancel_count", "ask_cancel_count"} <= set(df.columns):
        b, a = (F.coalesce(f"{side}_cancel_count", F.lit(0)) for side in ("bid", "ask"))
        bias = (b - a) / (b + a + 1.0)
    d = d.withColumn("microprice_mid_delta", F.when(F.col("n_m") == 0, micro).otherwise(F.col("microprice_mid_delta")))
    return d.withColumn("cancel_bias", F.when(F.col("n_c") == 0, bias).otherwise(F.col("cancel_bias"))).drop("n_m", "n_c")


def reversion_labels(df: DataFrame, horizons: list[int], bps: float) -> DataFrame:
    """REVERT, TREND or FLAT at each horizon from microprice_mid_delta and hurst_60."""
    d, h = F.abs("microprice_mid_delta"), F.coalesce("hurst_60", F.lit(0.5))

    def run(rows: DataFrame, keys: list[str]) -> DataFrame:
        for n in horizons:
            fwd = F.abs(F.lead("microprice_mid_delta", n).over(ordered(keys))) / d
            strong = (d >= bps) & (d >= 1e-10) & (h < 0.5) & fwd.isNotNull()
            rows = rows.withColumn(f"label_revert_{n}", F.when(strong & (fwd < 0.5), "REVERT").when(strong & (fwd > 1.2), "TREND").otherwise("FLAT"))
        return rows

    return in_blocks(df, 0, run, ahead=max(horizons))


def filtered(a: np.ndarray, b: np.ndarray, beta: float, p: float, q: float, r: float) -> tuple[np.ndarray, float, float]:
    """The hedge ratio after each row, and the last state."""
    out = np.empty(len(a))
    for i in range(len(a)):
        p += q
        gain = p * b[i] / (b[i] * b[i] * p + r)
        beta += gain * (a[i] - beta * b[i])
        p *= 1 - gain * b[i]
        out[i] = beta
    return out, beta, p


def filter_of(a: np.ndarray, b: np.ndarray, q: float, r: float) -> tuple[float, float, float, float, float]:
    """What a run of rows does to any state (m, p): five numbers (x, y, c, e, j) of the associative form of the filter, so that the state after the run is
    m' = x (m + p e) / (1 + p j) + y and p' = x^2 p / (1 + p j) + c."""
    x, y, c, e, j = 1.0, 0.0, 0.0, 0.0, 0.0
    for ai, bi in zip(a, b, strict=True):
        s = bi * bi * q + r
        k = q * bi / s
        x2, y2, c2, e2, j2 = 1 - k * bi, k * ai, (1 - k * bi) * q, bi * ai / s, bi * bi / s
        d = 1 / (1 + c * j2)
        x, y, c, e, j = x2 * d * x, x2 * d * (y + c * e2) + y2, x2 * x2 * d * c + c2, x * d * (e2 - j2 * y) + e, x * x * d * j2 + j
    return x, y, c, e, j


def kalman_hedge(pair: DataFrame, beta0: float | None = None, q: float = 1e-5, r: float = 1e-3) -> DataFrame:
    """Dynamic hedge ratio of log mids, one filter per exchange. Starts at the first ratio, or at ``beta0``.

    Each block of an exchange's rows is first summed up in five numbers; the blocks' states follow from those alone; then each block is filtered from its own.
    """
    t, columns = in_chunks(pair, ["exchange"]), pair.columns

    def block_of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("nth_")
        a, b = np.log(rows["mid_a"].to_numpy()), np.log(rows["mid_b"].to_numpy())
        return pd.DataFrame([(rows["exchange"].iloc[0], rows["block_"].iloc[0], a[0] / b[0] if b[0] else 1.0, *filter_of(a, b, q, r))])

    def states(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block_")
        m, p, out = float(rows["first"].iloc[0]) if beta0 is None else beta0, 1.0, []
        for x, y, c, e, j in rows[["x", "y", "c", "e", "j"]].itertuples(index=False):
            out.append((m, p))
            m, p = x * (m + p * e) / (1 + p * j) + y, x * x * p / (1 + p * j) + c
        return rows[["exchange", "block_"]].assign(m_=[o[0] for o in out], p_=[o[1] for o in out])

    def ratios(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("nth_")
        a, b = np.log(rows["mid_a"].to_numpy()), np.log(rows["mid_b"].to_numpy())
        out, _, _ = filtered(a, b, rows["m_"].iloc[0], rows["p_"].iloc[0], q, r)
        return rows[columns].assign(hedge_ratio=out)

    blocks = t.select("exchange", "block_", "nth_", "mid_a", "mid_b").groupBy("exchange", "block_").applyInPandas(block_of, "exchange string, block_ long, first double, x double, y double, c double, e double, j double")
    heads = blocks.groupBy("exchange").applyInPandas(states, "exchange string, block_ long, m_ double, p_ double")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pair.schema)
    return t.join(heads, ["exchange", "block_"]).groupBy("exchange", "block_").applyInPandas(ratios, f"{shape}, hedge_ratio double")


def spread_zscore(pair: DataFrame, n: int = 60, ddof: int = 1, by: tuple[str, ...] = ("exchange",)) -> DataFrame:
    """Spread of log mids under the hedge ratio and its rolling z-score; null until full or without variance."""
    p = pair.withColumn("spread", F.log("mid_a") - F.col("hedge_ratio") * F.log("mid_b"))

    def run(d: DataFrame, keys: list[str]) -> DataFrame:
        w = last_n(keys, n)
        std = (F.stddev_samp if ddof else F.stddev_pop)("spread").over(w)
        full = F.count("spread").over(w) == n
        return d.withColumn("spread_z", F.when(full & (std > 0), (F.col("spread") - F.avg("spread").over(w)) / std))

    return in_blocks(p, n, run, by=list(by))


#: Fixed values (MacKinnon 1994): response surface of the test with a constant: bounds, and polynomials in tau for the normal quantile of p.
ADF_STAR, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
ADF_SMALL, ADF_LARGE = [2.1659, 1.4412, 0.038269], [1.7339, 0.93202, -0.12745, -0.010368]


def adf_p(tau: float) -> float:
    if tau > ADF_MAX:
        return 1.0
    if tau < ADF_MIN:
        return 0.0
    z = sum(c * tau**k for k, c in enumerate(ADF_SMALL if tau <= ADF_STAR else ADF_LARGE))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def adf_of(x: np.ndarray) -> float:
    """Unit-root test p-value with a constant and one lag; 1.0 where it cannot be computed."""
    d = np.diff(x)
    y, design = d[1:], np.column_stack([x[1:-1], d[:-1], np.ones(len(d) - 1)])
    if np.linalg.matrix_rank(design) < 3 or len(y) <= 3:
        return 1.0
    inverse = np.linalg.inv(design.T @ design)
    coef = inverse @ design.T @ y
    rest = y - design @ coef
    var = rest @ rest / (len(y) - 3) * inverse[0, 0]
    return adf_p(coef[0] / math.sqrt(var)) if var > 0 else 1.0


def adf_pvalue(pair: DataFrame, n: int = 60, by: tuple[str, ...] = ("exchange",)) -> DataFrame:
    """P-value over the previous ``n`` spreads; 1.0 until there are as many."""
    def run(d: DataFrame, keys: list[str]) -> DataFrame:
        w = ordered(keys)
        p = d.withColumn("before", F.when(F.row_number().over(w) > n, F.collect_list("spread").over(w.rowsBetween(-n, -1))))
        return p.withColumn(f"adf_pvalue_{n}", of_arrays(adf_of, 1.0)("before")).drop("before")

    return in_blocks(pair, n, run, by=list(by))


def spread_labels(pair: DataFrame, horizon: int = 10, p_max: float = 0.1, z_min: float = 1.5, by: tuple[str, ...] = ("exchange",)) -> DataFrame:
    """CONVERGE, DIVERGE or NEUTRAL at ``horizon``."""
    z = F.abs("spread_z")
    on = (F.col("adf_pvalue_60") <= p_max) & (z > z_min)

    def run(d: DataFrame, keys: list[str]) -> DataFrame:
        fwd = F.abs(F.lead("spread_z", horizon).over(ordered(keys)))
        return d.withColumn("label_spread", F.when(on & (fwd < 0.5 * z), "CONVERGE").when(on & (fwd > 1.2 * z), "DIVERGE").otherwise("NEUTRAL"))

    return in_blocks(pair, 0, run, by=list(by), ahead=horizon)


# ---- signals: a signal adds action, confidence and reason ---------------------------------------


def recursive_means(df: DataFrame, means: dict[str, tuple[str, float]]) -> DataFrame:
    """Adds means m = a x + (1 - a) m of columns, ``means``: name -> (column, a), from each key's first non-null value on (null before it; no null may follow).

    A block of n rows turns a mean into (1 - a)^n m + b; so each is first summed up in (n, b), the blocks' means follow from those alone, and each block then starts from its own.
    """
    t, columns = in_chunks(df), df.columns
    w = Window.partitionBy(*KEY, "block_").orderBy("nth_")
    back = F.row_number().over(w.orderBy(F.desc("nth_"))) - 1
    each = t.select(*KEY, "block_", "nth_", back.alias("back_"), *{c for c, _ in means.values()})
    sums = [F.sum(F.col(c) * a * F.pow(F.lit(1 - a), F.col("back_"))).alias(f"{n}_b") for n, (c, a) in means.items()]
    sizes = [F.count(c).alias(f"{n}_n") for n, (c, _) in means.items()] + [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("nth_"))).alias(f"{n}_x") for n, (c, _) in means.items()]
    blocks = each.groupBy(*KEY, "block_").agg(*sums, *sizes)

    def states(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block_")
        out = rows[[*KEY, "block_"]].copy()
        for n, (_, a) in means.items():
            at, m = [], math.nan
            for size, b, x in zip(rows[f"{n}_n"], rows[f"{n}_b"], rows[f"{n}_x"], strict=True):
                m = x if math.isnan(m) and size else m
                at.append(m)
                m = (1 - a) ** size * m + b if size else m
            out[f"{n}_m"] = at
        return out

    def block_of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("nth_")
        out = rows[columns].copy()
        for n, (c, a) in means.items():
            x = pd.concat([rows[f"{n}_m"].iloc[:1], rows[c].astype("float64")])
            m = x.ewm(alpha=a, adjust=False).mean().iloc[1:]
            out[n] = m.where(rows[c].notna().to_numpy())
        return out

    heads = blocks.groupBy(*KEY).applyInPandas(states, "exchange string, symbol string, block_ long, " + ", ".join(f"{n}_m double" for n in means))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return t.join(heads, [*KEY, "block_"]).groupBy(*KEY, "block_").applyInPandas(block_of, f"{shape}, " + ", ".join(f"{n} double" for n in means))


def ema_cross(bars: DataFrame, fast: int = 9, slow: int = 21) -> DataFrame:
    """Buy where the fast mean crosses above the slow one, sell below; confidence is the gap over 1 % of the slow mean, at most 1."""
    b = recursive_means(bars.where("close is not null").select(*KEY, "ts", "close"), {"fast": ("close", 2 / (fast + 1)), "slow": ("close", 2 / (slow + 1))})
    gap = F.col("fast") - F.col("slow")
    b = over_days(b, sums={"nth": F.lit(1)}, priors={"gap0": gap}, order=("ts",))
    up, down = (F.col("gap0") <= 0) & (gap > 0), (F.col("gap0") >= 0) & (gap < 0)
    action = F.when(F.col("nth") < slow + 1, "hold").when(up, "buy").when(down, "sell").otherwise("hold")
    return b.select(*KEY, "ts", "close", "fast", "slow", action.alias("action"), F.when(action != "hold", F.least(F.lit(1.0), F.abs(gap) / (F.col("slow") * 0.01))).otherwise(0.0).alias("confidence"))


def rsi_signal(bars: DataFrame, period: int = 14, low: float = 30.0, high: float = 70.0) -> DataFrame:
    """Wilder's index; buy where it rises through ``low``, sell where it falls through ``high``; confidence is how far beyond the threshold it had been."""
    b = over_days(bars.where("close is not null").select(*KEY, "ts", "close"), priors={"close0": F.col("close")}, order=("ts",))
    move = F.col("close") - F.col("close0")
    b = b.select(*KEY, "ts", "close", F.when(move.isNotNull(), F.greatest(move, F.lit(0.0))).alias("up"), F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0))).alias("down"))
    b = recursive_means(b, {"ups": ("up", 1 / period), "downs": ("down", 1 / period)})
    up, down = F.nanvl("ups", F.lit(None).cast("double")), F.nanvl("downs", F.lit(None).cast("double"))
    b = b.select(*KEY, "ts", "close", F.when(down == 0, 100.0).otherwise(100 - 100 / (1 + up / down)).alias("rsi"))
    b = over_days(b, sums={"nth": F.lit(1)}, priors={"r0": F.struct("rsi")}, order=("ts",)).withColumn("r0", F.col("r0.rsi"))
    warm = F.col("nth") > period + 1
    up, down = warm & (F.col("r0") <= low) & (F.col("rsi") > low), warm & (F.col("r0") >= high) & (F.col("rsi") < high)
    conf = F.when(up, F.least(F.lit(1.0), (low - F.col("r0")) / low)).when(down, F.least(F.lit(1.0), (F.col("r0") - high) / (100 - high))).otherwise(0.0)
    return b.select(*KEY, "ts", "close", "rsi", F.when(up, "buy").when(down, "sell").otherwise("hold").alias("action"), conf.alias("confidence"))


def ofi_signal(bars: DataFrame, n: int = 30, threshold: float = 0.6) -> DataFrame:
    """Z-score of order flow in the last ``n`` known bars; buy above, sell below; confidence abs(z) / (2 threshold), at most 1."""
    def run(d: DataFrame, keys: list[str]) -> DataFrame:
        w = last_n(keys, n)
        std, full = F.stddev_samp("ofi").over(w), F.count(F.lit(1)).over(w) == n
        return d.withColumn("z", F.when(full & (std > 0), (F.col("ofi") - F.avg("ofi").over(w)) / std))

    b = in_blocks(bars.where("ofi is not null"), n, run)
    action = F.when(F.col("z") > threshold, "buy").when(F.col("z") < -threshold, "sell").otherwise("hold")
    return b.select(*KEY, "ts", "z", action.alias("action"), F.when(action != "hold", F.least(F.lit(1.0), F.abs("z") / (2 * threshold))).otherwise(0.0).alias("confidence"))


def funding_signal(rates: DataFrame, bps: float = 5.0) -> DataFrame:
    """Sell above the threshold, buy below minus it."""
    limit, r = bps / 10_000, F.col("funding_rate")
    action = F.when(r > limit, "sell").when(r < -limit, "buy").otherwise("hold")
    return rates.withColumn("action", action).withColumn("confidence", F.when(action != "hold", F.least(F.lit(1.0), F.abs(r) / (2 * limit))).otherwise(0.0))


def lookback_gate(df: DataFrame, n: int, needed: list[str]) -> DataFrame:
    """``ready`` from the ``n``-th row on where no needed column is null."""
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(c).isNotNull()
    return numbered(df).withColumn("ready", (F.col("nth") >= n) & whole).drop("nth")


def gap_gate(df: DataFrame, n: int) -> DataFrame:
    """``clean`` once ``n`` bars without a gap have followed the last one."""
    last = over_days(numbered(df), lasts={"gap_at": F.when(F.col("gap_count") > 0, F.col("nth"))}, order=("ts",))
    return last.withColumn("clean", F.coalesce(F.col("nth") - F.col("gap_at") >= n, F.lit(True))).drop("nth", "gap_at")


def gap_fraction(df: DataFrame) -> DataFrame:
    """W21."""
    share = F.avg(F.when(F.col("gap_count") > 0, 1.0).otherwise(0.0))
    return df.groupBy(*KEY).agg(share.alias("gap_fraction"), (share > 0.05).alias("warn"))


def data_segments(bars: DataFrame) -> DataFrame:
    """Runs of valid bars (a close and no gap): start, end, bars."""
    ok = F.col("close").isNotNull() & (F.coalesce("gap_count", F.lit(0)) == 0)
    b = over_days(bars, sums={"island": F.when(ok, 0).otherwise(1)}, order=("ts",)).where(ok)
    return b.groupBy(*KEY, "island").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("bars")).drop("island")


def coverage(segments: DataFrame) -> DataFrame:
    """Usable bars, gaps between segments and their seconds."""
    w = Window.partitionBy(*KEY).orderBy("start")
    hole = F.unix_seconds(F.lead("start").over(w)) - F.unix_seconds("end")
    s = segments.withColumn("hole", hole)
    return s.groupBy(*KEY).agg(F.count(F.lit(1)).alias("segments"), F.count("hole").alias("gaps"), F.sum("bars").alias("usable_bars"), F.coalesce(F.sum("hole"), F.lit(0)).alias("gap_seconds"), F.max("hole").alias("longest_gap"))


def mask_gaps(bars: DataFrame) -> DataFrame:
    """Numeric columns of bars with a gap become null, then bars without a close are dropped."""
    hit = F.col("gap_count") > 0
    numeric = [c for c, t in bars.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint") and c != "gap_count"]
    return bars.select(*[F.when(~hit | hit.isNull(), F.col(c)).alias(c) if c in numeric else F.col(c) for c in bars.columns]).where("close is not null")


def time_gaps(bars: DataFrame, seconds: int) -> DataFrame:
    """Neighbouring bars further apart than ``seconds``."""
    b = over_days(bars.select(*KEY, "ts"), priors={"before": F.col("ts")}, order=("ts",))
    b = b.where("before is not null").select(*KEY, F.col("before").alias("ts"), F.col("ts").alias("next_ts")).withColumn("gap_seconds", F.unix_seconds("next_ts") - F.unix_seconds("ts"))
    return b.where(F.col("gap_seconds") > seconds)


def cvd(bars: DataFrame) -> DataFrame:
    """Cumulative delta with its positive and negative parts."""
    net = 2 * F.coalesce("buy_volume", F.lit(0.0)) - F.coalesce("volume", F.lit(0.0))
    return over_days(bars.select(*KEY, "ts", net.alias("net")), sums={"cvd": F.col("net")}, order=("ts",)).drop("net").select("*", F.greatest("cvd", F.lit(0.0)).alias("cvd_pos"), F.least("cvd", F.lit(0.0)).alias("cvd_neg"))


#: User signals: name -> function of a DataFrame that adds action, confidence and reason.
SIGNALS: dict = {}


def register_signal(name: str, fn) -> None:
    SIGNALS[name] = fn


def apply_signal(name: str, df: DataFrame) -> DataFrame:
    out = SIGNALS[name](df)
    lacking = {"action", "confidence", "reason"} - set(out.columns)
    if lacking:
        raise ValueError(f"signal {name} lacks {sorted(lacking)}")
    return out
