"""Operators that must do the whole job: every book, every candidate, every feature."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"
TRADE = "strategy string, exchange string, symbol string, entry_ts timestamp, exit_ts timestamp, gross_pnl double, net_pnl double, seq long"


def trades_of(spark, books):
    rows = [(*b, T0 + dt.timedelta(days=i), T0 + dt.timedelta(days=i), float(x) + 0.01, float(x), i) for b, xs in books.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, TRADE)


def bootstrap(pnls, paths=10_000, seed=1):
    rng = np.random.default_rng(seed)
    return np.percentile(rng.choice(pnls, (paths, len(pnls))).sum(1), 5)


def test_bootstrap_of_every_book(spark):
    from tidemark.operators.ledger import monte_carlo_p5

    rng = np.random.default_rng(3)
    books = {("a", "x", "A"): rng.normal(2, 30, 60), ("a", "x", "B"): rng.normal(-5, 3, 25), ("b", "y", "A"): [4.0] * 7, ("b", "y", "B"): [-2.5]}
    t = trades_of(spark, books)
    for block in (8192, 4):  # a book in one block, and in many
        got = {(r["strategy"], r["exchange"], r["symbol"]): r for r in monte_carlo_p5(t, 10_000, block=block).collect()}
        assert set(got) == set(books)
        for book, pnls in books.items():
            assert got[book]["trades"] == len(pnls)
            assert got[book]["p5"] == pytest.approx(bootstrap(np.array(pnls)), abs=0.1 * np.std(pnls) * len(pnls) ** 0.5 + 1e-6)


def test_draws_of_blocks_add_up():
    from tidemark.operators.ledger import draws_in_block

    counts = np.array([draws_in_block(7, 5, 103, k, 10, 20_000) for k in range(11)])
    assert (counts.sum(0) == 103).all()
    size = np.array([10] * 10 + [3])
    assert counts.mean(1) == pytest.approx(size, abs=0.1) and counts.var(1) == pytest.approx(size * (1 - size / 103), rel=0.06)


def test_registered_bootstrap_has_every_book(spark):
    from tidemark.operators.ledger import BOOK
    from tidemark.plans import all_queries
    from tidemark.plans.registry import Data

    got = {tuple(r[c] for c in BOOK): r["trades"] for r in all_queries()["l18_monte_carlo_p5"](spark, SF).collect()}
    want = {tuple(r[c] for c in BOOK): r["n"] for r in Data(spark, SF).paired.groupBy(*BOOK).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want and len(got) > 100


def test_verdict_uses_each_books_results(spark):
    from tidemark.operators.ledger import BOOK, validation_inputs, validation_verdict

    rng = np.random.default_rng(5)
    books = {("good", "x", "A"): rng.normal(10, 2, 50), ("fades", "x", "A"): [*rng.normal(10, 1, 10), *rng.normal(1, 3, 40)], ("crash", "x", "A"): [*[5.0, 6.0] * 20, *[-45.0, -46.0] * 5], ("short", "x", "A"): [9.0, 8.0]}
    day = lambda n: (T0 + dt.timedelta(days=n)).date()
    w = spark.createDataFrame([("early", day(0), day(9)), ("late", day(40), day(60)), ("none", day(900), day(901))], "name string, first_day date, last_day date")
    cash = 1000.0
    inputs = validation_inputs(trades_of(spark, books), w, cash)
    got = {r["strategy"]: r for r in validation_verdict(inputs).collect()}
    assert len(got) == 4 and set(BOOK) <= set(inputs.columns)

    def depth(x):
        equity = cash + np.cumsum(x)
        peak = np.maximum(cash, np.maximum.accumulate(equity))
        return ((peak - equity) / peak).max()

    for (name, _, _), x in books.items():
        x, r = np.array(x), got[name]
        size = len(x) // 5
        parts = [(x[: k * size], x[k * size : (k + 1) * size]) for k in range(1, 5)] if size else []
        ratio = lambda v: v.mean() / v.std(ddof=1) if len(v) > 1 and v.std(ddof=1) > 0 else 0.0
        if parts:
            assert r["sharpe"] == pytest.approx(np.mean([ratio(o) for _, o in parts]))
            assert r["max_drawdown"] == pytest.approx(np.mean([depth(o) for _, o in parts]))
            assert r["degradation"] == pytest.approx(np.mean([1 - ratio(o) / ratio(i) if ratio(i) else 0.0 for i, o in parts]))
        else:
            assert r["sharpe"] is None and "sharpe" in r["failures"]
        assert r["worst_stress"] == pytest.approx(max(depth(v) if len(v) else 0.0 for v in (x[:10], x[40:])))
        assert r["p5"] == pytest.approx(bootstrap(x), abs=0.1 * np.std(x) * len(x) ** 0.5 + 1e-6)
    fails = {k: set(r["failures"].split(",")) for k, r in got.items()}
    assert got["good"]["passed"] and {"degradation"} <= fails["fades"] and {"monte_carlo", "stress"} <= fails["crash"]


def feature_bars(spark, n, micro=True):
    rng = np.random.default_rng(2)
    mid = 100 + np.cumsum(rng.normal(0, 1, n))
    num = lambda x: float(x)
    rows = [("x", "A", T0 + dt.timedelta(hours=i), num(m - 1), num(m + 1), num(rng.normal()), 2.0 + i % 3, 5.0, 3.0, 4.0, 1.0 + i % 5, num(rng.normal(0, 9)) if micro and i % 7 else None, None if i % 4 == 0 else 0.5 + i % 2, i % 3, i % 2) for i, m in enumerate(mid)]
    return spark.createDataFrame(rows, "exchange string, symbol string, ts timestamp, best_bid double, best_ask double, ofi_l1 double, spread_mean double, volume double, buy_volume double, bid_depth_l1_close double, ask_depth_l1_close double, microprice_mid_delta double, hawkes_intensity double, bid_cancel_count long, ask_cancel_count long")


def test_features_are_all_built(spark):
    from tidemark.operators.ml import build_features

    bars = feature_bars(spark, 90)
    x = build_features(bars).orderBy("ts").toPandas()
    assert x["hurst_60"][:60].isna().all() and x["hurst_60"][60:].between(0, 1).all()
    assert x["ofi_x_spread"].to_numpy() == pytest.approx((x["ofi_l1_sg"] * x["spread_mean_sg"]).to_numpy())
    raw = bars.orderBy("ts").toPandas()
    delta = raw["microprice_mid_delta"].fillna(0).to_numpy()
    assert x["microprice_x_hawkes"].to_numpy() == pytest.approx(delta * raw["hawkes_intensity"].fillna(0).to_numpy())
    assert x["cancel_bias"].to_numpy() == pytest.approx(((raw["bid_cancel_count"] - raw["ask_cancel_count"]) / (raw["bid_cancel_count"] + raw["ask_cancel_count"] + 1)).to_numpy())
    for i in range(59, 90):
        y = delta[i - 59 : i + 1]
        phi = np.polyfit(y[:-1], y[1:], 1)[0]
        assert x["ou_halflife"][i] == pytest.approx(np.clip(-np.log(2) / np.log(phi), 1, 300) if 0 < phi < 1 else 60.0, rel=1e-6)


def test_features_without_a_delta(spark):
    from tidemark.operators.ml import build_features

    x = build_features(feature_bars(spark, 12, micro=False)).orderBy("ts").toPandas()
    mid = (x["best_bid"] + x["best_ask"]) / 2
    b, a = x["bid_depth_l1_close"], x["ask_depth_l1_close"]
    want = ((x["best_ask"] * b + x["best_bid"] * a) / (b + a + 1e-9) - mid) / mid * 10000
    assert x["microprice_mid_delta"].to_numpy() == pytest.approx(want.to_numpy()) and (x["microprice_x_hawkes"] == 0).all()


def test_model_features_have_real_regimes_and_hurst(spark):
    from tidemark.plans import source_queries as q
    from tidemark.plans.registry import Data

    f = q._features(Data(spark, SF))
    assert f.agg(F.count_distinct("hurst_60")).first()[0] > 20 and f.where("regime in ('THIN_BOOK', 'TRENDING_UP', 'TRENDING_DOWN')").count() > 0


# ---- clusters, scores and statistics against plain computations --------------------------------------
def test_rolling_exponent_and_unit_root_of_each_frame(spark):
    from tidemark.operators.rolling import adf_of, adf_pvalue, hurst, hurst_of

    rng = np.random.default_rng(10)
    mid = np.exp(np.cumsum(rng.normal(0, 0.01, 150)))
    df = spark.createDataFrame([("x", "A", T0 + dt.timedelta(hours=i), float(m), float(m) - 1) for i, m in enumerate(mid)], "exchange string, symbol string, ts timestamp, mid double, spread double")
    r = np.concatenate([[0.0], np.diff(np.log(mid))])
    for i, row in enumerate(hurst(df, 60).orderBy("ts").collect()):
        assert row["hurst_60"] == (pytest.approx(hurst_of(r[i - 59 : i + 1])) if i >= 60 else None)
    for i, row in enumerate(adf_pvalue(df, 60).orderBy("ts").collect()):
        assert row["adf_pvalue_60"] == pytest.approx(adf_of(mid[i - 60 : i] - 1) if i >= 60 else 1.0)


def test_flips_of_two_means(spark):
    from tidemark.operators.ledger import strategy_ema_flip

    rng = np.random.default_rng(11)
    close = np.exp(np.cumsum(rng.normal(0, 0.02, 300)))
    df = spark.createDataFrame([("x", "A", T0 + dt.timedelta(hours=i), float(c)) for i, c in enumerate(close)], "exchange string, symbol string, ts timestamp, close double")
    fast = slow = close[0]
    want, long, gap0 = [], False, None
    for i, c in enumerate(close):
        fast, slow = fast + (c - fast) * 2 / 10, slow + (c - slow) * 2 / 22
        gap = fast - slow
        if i >= 21 and gap0 is not None and ((gap0 <= 0 < gap and not long) or (gap0 >= 0 > gap and long)):
            long = gap > 0
            want.append((T0 + dt.timedelta(hours=i), "enter" if long else "exit"))
        gap0 = gap
    assert [(r["ts"], r["order"]) for r in strategy_ema_flip(df).orderBy("ts").collect()] == want and len(want) > 4


def test_scores_of_spreads(spark):
    """Gates without a model, and the best pair model behind them."""
    import datetime as dt

    from tidemark.operators import ml

    df = spark.createDataFrame([(None, 0.01), (float("nan"), 0.01), (1.5, 0.01), (2.0, 0.2), (2.0, None), (2.0, 0.1), (-9.0, 0.0)], "spread_z double, adf_pvalue_60 double")
    rows = ml.score_spread(df).collect()
    assert [r["reason"] for r in rows] == ["neutral_zone"] * 3 + ["adf_fail"] * 2 + ["no_spread_model"] * 2 and {(r["label"], r["confidence"], r["model_id"]) for r in rows} == {("NEUTRAL", 0.0, None)}
    rng = np.random.default_rng(2)
    kinds = ["CONVERGE", "NEUTRAL", "DIVERGE"]
    data = [("x", T0 + dt.timedelta(hours=i), 2.0 if i % 4 else 1.0, 0.05, kinds[k], float(3 * k + rng.normal(0, 0.2)), None) for i, k in enumerate(rng.integers(0, 3, 240))]
    pair = spark.createDataFrame(data, "exchange string, ts timestamp, spread_z double, adf_pvalue_60 double, label_spread string, f double, g double")
    registry = ml.train_spread(pair, ["f", "g"], folds=2)
    out = {r["ts"]: r for r in ml.score_spread(pair, registry).collect()}
    assert all(out[r[1]]["reason"] == ("neutral_zone" if r[2] < 1.5 else "model") for r in data) and all(out[r[1]]["label"] == "NEUTRAL" for r in data if r[2] < 1.5)
    assert np.mean([out[r[1]]["label"] == r[4] for r in data if r[2] > 1.5]) > 0.97 and {r["model_id"] for r in out.values()} == {None, registry.first()["model_id"]}
    other = registry.withColumn("regime", F.lit("RANGING"))
    assert {r["reason"] for r in ml.score_spread(pair, other).collect()} == {"neutral_zone", "no_spread_model"}
