"""Values that follow from the rules, on small inputs."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
TICK = "exchange string, symbol string, seq long, ts timestamp, msg_type string, event_type string, side string, price double, size double, price_str string, size_str string, seq_before long, seq_after long, gap_cause string, ingest_id long"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def tick(seq, kind, side=None, price=None, size=None, s=None, msg="tick", cause=None):
    return ("x", "A", seq, at(seq if s is None else s), msg, kind, side, price, size, None if price is None else str(price), None if size is None else str(size), None, None, cause, seq)


def got(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("ts").collect()]


def book_rows():
    """Updates that a snapshot voids, then a book whose best bid and best ask both come and go."""
    void = [tick(k, "update", side, p, 9.0) for k, (side, p) in enumerate([("sell", 30.0), ("buy", 29.0), ("buy", 28.5)], 1)]
    steps = [("buy", 19.5, 3.0), ("sell", 20.5, 2.0), ("buy", 19.25, 8.0), ("sell", 21.0, 6.0), ("buy", 18.75, 1.25), ("sell", 21.0, 0.75), ("buy", 19.75, 4.0)]
    live = [tick(8 + k, "update", *step) for k, step in enumerate(steps)]
    return [*void, tick(7, "snapshot", msg="snapshot"), *live, tick(15, "trade", "sell", 19.75, 1.0), tick(16, "update", "buy", 19.75, 0.0), tick(17, "update", "sell", 20.5, 0.0)]


def test_book_replay(spark):
    from tidemark.operators import book

    t = spark.createDataFrame(book_rows(), TICK)
    quotes = {r["seq"]: (r["bid"], r["bid_size"], r["ask"], r["ask_size"]) for r in book.best_quotes(t).collect()}
    assert quotes[8] == (None,) * 4 and quotes[15] == (19.75, 4.0, 20.5, 2.0) and quotes[17] == (19.5, 3.0, 21.0, 0.75)
    live = book.level_intervals(t).where("to_seq is null and epoch = 1")
    assert sorted((r["side"], r["price"], r["size"]) for r in live.collect()) == [("buy", 18.75, 1.25), ("buy", 19.25, 8.0), ("buy", 19.5, 3.0), ("sell", 21.0, 0.75)]
    kinds = {r["seq"]: r["kind"] for r in book.update_kind(t).collect()}
    assert (kinds[8], kinds[13], kinds[14], kinds[16]) == ("add", "modify", "add", "cancel")
    assert book.cold_start_filter(t).where("seq < 7").count() == 0


def test_quotes_across_midnight(spark):
    from tidemark.operators import book

    rows = [tick(1, "update", "buy", 10.0, 1.0, s=80000), tick(2, "update", "sell", 12.0, 1.0, s=80001), tick(3, "trade", "buy", 11.0, 1.0, s=90000), tick(4, "update", "buy", 11.0, 2.0, s=180000), tick(5, "trade", "sell", 11.0, 1.0, s=270000), tick(6, None, msg="gap", s=270001, cause="sequence_gap"), tick(7, "trade", "sell", 11.0, 1.0, s=270002)]
    q = {r["seq"]: (r["bid"], r["ask"]) for r in book.best_quotes(spark.createDataFrame(rows, TICK)).collect()}
    assert q == {1: (None, None), 2: (10.0, 12.0), 3: (10.0, 12.0), 4: (11.0, 12.0), 5: (11.0, 12.0), 6: (None, None), 7: (None, None)}


def trade_rows():
    return [tick(1, "trade", "buy", 100.0, 1.0, s=0), tick(2, "trade", "buy", 102.0, 2.0, s=10), tick(3, "trade", "sell", 101.0, 3.0, s=40), tick(4, "trade", "sell", 99.0, 0.0, s=41), tick(5, "trade", "buy", 105.0, 4.0, s=60)]


def test_trade_fields(spark):
    from tidemark.operators import bars as B
    from tidemark.sources.adapter import trades

    t = trades(spark.createDataFrame(trade_rows(), TICK))
    assert got(B.ohlcv(t, "1m"), "open", "high", "low", "close", "volume", "trade_count") == [(100, 102, 100, 101, 6, 3), (105, 105, 105, 105, 4, 1)]
    assert got(B.twap(t, "1m"), "twap") == [((100 * 10 + 102 * 30 + 101 * 20) / 60,), (105,)]
    assert got(B.max_run(t, "1m"), "max_consecutive_run") == [(2,), (1,)]
    assert got(B.tick_counts(t, "1m"), "uptick_count", "downtick_count") == [(1, 1), (0, 0)]
    assert got(B.interval_std(t, "1m"), "inter_trade_interval_std_ms") == [(10_000.0,)]
    assert got(B.interval_gini(t, "1m"), "trade_clustering") == [(pytest.approx((-1 * 10 + 1 * 30) / (2 * 40)),)]
    one = B.hawkes(spark.createDataFrame([tick(1, "trade", "buy", 1.0, 1.0, s=0.5), tick(2, "trade", "buy", 1.0, 1.0, s=0.6), tick(3, "trade", "buy", 1.0, 1.0, s=2.0)], TICK), "1m")
    want = 0.8 * (1 + math.exp(-10 * 1.4) + math.exp(-10 * 1.5))
    assert got(one, "hawkes_intensity")[0][0] == pytest.approx(want)
    assert B.ohlcv(t.limit(0), "1m").count() == 0


def test_bars_are_invariant_under_resampling(spark):
    from tidemark.operators import bars as B
    from tidemark.operators import cascade
    from tidemark.plans.registry import Data

    d = Data(spark, "/root/testdata/sf0.001")
    whole = d.bars4.agg(F.sum("volume"), F.sum("trade_count")).first()
    day = cascade.resample(d.bars4, "1d")
    assert day.agg(F.sum("volume"), F.sum("trade_count")).first() == whole
    direct = {(r["exchange"], r["symbol"], r["ts"]): (r["open"], r["high"], r["low"], r["close"]) for r in B.ohlcv(d.trades, "1d").collect()}
    assert {(r["exchange"], r["symbol"], r["ts"]): (r["open"], r["high"], r["low"], r["close"]) for r in day.collect()} == direct
    assert d.bars4.where("low > open or low > close or high < open or high < close").count() == 0
    assert d.fp.agg(F.sum(F.col("b") + F.col("s"))).first()[0] == whole[0]


def test_resample_rules(spark):
    """Four bars of 30 s, of which three fall into the first 90 s; quarters of prices make every sum exact."""
    from tidemark.operators import cascade, footprint

    names = "open double, high double, low double, close double, volume double, spread_high double, buy_volume double"
    steps = [(8.25, 8.75, 8.0, 8.5, 3.0, 0.25, 2.0), (8.5, 9.5, 8.5, 9.25, 1.0, 0.75, 0.0), (9.25, 9.25, 7.5, 7.75, 4.0, 0.5, 1.5), (7.75, 8.0, 7.25, 8.0, 2.0, 0.25, 2.0)]
    b = spark.createDataFrame([("x", "A", T0 + dt.timedelta(seconds=30 * i), *v) for i, v in enumerate(steps)], f"exchange string, symbol string, ts timestamp, {names}")
    out = got(cascade.resample(b, "1m"), "open", "high", "low", "close", "volume", "buy_volume", "spread_high")
    assert out == [(8.25, 9.5, 8.0, 9.25, 4.0, 2.0, 0.75), (9.25, 9.25, 7.25, 8.0, 6.0, 3.5, 0.5)]
    days = [("x", "A", dt.datetime(2024, 3, d), float(d), 2.0) for d in (3, 4, 10, 11)]  # a Sunday, Monday to Sunday, a Monday
    w = cascade.resample(spark.createDataFrame(days, "exchange string, symbol string, ts timestamp, close double, volume double"), "1w")
    assert got(w, "close", "volume") == [(3, 2), (10, 4), (11, 2)]
    cells = ['{"7.5":{"b":0.25,"s":4}}', '{"7.5":{"b":1.5,"s":0},"7.25":{"b":2,"s":0.5}}', '{"7.5":', None]
    f = spark.createDataFrame([("x", "A", T0, c) for c in cells] + [("x", "B", T0, None)], "exchange string, symbol string, ts timestamp, footprint_json string")
    merged = {r["symbol"]: r["footprint_json"] for r in footprint.merge_footprints(f, "1m").collect()}
    assert merged["B"] is None and '"7.5":{"b":1.75,"s":4.0}' in merged["A"] and '"7.25":{"b":2.0,"s":0.5}' in merged["A"]


def test_statistics():
    from tidemark.operators.rolling import adf_of, hurst_of

    rng = np.random.default_rng(1)
    assert 0.3 <= hurst_of(rng.normal(size=400)) <= 0.7
    x = np.zeros(400)
    for i in range(1, 400):
        x[i] = -0.7 * x[i - 1] + rng.normal()
    assert hurst_of(x) < 0.5
    assert adf_of(np.cumsum(rng.normal(size=200))) > 0.05 and adf_of(x[:200]) < 0.01 and adf_of(np.ones(60)) == 1.0


def test_hedge_ratio(spark):
    from tidemark.operators.rolling import kalman_hedge

    rng = np.random.default_rng(2)
    b = np.exp(4 + np.cumsum(rng.normal(0, 0.01, 200)))
    rows = [("x", at(i), float(b[i] ** 2 * math.exp(rng.normal(0, 0.001))), float(b[i])) for i in range(200)]
    out = kalman_hedge(spark.createDataFrame(rows, "exchange string, ts timestamp, mid_a double, mid_b double")).orderBy("ts").collect()
    assert 1.5 < out[-1]["hedge_ratio"] < 2.5


def test_purged_folds(spark):
    from tidemark.operators.ledger import purged_folds

    out = purged_folds(spark.range(1000).select(F.lit("k").alias("k"), F.col("id")), 5, 5, ["k"], ["id"]).groupBy("fold", "part").agg(F.min("id").alias("a"), F.max("id").alias("b")).collect()
    ends = {(r["fold"], r["part"]): (r["a"], r["b"]) for r in out}
    assert ends and all(ends[(f, "test")][0] - ends[(f, "train")][1] > 5 for f, p in ends if p == "test")


def test_reversion_labels(spark):
    from tidemark.operators.rolling import reversion_labels

    def label(values, hurst):
        df = spark.createDataFrame([("x", "A", at(i), float(v), hurst) for i, v in enumerate(values)], "exchange string, symbol string, ts timestamp, microprice_mid_delta double, hurst_60 double")
        return [x for (x,) in got(reversion_labels(df, [1], 1.0), "label_revert_1")]

    assert label([5, 1, 0], 0.3)[0] == "REVERT" and label([5, 1, 0], 0.6)[0] == "FLAT" and label([2, 5, 0], 0.3)[0] == "TREND" and label([5, 1, 9], 0.3)[-1] == "FLAT"


def test_average_cost(spark):
    from tidemark.operators.ledger import realize_pnl

    rows = [("s", "x", "A", at(i), i, f"o{i}", side, p, q) for i, (side, p, q) in enumerate([("buy", 10.0, 1.0), ("buy", 20.0, 1.0), ("sell", 18.0, 1.5), ("sell", 30.0, 5.0), ("sell", 30.0, 1.0), ("buy", 7.0, 2.0)])]
    f = spark.createDataFrame(rows, "strategy string, exchange string, symbol string, ts timestamp, seq long, order_id string, side string, price double, size double")
    assert got(realize_pnl(f), "realized_pnl", "position_size_after", "avg_cost") == [(0, 1, 10), (0, 2, 15), (4.5, 0.5, 15), (7.5, 0, 0), (0, 0, 0), (0, 2, 7)]


def test_wire_messages(spark):
    from tidemark.sources import normalize as n

    raw = spark.createDataFrame(
        [
            ("bybit", '{"topic":"orderbook.50.ETHUSDT","type":"delta","ts":7000,"data":{"s":"ETHUSDT","b":[["61.25","0"],["","3"]],"a":[["61.75","0.5"]],"u":7}}'), ("bybit", "junk"),
            ("kucoin", '{"topic":"/market/level2:ETH-USDT","data":{"sequenceStart":40,"sequenceEnd":41,"changes":{"bids":[["60.5","2.25",40]],"asks":[["62","0","41"]]},"time":7000}}'),
        ],
        "exchange string, body string",
    )
    good, bad = n.normalize_bybit_book(raw)
    assert sorted((r["symbol"], r["side"], r["price"], r["size"], r["seq"]) for r in good.collect()) == [("ETH-USDT", "buy", 61.25, 0.0, 7), ("ETH-USDT", "sell", 61.75, 0.5, 7)]
    assert sorted(r["reason"] for r in bad.collect()) == ["empty price", "unreadable"]
    assert sorted((r["seq"], r["msg_seq_start"], r["msg_seq_end"], r["side"]) for r in n.normalize_kucoin_book(raw).collect()) == [(40, 40, 41, "buy"), (41, None, 41, "sell")]


# ---- the unit of work does not show: days, blocks and chunks against plain loops -------------------
def random_ticks(n=300, keys=2, seed=1):
    import random

    rng, rows = random.Random(seed), []
    for k in range(keys):
        second = 0.0
        for i in range(n):
            second += rng.choice([1, 40, 3000, 30_000])
            msg = rng.choices(["tick", "gap", "snapshot"], [20, 1, 1])[0]
            kind = {"tick": rng.choice(["trade", "update"]), "gap": None, "snapshot": "snapshot"}[msg]
            row = list(tick(i, kind, rng.choice(["buy", "sell"]), float(rng.randrange(95, 105)), float(rng.randrange(0, 4)), s=second, msg=msg, cause=rng.choice(["internal_merge_error", "sequence_gap"]) if msg == "gap" else None))
            row[1] = f"K{k}"
            rows.append(tuple(row))
    return rows


def test_running_values_over_days(spark):
    from tidemark.core import over_days

    rows = random_ticks()
    df = spark.createDataFrame(rows, TICK)
    out = over_days(df, sums={"s": F.col("size")}, lasts={"l": F.when(F.col("side") == "buy", F.col("price"))}, priors={"p": F.when(F.col("side") == "buy", F.col("price"))}, tops={"t": F.col("price")})
    got = {(r["symbol"], r["seq"]): (r["s"], r["l"], r["p"], r["t"]) for r in out.collect()}
    state = {}
    for r in rows:
        total, last, top = state.get(r[1], (0.0, None, None))
        now = r[7] if r[6] == "buy" else last
        assert got[(r[1], r[2])] == (total + r[8], now, last, top)
        state[r[1]] = (total + r[8], now, max(r[7], top or 0))


def test_windows_over_blocks(spark, monkeypatch):
    from tidemark import core
    from tidemark.operators import rolling

    rng = np.random.default_rng(3)
    rows = [("x", s, at(i * 7000), float(x), float(y), float(z)) for s in ("A", "B", "C") for i, (x, y, z) in enumerate(np.exp(rng.normal(0, 0.02, ({"A": 95, "B": 31, "C": 3}[s], 3))))]
    df = spark.createDataFrame(rows, "exchange string, symbol string, ts timestamp, mid double, ofi_l1 double, spread_mean double").withColumns({"close": F.col("mid"), "ofi": F.col("ofi_l1"), "microprice_mid_delta": F.col("ofi_l1") - 1, "hurst_60": F.lit(0.3), "ofi_l1_sg": F.col("ofi_l1")})
    pair = df.where("symbol <> 'C'").groupBy("exchange", "ts").pivot("symbol", ["A", "B"]).agg(F.first("mid")).where("A is not null and B is not null").select("exchange", "ts", F.col("A").alias("mid_a"), F.col("B").alias("mid_b"), F.lit(1.0).alias("hedge_ratio"))
    sizes = spark.createDataFrame([(*r[:2], i, r[2], r[3]) for i, r in enumerate(rows)], "exchange string, symbol string, seq long, ts timestamp, size double")

    def everything():
        z = rolling.spread_zscore(pair, 8)
        frames = [
            rolling.classify_regime(df, 10), rolling.savgol5(df, "mid"), rolling.savgol5(df, "mid", "centered"), rolling.hurst(df.drop("hurst_60"), 20), rolling.ou_halflife(df, 9), rolling.kyle_lambda(df, 12), rolling.ofi_signal(df, 7), rolling.reversion_labels(df, [1, 3], 1.0), z, rolling.adf_pvalue(z, 10),
            rolling.spread_labels(z.withColumn("adf_pvalue_60", F.lit(0.01)), 4, z_min=0.5), rolling.block_threshold(sizes, 13, 5),
        ]
        return [sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in f.collect()) for f in frames]

    whole = everything()
    monkeypatch.setattr(core, "BLOCK", 1)  # as small as the longest frame
    assert everything() == whole
    held = [r[3] for r in rows if r[1] == "A"]
    got = {r["ts"]: r["threshold"] for r in rolling.block_threshold(sizes.where("symbol = 'A'"), 13, 5).collect()}
    for i in range(len(held)):
        frame = sorted(held[max(0, i - 12) : i + 1])
        assert got[at(i * 7000)] == (frame[math.ceil(0.99 * len(frame)) - 1] if len(frame) >= 5 else None)


def test_recursions_over_blocks(spark, monkeypatch):
    from tidemark import core
    from tidemark.operators.rolling import filtered, kalman_hedge, recursive_means

    monkeypatch.setattr(core, "BLOCK", 13)
    rng = np.random.default_rng(4)
    a, b = np.exp(rng.normal(3, 0.1, 200)), np.exp(rng.normal(2, 0.1, 200))
    df = spark.createDataFrame([("x", at(i * 9000), float(x), float(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))], "exchange string, ts timestamp, mid_a double, mid_b double")
    for beta0 in (None, 1.25):
        want, _, _ = filtered(np.log(a), np.log(b), math.log(a[0]) / math.log(b[0]) if beta0 is None else beta0, 1.0, 1e-5, 1e-3)
        assert [x for (x,) in got(kalman_hedge(df, beta0), "hedge_ratio")] == pytest.approx(want.tolist(), rel=1e-9)
    bars = df.select("exchange", F.lit("A").alias("symbol"), "ts", F.col("mid_a").alias("close"))
    out = got(recursive_means(bars, {"m": ("close", 0.2)}), "m")
    state = a[0]
    for (x,), value in zip(out, a, strict=True):
        state = 0.2 * value + 0.8 * state
        assert x == pytest.approx(state)


def test_average_cost_of_decimals(spark, monkeypatch):
    """Decimal prices and sizes give what doubles give, in books of one block and of many."""
    from tidemark import core
    from tidemark.operators.ledger import realize_pnl

    rows = [("s", "x", "A", at(i * 20_000), i, f"o{i}", "sell" if i % 3 == 2 else "buy", float(5 + i % 4), float(1 + i % 2)) for i in range(30)]
    f = spark.createDataFrame(rows, "strategy string, exchange string, symbol string, ts timestamp, seq long, order_id string, side string, price double, size double")
    d = f.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("price", "size")})
    want = got(realize_pnl(f), "realized_pnl", "position_size_after", "avg_cost")
    assert got(realize_pnl(d), "realized_pnl", "position_size_after", "avg_cost") == want
    monkeypatch.setattr(core, "BLOCK", 7)
    assert got(realize_pnl(d), "realized_pnl", "position_size_after", "avg_cost") == [tuple(pytest.approx(v) for v in r) for r in want]


def test_average_cost_over_blocks(spark, monkeypatch):
    import random

    from tidemark import core

    from tidemark.operators.ledger import realize_pnl

    monkeypatch.setattr(core, "BLOCK", 7)
    rng = random.Random(5)
    rows = [(k, "x", "A", at(i * 20_000), i, f"o{i}", rng.choice(["buy", "sell"]), float(rng.randrange(5, 20)), float(rng.randrange(1, 6))) for k in ("s", "t") for i in range(120)]
    f = spark.createDataFrame(rows, "strategy string, exchange string, symbol string, ts timestamp, seq long, order_id string, side string, price double, size double")
    result = {(r["strategy"], r["nth"]): (r["realized_pnl"], r["position_size_after"], r["avg_cost"]) for r in realize_pnl(f).collect()}
    for k in ("s", "t"):
        held = cost = 0.0
        for r in (r for r in rows if r[0] == k):
            _, _, _, _, i, _, side, p, q = r
            gain = 0.0
            if side == "buy":
                cost, held = (cost * held + p * q) / (held + q), held + q
            else:
                sold = min(q, held)
                gain, held = sold * (p - cost), held - sold
                cost = cost if held else 0.0
            assert result[(k, i + 1)] == pytest.approx((gain, held, cost))


def test_holding_over_blocks(spark, monkeypatch):
    import random

    from tidemark import core

    from tidemark.operators.ledger import strategy_hold_k

    monkeypatch.setattr(core, "BLOCK", 3)
    rng = random.Random(6)
    rows = [("x", s, at(i * 15_000), 10.0, rng.choice([9.0, 11.0, 12.0, None])) for s in ("A", "B") for i in range(100)]
    out = strategy_hold_k(spark.createDataFrame(rows, "exchange string, symbol string, ts timestamp, open double, close double"), 4).collect()
    for s in ("A", "B"):
        bars, i, want = [r for r in rows if r[1] == s and r[4] is not None], 0, []
        while i < len(bars):
            if bars[i][4] > bars[i][3]:
                late = bars[i + 4] if i + 4 < len(bars) else None
                want.append((bars[i][2], late and late[2], bars[i][4], late and late[4]))
                i += 4
            else:
                i += 1
        assert sorted((r["entry_ts"], r["exit_ts"], r["entry_price"], r["exit_price"]) for r in out if r["symbol"] == s) == want


def test_live_book_keeps_state_between_triggers():
    import json
    import random

    from tidemark.streaming.ticks import LiveBook

    rng, plain, live = random.Random(7), ({}, {}), LiveBook()
    for i in range(2000):
        side, price, size = rng.randrange(2), float(rng.randrange(90, 110)), float(rng.choice([0, 0, 1, 2]))
        live.set(side, price, size)
        plain[side].pop(price, None)
        if size:
            plain[side][price] = size
        if i % 97 == 0:
            live = LiveBook(json.loads(live.stored()))
        b, a = max(plain[0], default=None), min(plain[1], default=None)
        assert live.best() == ((b, plain[0][b], a, plain[1][a]) if b is not None and a is not None else (None,) * 4)


def test_path_summary_over_months(spark):
    """Drawdowns, time under water and streaks that cross months against loops; books of one trade, of gains only and of losses only."""
    import random

    from tidemark.operators.ledger import path_summary

    rng = random.Random(12)
    books = {f"b{k}": [rng.choice([-3.0, -1.0, 0.0, 1.0, 2.5]) for _ in range(n)] for k, n in enumerate((60, 200, 1, 7))} | {"up": [1.0] * 50, "down": [-1.0] * 50}
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(days=3 * i), i, p) for k, v in books.items() for i, p in enumerate(v)]
    rng.shuffle(rows)
    got = {r["book"]: tuple(r)[1:] for r in path_summary(spark.createDataFrame(rows, "book string, exit_ts timestamp, seq long, net_pnl double"), 20.0, ["book"]).collect()}
    for k, v in books.items():
        equity = peak = 20.0
        depth = share = 0.0
        runs, best = [0, 0, 0], [0, 0, 0]
        for p in v:
            equity += p
            peak = max(peak, equity)
            depth, share = max(depth, peak - equity), max(share, (peak - equity) / peak * 100)
            for i, hit in enumerate((equity < peak, p > 0, not p > 0)):
                runs[i] = runs[i] + 1 if hit else 0
                best[i] = max(best[i], runs[i])
        assert got[k] == (pytest.approx(depth), pytest.approx(share), *best), k
