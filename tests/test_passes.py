"""Operators on large tables take their input once, in bounded pieces."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
FILL = "strategy string, exchange string, symbol string, ts timestamp, seq long, order_id string, side string, price double, size double, limit_price double"


def counted_fills(spark, n=60, gap=5):
    """Fills of two books over some months, and an accumulator of how often a fill's price was computed."""
    seen = spark.sparkContext.accumulator(0)

    def look(p):
        seen.add(1)
        return p

    rows = [(b, "x", "A", T0 + dt.timedelta(days=gap * i), i, f"o{i}", "buy" if i % 3 else "sell", 10.0 + i % 7, 1.0 + i % 4, None) for b in ("a", "b") for i in range(n)]
    return spark.createDataFrame(rows, FILL).withColumn("price", F.udf(look, "double")("price")), seen, len(rows)


def test_average_cost_takes_fills_once(spark, monkeypatch):
    from tidemark import core
    from tidemark.operators.ledger import realize_pnl

    monkeypatch.setattr(core, "BLOCK", 4)
    fills, seen, n = counted_fills(spark)
    got = {(r["strategy"], r["nth"]): (r["position_size_after"], r["avg_cost"]) for r in realize_pnl(fills).collect()}
    assert len(got) == n and seen.value == n
    for b in ("a", "b"):
        held = cost = 0.0
        for i in range(n // 2):
            p, q = 10.0 + i % 7, 1.0 + i % 4
            if i % 3:
                cost, held = (cost * held + p * q) / (held + q), held + q
            else:
                held = max(held - q, 0.0)
                cost = cost if held else 0.0
            assert got[(b, i + 1)] == (pytest.approx(held), pytest.approx(cost))


def test_pairing_takes_fills_once(spark):
    """Trades against a plain loop over books whose months hold one fill or several; each fill is computed once."""
    from tidemark.operators.ledger import pair_trades

    for gap in (4, 40):
        fills, seen, n = counted_fills(spark, gap=gap)
        fills = fills.withColumn("side", F.when(F.col("seq") % 7 == 5, None).otherwise(F.col("side"))).withColumn("fee", F.lit(0.5))
        got = {(r["strategy"], r["seq"]): (r["entry_ts"], r["entry_price"], r["size"], r["net_pnl"]) for r in pair_trades(fills).collect()}
        assert seen.value <= n
        want = {}
        for b in ("a", "b"):
            entry = None
            for i in range(n // 2):
                if i % 7 == 5:
                    continue
                p, q = 10.0 + i % 7, 1.0 + i % 4
                if i % 3 == 0 and entry is not None:
                    size = min(q, entry[2])
                    want[(b, i)] = (entry[0], entry[1], size, pytest.approx((p - entry[1]) * size - 1.0))
                entry = (T0 + dt.timedelta(days=gap * i), p, q) if i % 3 else None
        assert got == want and want


TRADE = "strategy string, exchange string, symbol string, exit_ts timestamp, seq long, net_pnl double"


def test_paths_stay_spread_as_they_are(spark):
    """A month's results are many and its start is one row: the starts go to the months, not the months to a task of starts."""
    from tidemark.operators.ledger import path_summary

    trades = spark.range(20000).select(F.lit("a").alias("strategy"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 600).alias("exit_ts"), F.col("id").alias("seq"), F.sin("id").alias("net_pnl"))
    sent = path_summary(trades, 1000.0, ["strategy"])._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[1]
    assert "/starts-" in sent and "/months-" not in sent


def test_walk_forward_report_of_months_cut_by_segments(spark):
    """Folds against plain loops: many small months and few large ones, a book without a name, results that are null or all equal, trades without a time (last), books too small to fold; each trade is computed once."""
    from tidemark.operators.ledger import walk_forward_report

    rng, capital, k = np.random.default_rng(3), 100.0, 4
    books = {"small": [1.0] * 4, "equal": [0.1] * 23, None: rng.normal(0, 5, 61).tolist(), "a": [None if i % 9 == 4 else float(x) for i, x in enumerate(rng.normal(1, 8, 107))], "b": rng.normal(0, 3, 50).tolist()}
    for gap in (1, 45):
        seen = spark.sparkContext.accumulator(0)

        def look(p):
            seen.add(1)  # noqa: B023
            return p

        rows = [(b, "x", "A", None if b == "b" and i >= 43 else T0 + dt.timedelta(days=gap * (i // 2)), i, x) for b, xs in books.items() for i, x in enumerate(xs)]
        trades = spark.createDataFrame(rows, TRADE).withColumn("net_pnl", F.udf(look, "double")("net_pnl"))
        got = {(r["strategy"], r["fold"]): r for r in walk_forward_report(trades, k, "net_pnl", ["strategy", "exchange", "symbol"], capital).collect()}
        assert seen.value == len(rows) and set(got) == {(b, i) for b in books if b != "small" for i in range(1, k + 1)}
        for (b, fold), r in got.items():
            size = len(books[b]) // (k + 1)
            parts = [np.array([x for x in books[b][i:j] if x is not None]) for i, j in ((0, fold * size), (fold * size, (fold + 1) * size))]
            sharpe = [0.0 if b == "equal" else p.mean() / p.std(ddof=1) for p in parts]
            equity = capital + np.cumsum(parts[1])
            peak = np.maximum(capital, np.maximum.accumulate(equity))
            want = (*sharpe, *[p.sum() for p in parts], 1 - sharpe[1] / sharpe[0] if sharpe[0] else 0.0, 1 - parts[1].sum() / parts[0].sum(), ((peak - equity) / peak).max())
            assert tuple(r[c] for c in ("is_sharpe", "oos_sharpe", "is_pnl", "oos_pnl", "degradation", "pnl_degradation", "oos_drawdown")) == pytest.approx(want)


def test_ledger_curves_take_fills_once(spark):
    """Numbers, equity and peaks over months against plain loops; each fill is computed once."""
    from tidemark.operators import ledger

    wide = lambda: counted_fills(spark, gap=9)
    for run in (
        lambda f: ledger.equity_curve(f.withColumn("realized_pnl", F.col("price") - 13), ledger.BOOK),
        lambda f: ledger.position_metrics(f.withColumns({"realized_pnl": F.col("price") - 13, "avg_cost": F.lit(1.0), "position_size_after": F.col("size")}), ledger.BOOK).withColumnRenamed("cum_pnl", "equity"),
    ):
        fills, seen, n = wide()
        got = {(r["strategy"], r["nth"]): r for r in run(fills).collect()}
        assert len(got) == n and seen.value == n
        for b in ("a", "b"):
            equity, peak = 0.0, None if "peak" in got[(b, 1)] else 0.0
            for i in range(n // 2):
                equity += 10.0 + i % 7 - 13
                peak = equity if peak is None else max(peak, equity)
                assert (got[(b, i + 1)]["equity"], got[(b, i + 1)]["drawdown"]) == (pytest.approx(equity), pytest.approx(peak - equity))


def test_order_gates_take_requests_once(spark):
    from tidemark.operators.ledger import order_gates

    fills, seen, n = counted_fills(spark, gap=9)
    out = order_gates(fills.withColumn("intent", F.when(F.col("side") == "buy", "entry").otherwise("exit")), 60.0, 80.0).collect()
    assert len(out) == n and seen.value == n and {r["gate"] for r in out} > {"pass", "duplicate_entry"}


def test_bootstrap_is_spread_over_tasks(spark):
    """Few bytes, much work: partitions must not be put together by size."""
    from tidemark.operators.ledger import monte_carlo_p5

    rows = spark.createDataFrame([("a", "x", "A", float(i)) for i in range(40)], "strategy string, exchange string, symbol string, net_pnl double")
    assert "REPARTITION_BY_NUM" in monte_carlo_p5(rows, 100, block=4)._jdf.queryExecution().toString()


def test_dropped_rows_come_in_bounded_files(spark, monkeypatch):
    from tidemark.plans import all_queries, source_queries

    sf = "/root/testdata/sf0.001"
    want = [tuple(r) for r in all_queries()["t04_dropped_rows"](spark, sf).collect()]
    monkeypatch.setattr(source_queries, "MOST_IN_FILE", 200)
    sizes, files = [], source_queries._files

    def seen(d, df, name):
        sizes.extend(r["count"] for r in df.groupBy("file").count().collect())
        return files(d, df, name)

    monkeypatch.setattr(source_queries, "_files", seen)
    assert [tuple(r) for r in all_queries()["t04_dropped_rows"](spark, sf).collect()] == want
    assert max(sizes) < 300 and len(sizes) > 4


def test_streams_in_order_take_bounded_triggers(spark, monkeypatch):
    from tidemark.plans import registry, source_queries
    from tidemark.streaming import ticks as stream

    monkeypatch.setattr(source_queries, "MOST_IN_ORDERED_FILE", 300)
    monkeypatch.setattr(source_queries, "LEAST_IN_PART", 5, raising=False)
    d, reports = registry.Data(spark, "/root/testdata/sf0.001"), []
    got = stream.run_available(stream.stream_dedupe(source_queries._stream_ticks(d, repeated=1)), progress=reports)
    taken = [r["numInputRows"] for r in reports if r["numInputRows"]]
    assert sorted(r["seq"] for r in got.collect()) == sorted(r["seq"] for r in d.ticks.collect())
    assert max(taken) < 450 and sum(taken) == 2 * d.ticks.count()


def test_whole_bars_store_ticks_with_epochs(spark):
    """Parts of the whole bars read ticks that were written once, not the events anew."""
    from tidemark.operators import bars, book
    from tidemark.plans import registry

    plain = registry.Data(spark, "/root/testdata/sf0.001")
    d = plain.with_epochs()
    for part in (d.ticks, d.trades, d.levels, d.kinds, d.quotes, bars.with_reset_epochs(d.ticks)):
        assert not any("events.parquet" in f for f in part.inputFiles())
    columns = ["exchange", "symbol", "seq", *book.EPOCHS]
    assert sorted(map(tuple, d.ticks.select(columns).collect())) == sorted(map(tuple, book.epochs(plain.ticks).select(columns).collect()))
    assert sorted(map(tuple, bars.with_reset_epochs(d.ticks).select("seq", "acc_epoch", "cvd_epoch").collect())) == sorted(map(tuple, bars.with_reset_epochs(plain.ticks).select("seq", "acc_epoch", "cvd_epoch").collect()))
