"""Stateful streams over several triggers against plain loops: late files, repeated rows, restarts of books."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import stateful
from tidemark.streaming.ticks import barrier, cut_partial, run_available

T0 = dt.datetime(2024, 1, 1)
TICKS = "exchange string, symbol string, ts timestamp, seq long, msg_type string, event_type string, gap_cause string, side string, price double, size double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def streamed(spark, files, schema):
    """A stream that reads one of ``files`` (lists of rows) a trigger."""
    path = tempfile.mkdtemp(prefix="spark-")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def ran(spark, df):
    with stateful.with_state_store(spark):
        return run_available(df)


def test_state_store_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), stateful.with_state_store(spark):
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_barrier_over_triggers(spark):
    """Versions within a trigger and across them, a symbol that does not count, a bucket that times out, rows after completion, rows too late."""
    bars = "exchange string, symbol string, ts timestamp, close double, version long"
    files = [
        [("x", "A", at(0), 1.0, 2), ("x", "A", at(0), 9.0, 1), ("x", "A", at(60), 3.0, 1), ("x", "Z", at(60), 8.0, 1), ("y", "A", at(0), 7.0, 1)],
        [("x", "A", at(60), 4.0, 1), ("x", "B", at(0), 2.0, 1), ("x", "B", at(120), None, 1)],
        [("x", "A", at(0), 5.0, 9), ("x", "B", at(60), 6.0, 1), ("x", "A", at(500), 1.0, 1)],
        [("x", "A", at(900), 1.0, 1)],
        [("x", "A", at(120), 1.0, 1), ("x", "B", at(900), 2.0, 1), ("x", "A", at(1000), 3.0, 1)],
    ]
    out = ran(spark, stateful.stream_barrier(streamed(spark, files, bars), ["A", "B"], 200)).collect()
    closes = sorted((r["exchange"], r["ts"], r["arrived"], r["is_complete"], r["closes"]) for r in out if r["gap_cause"] is None)
    assert closes == [("x", at(0), 2, True, '{"A": 1.0, "B": 2.0}'), ("x", at(60), 2, True, '{"A": 4.0, "B": 6.0}'), ("x", at(120), 1, False, '{"B": null}'), ("x", at(500), 1, False, '{"A": 1.0}'), ("x", at(900), 2, True, '{"A": 1.0, "B": 2.0}'), ("y", at(0), 1, False, '{"A": 7.0}')]
    assert sorted((r["exchange"], r["ts"], r["symbol"]) for r in out if r["gap_cause"] == "barrier_timeout") == [("x", at(120), "A"), ("x", at(500), "B"), ("y", at(0), "B")]


def test_barrier_equals_its_batch_form(spark):
    rng = random.Random(2)
    rows = [("x", s, at(60 * i), float(i), 0) for i in range(120) for s in "ABC" if rng.random() < 0.9]
    files = [[], [], []]
    for r in rows:
        files[min(2, int((r[2] - T0).total_seconds()) // 2600 + (rng.random() < 0.1))].append(r)
    schema = "exchange string, symbol string, ts timestamp, close double, version long"
    out = ran(spark, stateful.stream_barrier(streamed(spark, files, schema), ["A", "B", "C"], 3000))
    full, gaps = barrier(spark.createDataFrame(rows, schema), ["A", "B", "C"], F.lit(max(r[2] for r in rows)), 3000)
    assert sorted(map(tuple, out.where("gap_cause is null").select("exchange", "ts", "arrived", "is_complete").collect())) == sorted(map(tuple, full.collect()))
    assert sorted(map(tuple, out.where("gap_cause is not null").select("exchange", "ts", "symbol", "gap_cause").collect())) == sorted(map(tuple, gaps.collect()))


def plain_book(rows):
    """One key's rows in order: quotes after each."""
    live, cold, levels, out = False, [], {"buy": {}, "sell": {}}, []

    def put(side, price, size):
        levels[side].pop(price, None)
        if size > 0:
            levels[side][price] = size

    for r in rows:
        _, _, ts, seq, kind, event, cause, side, price, size = r
        if kind == "snapshot":
            levels = {"buy": {}, "sell": {}}
            if not live:
                for s, *level in cold:
                    if s > seq:
                        put(*level)
            live, cold = True, []
        elif kind == "gap":
            levels, cold = {"buy": {}, "sell": {}}, []
            live = live and cause != "internal_merge_error"
        elif event == "update" and side and price is not None and size is not None:
            put(side, price, size) if live else cold.append((seq, side, price, size))
        bid, ask = max(levels["buy"], default=None), min(levels["sell"], default=None)
        both = bid is not None and ask is not None
        out.append((ts, seq, *((bid, levels["buy"][bid], ask, levels["sell"][ask]) if both else (None,) * 4), live))
    return out


def random_ticks(rng, n, step=10):
    rows = []
    for i in range(n):
        u = rng.random()
        kind, event = ("snapshot", "snapshot") if u < 0.03 else ("gap", None) if u < 0.07 else ("tick", "trade" if u < 0.2 else "update")
        level = kind == "tick"
        rows.append(("x", "A", at(step * i), (i * 37) % n, kind, event, rng.choice(["internal_merge_error", "external_disconnect"]) if kind == "gap" else None, rng.choice(["buy", "sell", "sell", "buy", None]) if level else None, float(rng.randrange(95, 105)) if level and rng.random() < 0.97 else None, float(rng.randrange(0, 4)) if level else None))
    return rows


def dealt(rng, rows, n, late):
    """Files in time order, some rows a file later, all shuffled; the last file ends with a tick that moves the watermark past all."""
    size = len(rows) // n + 1
    files = [[] for _ in range(n)]
    for i, r in enumerate(rows):
        files[min(n - 1, i // size + (i % size > size - late and rng.random() < 0.5))].append(r)
    for f in files:
        rng.shuffle(f)
    files.append([("x", "END", at(10**6), 0, "tick", "trade", None, "buy", 1.0, 1.0)])
    return files


def test_live_book_with_late_files(spark):
    """Sequences that jump, so that snapshots replay what waited; late files between triggers; two keys."""
    rng = random.Random(6)
    one, two = random_ticks(rng, 300), [(r[0], "B", *r[2:]) for r in random_ticks(rng, 200)]
    files = dealt(rng, sorted(one + two, key=lambda r: r[2]), 4, 20)
    out = ran(spark, stateful.stream_live_book(streamed(spark, files, TICKS), "1000 seconds"))
    for symbol, rows in (("A", one), ("B", two)):
        got = [tuple(r) for r in out.where(F.col("symbol") == symbol).select("ts", "seq", "bid", "bid_size", "ask", "ask_size", "live").orderBy("ts", "seq").collect()]
        assert got == plain_book(rows)
    assert any(r[2] is not None for r in plain_book(one)) and any(not r[6] for r in plain_book(one)[50:])


def test_cut_bars_with_late_files(spark):
    rng = random.Random(8)
    rows = random_ticks(rng, 400, 20)
    files = dealt(rng, rows, 4, 30)
    out = ran(spark, stateful.stream_cut(streamed(spark, files, TICKS), "10m", "1000 seconds")).where("symbol = 'A'")
    ticks = spark.createDataFrame(rows, TICKS)
    want = cut_partial(ticks, ticks.where("event_type = 'trade' and size > 0"), "10m")
    assert sorted(map(tuple, out.select(*want.columns).collect())) == sorted(map(tuple, want.collect())) and {r["is_partial"] for r in want.collect()} == {True, False}


def test_a_bar_is_partial_even_if_nothing_follows_the_snapshot(spark):
    rows = [("x", "A", at(10), 1, "tick", "trade", None, "buy", 5.0, 1.0), ("x", "A", at(20), 2, "snapshot", "snapshot", None, None, None, None), ("x", "A", at(700), 3, "tick", "trade", None, "buy", 6.0, 1.0)]
    ticks = spark.createDataFrame(rows, TICKS)
    assert [(r["ts"], r["is_partial"]) for r in cut_partial(ticks, ticks.where("event_type = 'trade'"), "10m").orderBy("ts").collect()] == [(at(0), True), (at(600), False)]


def test_upserts_are_idempotent(spark):
    """A batch given twice, a failure after the write and before the commit, an older batch again, and a restart change nothing."""
    from tidemark.sources import io

    bars = "exchange string, symbol string, ts timestamp, close double, version long"
    files = [[("x", "A", at(0), 1.0, 1), ("x", "A", at(60), 1.0, 1)], [("x", "A", at(0), 2.0, 2), ("x", "B", at(0), 5.0, 1), ("x", "B", at(0), 6.0, 1)], [("x", "A", at(0), 3.0, 1), ("x", "A", at(60), 4.0, 1)]]
    path, checkpoint = (f"{tempfile.mkdtemp(prefix='spark-')}/{n}" for n in ("table", "state"))

    def table():
        return sorted(tuple(r) for r in spark.read.parquet(path).select("symbol", "ts", "close", "version", "batch").collect())

    stream, put, broken = streamed(spark, files, bars), io.upsert_sink(path, "version"), {1}

    def fails_once(rows, number):
        put(rows, number)
        put(rows, number)
        if number in broken:
            broken.clear()
            raise ValueError("lost after the write")

    def run():
        q = stream.writeStream.foreachBatch(fails_once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001
            return "lost after the write" in str(e)
        return False

    assert run() and not run()
    want = table()
    assert [r[:2] + r[3:] for r in want] == [("A", at(0), 2, 1), ("A", at(60), 1, 2), ("B", at(0), 1, 1)] and [r[2] for r in want[:2]] == [2.0, 4.0] and want[2][2] in (5.0, 6.0)
    put(spark.createDataFrame(files[1], bars), 1)
    put(spark.createDataFrame(files[0], bars), 0)
    assert table() == want
    io.upsert_stream(stream, path, checkpoint, "version").awaitTermination()
    assert table() == want


class Kept:
    """List, map and value state of one key in memory; ``entries`` counts what was put into a list."""

    def __init__(self, now=0):
        self.lists, self.maps, self.values, self.entries, self.now = {}, {}, {}, 0, now

    def getListState(self, name, schema):
        kept, got = self, self.lists.setdefault(name, [])

        class State:
            exists = staticmethod(lambda: bool(got))
            get = staticmethod(lambda: iter(list(got)))
            clear = staticmethod(got.clear)

            def appendList(self, rows):
                kept.entries += len(rows)
                got.extend(rows)

            def put(self, rows):
                got.clear()
                self.appendList(rows)

        return State()

    def getMapState(self, name, *schema):
        got = self.maps.setdefault(name, {})

        class State:
            iterator = staticmethod(lambda: iter(list(got.items())))
            updateValue = staticmethod(got.__setitem__)
            removeKey = staticmethod(got.pop)

        return State()

    def getValueState(self, name, schema):
        got = self.values

        class State:
            exists = staticmethod(lambda: name in got)
            get = staticmethod(lambda: got[name])
            update = staticmethod(lambda v: got.__setitem__(name, v))
            clear = staticmethod(lambda: got.pop(name, None))

        return State()

    def registerTimer(self, at):
        pass

    def getCurrentWatermarkInMs(self):
        return self.now


def test_rows_wait_in_blocks_and_go_on_in_parts():
    """Not a call of the state server for each row, nor a frame of all that a trigger releases."""
    import pandas as pd

    n, rng = 120_000, random.Random(3)
    rows = [(i * 1000, i, stateful._SNAPSHOT if i % 5000 == 0 else stateful._UPDATE, i % 2, 100.0 + (i % 7) * (1 if i % 2 else -1), float(rng.randrange(3))) for i in range(n)]
    given = pd.DataFrame(rows, columns=["us", "seq", "what", "side", "price", "size"]).sample(frac=1, random_state=1)
    state, book = Kept(-1), stateful.BookState()
    book.init(state)
    assert list(book.handleInputRows(("x", "A"), iter([given[:70_000], given[70_000:]]), state)) == []
    assert state.entries <= n / stateful.HELD_ROWS + 2
    state.now = n - 101  # milliseconds: the last hundred rows still wait
    parts = list(book.handleExpiredTimer(("x", "A"), state, None))
    got = pd.concat(parts)
    assert max(map(len, parts)) <= stateful.OUT_ROWS and len(got) == n - 100 and got["seq"].tolist() == list(range(n - 100))
    tick = {stateful._SNAPSHOT: ("snapshot", "snapshot"), stateful._UPDATE: ("tick", "update")}
    want = plain_book([("x", "A", us, seq, *tick[what], None, ("buy", "sell")[side], price, size) for us, seq, what, side, price, size in rows[: n - 100]])
    told = got[["us", "seq", "bid", "bid_size", "ask", "ask_size", "live"]].astype(object)
    assert list(told.where(told.notna(), None).itertuples(index=False, name=None)) == want
    state.now = n
    assert sum(map(len, book.handleExpiredTimer(("x", "A"), state, None))) == 100 and not state.lists["held"]


def test_ordered_streams_come_in_bounded_files(spark, monkeypatch):
    from tidemark.plans import all_queries, source_queries

    sf = "/root/testdata/sf0.001"
    want = sorted(tuple(r) for r in all_queries()["t06_stream_cut"](spark, sf).collect())
    monkeypatch.setattr(source_queries, "MOST_IN_ORDERED_FILE", 150)
    sizes, files = [], source_queries._files

    def seen(d, df, name):
        sizes.extend(r["count"] for r in df.groupBy("file").count().collect())
        return files(d, df, name)

    monkeypatch.setattr(source_queries, "_files", seen)
    assert sorted(tuple(r) for r in all_queries()["t06_stream_cut"](spark, sf).collect()) == want
    assert max(sizes) < 300 and len(sizes) > 5


def test_a_span_of_buckets_is_one_value():
    """Calls of the state server do not grow with the buckets (F9); versions count across frames of a trigger."""
    import pandas as pd

    state, barrier_of = Kept(-1), stateful.Barrier(["A", "B"])
    state.calls = 0
    get = state.getValueState

    def counting(name, schema):
        own = get(name, schema)
        update = own.update

        def counted(v):
            state.calls += 1
            update(v)

        own.update = counted
        return own

    state.getValueState = counting
    barrier_of.init(state)
    frame = lambda rows: pd.DataFrame(rows, columns=["bucket", "symbol", "close", "version"])
    first = frame([(b, "A", float(b), 5) for b in range(100)])
    again = frame([(b, "A", -1.0, 4) for b in range(100)] + [(b, "B", 2.0, 0) for b in range(40)])
    full = pd.concat(barrier_of.handleInputRows(("x", 0), iter([first, again]), state))
    assert state.calls == 1 and list(state.values) == ["buckets"]
    assert sorted(zip(full["bucket"], full["closes"], strict=True)) == [(b, f'{{"A": {float(b)}, "B": 2.0}}') for b in range(40)]
    assert list(barrier_of.handleInputRows(("x", 0), iter([frame([(1, "A", 7.0, 9)])]), state)) == []
    state.now = 59_000
    over = pd.concat(barrier_of.handleExpiredTimer(("x", 0), state, None))
    assert over[over["gap_cause"].notna()]["bucket"].tolist() == list(range(40, 60)) and set(over["symbol"].dropna()) == {"B"}
    state.now = 99_000
    assert len(pd.concat(barrier_of.handleExpiredTimer(("x", 0), state, None))) == 80 and not state.values
