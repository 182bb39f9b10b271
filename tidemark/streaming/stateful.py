"""Streams with keyed state and event-time timers: the barrier, live books, bars cut by snapshots, and dropped rows as a table.

State lives in the RocksDB store (``with_state_store``), entry by entry; a processor reads and writes what a trigger touches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.core import KEY, MONDAY, seconds
from tidemark.streaming.ticks import LiveBook

_STORE, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def with_state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own setting comes back afterwards."""
    own = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, own) if own else spark.conf.unset(_STORE)


# ---- T05 -------------------------------------------------------------------------------------------
BARRIER_OUT = "exchange string, bucket long, symbol string, arrived int, is_complete boolean, gap_cause string, closes string"
_BARRIER = [c.split()[0] for c in BARRIER_OUT.split(", ")]


class Barrier(StatefulProcessor):
    """The buckets of one exchange in a span of time: of each the last close of every expected symbol until all are there or the bucket's time is up.

    They are one value, read and written once a trigger, so that calls of the state server do not grow with the buckets: of an open bucket its closes, of one that was complete null.
    """

    def __init__(self, symbols: list[str]) -> None:
        self.symbols = symbols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getValueState("buckets", "buckets string")

    def _read(self) -> dict[int, dict[str, float | None] | None]:
        return {int(b): have for b, have in json.loads(self.buckets.get()[0]).items()} if self.buckets.exists() else {}

    def _write(self, open_: dict[int, dict[str, float | None] | None]) -> None:
        if open_:
            self.buckets.update((json.dumps(open_),))
            self.handle.registerTimer(min(open_) * 1000)
        else:
            self.buckets.clear()

    def _told(self, key: tuple, some: list[tuple[int, dict[str, float | None]]]) -> Iterator[pd.DataFrame]:
        rows = []
        for bucket, have in some:
            missing = sorted(set(self.symbols) - set(have))
            rows.append((key[0], bucket, None, len(have), not missing, None, json.dumps(have, sort_keys=True)))
            rows += [(key[0], bucket, s, None, None, "barrier_timeout", None) for s in missing]
        if rows:
            yield pd.DataFrame(rows, columns=_BARRIER).astype({"arrived": "Int32", "is_complete": "boolean"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[tuple[int, str], tuple[int, float | None]] = {}
        for batch in rows:
            for bucket, symbol, close, version in batch[["bucket", "symbol", "close", "version"]].itertuples(index=False):
                if (bucket, symbol) not in fresh or fresh[bucket, symbol][0] <= version:
                    fresh[bucket, symbol] = (version, None if close is None or close != close else float(close))
        open_, touched = self._read(), set()
        for (bucket, symbol), (_, close) in fresh.items():
            have = open_.setdefault(int(bucket), {})
            if have is not None:  # else a version that comes after the bucket was complete
                have[symbol] = close
                touched.add(int(bucket))
        full = [(b, open_[b]) for b in sorted(touched) if set(open_[b]) >= set(self.symbols)]
        self._write(open_ | {b: None for b, _ in full})
        yield from self._told(key, full)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The watermark has passed some buckets by the timeout; later rows of them are late and do not get here."""
        open_, mark = self._read(), timerValues.getCurrentWatermarkInMs()
        over = [b for b in sorted(open_) if b * 1000 <= mark]
        told = [(b, open_[b]) for b in over if open_[b] is not None]
        if over:
            self._write({b: have for b, have in open_.items() if b * 1000 > mark})
        yield from self._told(key, told)

    def close(self) -> None:
        pass


def stream_barrier(bars: DataFrame, symbols: list[str], timeout: int) -> DataFrame:
    """T05 as a stream: a row for each bucket (ts) once every expected symbol has come or ``timeout`` seconds of event time have passed, with the closes as JSON, and a ``barrier_timeout`` row for each symbol missing then.

    Of bars that repeat before that, the last version counts: of one trigger that with the highest ``version`` (0 if there is none), else the later trigger's. What comes later is dropped and counted
    by Spark. Bars of other symbols do not count. The watermark trails by the timeout, so a bucket's timer is its own time. Buckets are kept by spans of the timeout, which is about as many as wait anyway.
    """
    version = F.coalesce(F.col("version").cast("long"), F.lit(0)) if "version" in bars.columns else F.lit(0)
    bucket = F.unix_seconds("ts")
    b = bars.where(F.col("symbol").isin(symbols) & F.col("ts").isNotNull()).withWatermark("ts", f"{timeout} seconds")
    b = b.select("exchange", F.floor(bucket / max(timeout, 1)).cast("long").alias("span"), bucket.alias("bucket"), "ts", "symbol", F.col("close").cast("double").alias("close"), version.cast("long").alias("version"))
    out = b.groupBy("exchange", "span").transformWithStateInPandas(Barrier(symbols), BARRIER_OUT, "append", "eventTime")
    return out.select("exchange", F.timestamp_seconds("bucket").alias("ts"), "symbol", "arrived", "is_complete", "gap_cause", "closes")


# ---- rows in order ---------------------------------------------------------------------------------
#: Rows of one entry of the list of rows that wait, and of one frame of output.
HELD_ROWS, OUT_ROWS = 20_000, 50_000
#: What stands for a missing seq, so that columns stay whole numbers; such rows come first among those of their time.
NO_SEQ = -(1 << 63)


class InOrder(StatefulProcessor):
    """One key: rows (us, seq, ...) wait as list state until the watermark has passed them, then go on in the order of (us, seq). ``HELD`` names their numpy types, ``OUT`` is the output's schema.

    An entry of the list is a block of rows in binary form, so a row that waits is a few dozen bytes and no call of the state server; what a trigger releases is sorted as arrays and goes on in parts of ``OUT_ROWS``.
    """

    HELD, OUT = "", ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.wanted = np.dtype([tuple(c.split()) for c in self.HELD.split(", ")])
        self.columns = [c.split()[0] for c in self.OUT.split(", ")]

    def begin(self) -> None:
        """Read what else is state."""
        raise NotImplementedError

    def advance(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        """Take the next ``rows``; returns output rows."""
        raise NotImplementedError

    def end(self, key: tuple, mark: int) -> tuple[list[tuple], list[int]]:
        """All rows up to ``mark`` (microseconds) have been taken: write the state. Returns further output rows and times (milliseconds) at which to be asked again."""
        raise NotImplementedError

    def _hold(self, rows: np.ndarray) -> list[tuple[bytes]]:
        return [(rows[lo : lo + HELD_ROWS].tobytes(),) for lo in range(0, len(rows), HELD_ROWS)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            fresh = np.empty(len(batch), self.wanted)
            for name in self.wanted.names:
                fresh[name] = batch[name].to_numpy()
            if len(fresh):
                self.held.appendList(self._hold(fresh))
        yield from self._released(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._released(key, timerValues.getCurrentWatermarkInMs())

    def _released(self, key: tuple, mark_ms: int) -> Iterator[pd.DataFrame]:
        blocks = [np.frombuffer(r[0], self.wanted) for r in self.held.get()] if self.held.exists() else []
        held = np.concatenate(blocks) if blocks else np.empty(0, self.wanted)
        del blocks
        over = held["us"] <= mark_ms * 1000
        rest, held = held[~over], held[over]
        order = np.lexsort((held["seq"], held["us"]))
        self.begin()
        for lo in range(0, len(order), OUT_ROWS):
            out = self.advance(key, held[order[lo : lo + OUT_ROWS]].tolist())
            if out:
                yield pd.DataFrame(out, columns=self.columns)
        out, due = self.end(key, mark_ms * 1000)
        if out:
            yield pd.DataFrame(out, columns=self.columns)
        if len(held):
            self.held.put(self._hold(rest)) if len(rest) else self.held.clear()
        due += [int(rest["us"].min()) // 1000 + 1] if len(rest) else []
        if due:
            self.handle.registerTimer(max(min(due), mark_ms + 1))

    def close(self) -> None:
        pass


# ---- T03 -------------------------------------------------------------------------------------------
#: What a row does to a book.
_OTHER, _UPDATE, _SNAPSHOT, _GAP, _BROKEN = range(5)


class BookState(InOrder):
    """The live book of a key: an entry of map state for each level, of which a trigger writes those that it changed; updates that wait for a snapshot are list state."""

    HELD = "us i8, seq i8, what i1, side i1, price f8, size f8"
    OUT = "exchange string, symbol string, us long, seq long, bid double, bid_size double, ask double, ask_size double, live boolean"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.levels = handle.getMapState("levels", "side int, price double", "size double")
        self.cold = handle.getListState("cold", "seq long, side int, price double, size double")
        self.live = handle.getValueState("live", "live boolean")

    def begin(self) -> None:
        self.stored = {tuple(k): v[0] for k, v in self.levels.iterator()}
        self.book = LiveBook([[(p, z) for (s, p), z in self.stored.items() if s == side] for side in (0, 1)])
        self.was_live = self.is_live = self.live.exists()
        self.waiting = list(self.cold.get()) if self.cold.exists() else []
        self.fresh, self.kept = [], True

    def advance(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        book, live, out = self.book, self.is_live, []
        for us, seq, what, side, price, size in rows:
            if what == _UPDATE:
                if live:
                    book.set(side, price, size)
                else:
                    self.fresh.append((seq, side, price, size))
            elif what == _SNAPSHOT:
                book = LiveBook()
                for s, *level in [] if live else (*self.waiting, *self.fresh):
                    if s > seq:
                        book.set(*level)
                live, self.waiting, self.fresh, self.kept = True, [], [], False
            elif what != _OTHER:
                book, self.waiting, self.fresh, self.kept = LiveBook(), [], [], False
                live = live and what != _BROKEN
            out.append((*key, us, seq, *book.best(), live))
        self.book, self.is_live = book, live
        return out

    def end(self, key: tuple, mark: int) -> tuple[list[tuple], list[int]]:
        now = {(side, p): z for side in (0, 1) for p, z in self.book.levels[side].items()}
        for k in self.stored.keys() - now.keys():
            self.levels.removeKey(k)
        for k, z in now.items():
            if self.stored.get(k) != z:
                self.levels.updateValue(k, (z,))
        if self.is_live != self.was_live:
            self.live.update((True,)) if self.is_live else self.live.clear()
        if not self.kept:
            self.cold.put(self.fresh) if self.fresh else self.cold.clear()
        elif self.fresh:
            self.cold.appendList(self.fresh)
        return [], []


def _ordered(rows: DataFrame, *more: Column) -> DataFrame:
    """What ``InOrder`` takes, without nulls in whole numbers."""
    return rows.where("ts is not null").select(*KEY, "ts", F.unix_micros("ts").alias("us"), F.coalesce(F.col("seq").cast("long"), F.lit(NO_SEQ)).alias("seq"), *more, F.col("price").cast("double").alias("price"), F.col("size").cast("double").alias("size"))


def stream_live_book(ticks: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """T03 with all of a book's rules: best quotes after every tick, in order even if files are late by up to ``delay``.

    Until a key's first snapshot, and after an ``internal_merge_error`` until the next one, its book is not ``live``: quotes are null and updates wait; the snapshot replays those above its sequence. Other
    gaps and further snapshots empty the book. Updates without side, price or size change nothing. Later rows are dropped and counted by Spark.
    """
    def given(name: str) -> Column:
        return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))

    side = F.when(F.col("side") == "buy", 0).when(F.col("side") == "sell", 1).otherwise(-1)
    update = (F.col("event_type") == "update") & (side >= 0) & given("price") & given("size")
    gap = F.when(F.col("gap_cause") == "internal_merge_error", _BROKEN).otherwise(_GAP)
    what = F.when(F.col("msg_type") == "snapshot", _SNAPSHOT).when(F.col("msg_type") == "gap", gap).when(update, _UPDATE).otherwise(_OTHER)
    rows = _ordered(ticks.withWatermark("ts", delay), what.alias("what"), side.alias("side"))
    out = rows.groupBy(*KEY).transformWithStateInPandas(BookState(), BookState.OUT, "append", "eventTime")
    return out.select(*KEY, F.timestamp_micros("us").alias("ts"), F.nullif("seq", F.lit(NO_SEQ)).alias("seq"), "bid", "bid_size", "ask", "ask_size", "live")


# ---- T06 -------------------------------------------------------------------------------------------
class CutBars(InOrder):
    """The open bar of a key is state."""

    HELD = "us i8, seq i8, snap ?, buy ?, price f8, size f8"
    OUT = "exchange string, symbol string, bar long, acc_epoch long, open double, high double, low double, close double, volume double, buy_volume double, trade_count long, is_partial boolean"

    def __init__(self, width: int, start: int) -> None:
        self.width, self.start = width, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.bar = handle.getValueState("bar", "bar long, open double, high double, low double, close double, volume double, buy_volume double, trade_count long")
        self.epoch = handle.getValueState("epoch", "epoch long")

    def begin(self) -> None:
        self.open = list(self.bar.get()) if self.bar.exists() else None
        self.stored = self.number = self.epoch.get()[0] if self.epoch.exists() else 0

    def advance(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        bar, out = self.open, []
        for us, _, snap, buy, price, size in rows:
            s = us // 1_000_000
            at = s - (s - self.start) % self.width
            if bar and (snap or bar[0] != at):
                out.append((*key, bar[0], self.number, *bar[1:], snap and bar[0] == at))
                bar = None
            if snap:
                self.number += 1
            elif bar is None:
                bar = [at, price, price, price, price, size, size if buy else 0.0, 1]
            else:
                bar[2:] = [max(bar[2], price), min(bar[3], price), price, bar[5] + size, bar[6] + (size if buy else 0.0), bar[7] + 1]
        self.open = bar
        return out

    def end(self, key: tuple, mark: int) -> tuple[list[tuple], list[int]]:
        bar, out = self.open, []
        if bar and (bar[0] + self.width) * 1_000_000 <= mark:
            out.append((*key, bar[0], self.number, *bar[1:], False))
            bar = None
        if self.number != self.stored:
            self.epoch.update((self.number,))
        self.bar.update(tuple(bar)) if bar else self.bar.clear()
        return out, [(bar[0] + self.width) * 1000] if bar else []


def stream_cut(ticks: DataFrame, tf: str, delay: str = "10 seconds") -> DataFrame:
    """T06 as a stream: bars of a stream of ticks, each once it is over or a snapshot cuts it (``is_partial``); what follows the snapshot is a bar of the next ``acc_epoch``.

    Rows may come in any order up to ``delay``; later ones are dropped and counted by Spark. Trades without size and other messages do not count.
    """
    snap = F.col("msg_type") == "snapshot"
    trade = (F.col("event_type") == "trade") & (F.col("size") > 0)
    buy = F.coalesce(F.col("side") == "buy", F.lit(False))
    rows = _ordered(ticks.where(snap | trade).withWatermark("ts", delay), F.coalesce(snap, F.lit(False)).alias("snap"), buy.alias("buy"))
    out = rows.groupBy(*KEY).transformWithStateInPandas(CutBars(seconds(tf), MONDAY if tf == "1w" else 0), CutBars.OUT, "append", "eventTime")
    return out.withColumn("bar", F.timestamp_seconds("bar")).withColumnRenamed("bar", "ts")


# ---- T04 -------------------------------------------------------------------------------------------
def dropped_rows(spark: SparkSession, progress: list) -> DataFrame:
    """(batch, operator, dropped) from a query's progress: rows that each stateful operator dropped as older than the watermark."""
    rows = [(int(p["batchId"]), s["operatorName"], int(s["numRowsDroppedByWatermark"])) for p in (x if isinstance(x, dict) else json.loads(x.json) for x in progress) for s in p["stateOperators"]]
    return spark.createDataFrame(rows, "batch long, operator string, dropped long")


def counted(df: DataFrame, run: Callable[[DataFrame, list], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """What ``run(df, progress)`` returns, and the rows dropped meanwhile; ``run`` adds the query's progress to the list."""
    progress: list = []
    out = run(df, progress)
    return out, dropped_rows(df.sparkSession, progress)
