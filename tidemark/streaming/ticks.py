"""The tick-to-bar path as Structured Streaming."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.core import KEY, bucket, over_days, seconds
from tidemark.sources.io import scratch


def tumbling(tf: str) -> Column:
    """The event-time window of a bar; weeks open on Monday."""
    width = f"{seconds(tf)} seconds"
    return F.window("ts", width, width, "4 days") if tf == "1w" else F.window("ts", width)


def _bar_aggs() -> list[Column]:
    first = F.struct("ts", "seq")
    return [F.min_by("price", first).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", first).alias("close"), F.sum("size").alias("volume"), F.sum(F.when(F.col("side") == "buy", F.col("size")).otherwise(0.0)).alias("buy_volume"), F.count(F.lit(1)).alias("trade_count")]


def stream_bars(trades: DataFrame, tf: str, delay: str = "10 seconds") -> DataFrame:
    """Bars of a trade stream, each once its window is older than the watermark (append mode)."""
    out = trades.withWatermark("ts", delay).groupBy(*KEY, tumbling(tf).alias("w")).agg(*_bar_aggs())
    return out.select(*KEY, F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume", "buy_volume", "trade_count")


def stream_partial_bars(trades: DataFrame, tf: str) -> DataFrame:
    """The same bars for update mode: every trigger emits the bars that changed, open ones included."""
    return stream_bars(trades, tf).withColumn("is_complete", F.lit(False))


def stream_dedupe(ticks: DataFrame, delay: str = "1 second") -> DataFrame:
    """Message ids that repeat within ``delay`` are dropped; rows behind the watermark are dropped and counted in the query's progress."""
    return ticks.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["exchange", "symbol", "ingest_id"])


OUT_ROWS = 50_000
BOOK_OUT = "exchange string, symbol string, ts timestamp, seq long, bid double, bid_size double, ask double, ask_size double"


class LiveBook:
    """The levels of one key; the best of a side is the top of a heap whose stale entries are dropped when met."""

    def __init__(self, levels: list[list[list[float]]] | None = None) -> None:
        self.levels = [dict(map(tuple, side)) for side in levels] if levels else [{}, {}]
        self.heaps = [[-p for p in self.levels[0]], list(self.levels[1])]
        for heap in self.heaps:
            heapq.heapify(heap)

    def set(self, side: int, price: float, size: float) -> None:
        if size > 0:
            if price not in self.levels[side]:
                heapq.heappush(self.heaps[side], price if side else -price)
            self.levels[side][price] = size
        else:
            self.levels[side].pop(price, None)

    def best(self) -> tuple[float | None, float | None, float | None, float | None]:
        out: list[float | None] = []
        for side, sign in ((0, -1), (1, 1)):
            heap, levels = self.heaps[side], self.levels[side]
            while heap and sign * heap[0] not in levels:
                heapq.heappop(heap)
            out += [sign * heap[0], levels[sign * heap[0]]] if heap else [None, None]
        return tuple(out) if None not in out else (None,) * 4

    def stored(self) -> str:
        return json.dumps([list(side.items()) for side in self.levels])


def _advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A key's rows of one trigger in stream order; only their columns that move the book are held."""
    book = LiveBook(json.loads(state.get[0])) if state.exists else LiveBook()
    wanted = ["msg_type", "event_type", "side", "price", "size", "ts", "seq"]
    rows = pd.concat([b[wanted] for b in batches]).sort_values(["ts", "seq"], kind="stable")
    sides = {"buy": 0, "sell": 1}
    for lo in range(0, len(rows), OUT_ROWS):
        part, out = rows.iloc[lo : lo + OUT_ROWS], []
        for kind, event, side, price, size, ts, seq in part.itertuples(index=False):
            if kind in ("snapshot", "gap"):
                book = LiveBook()
            elif event == "update" and side in sides and price == price:
                book.set(sides[side], price, size)
            out.append((*key, ts, seq, *book.best()))
        yield pd.DataFrame(out, columns=["exchange", "symbol", "ts", "seq", "bid", "bid_size", "ask", "ask_size"]).astype({c: "float64" for c in ("bid", "bid_size", "ask", "ask_size")})
    state.update((book.stored(),))


def stream_book(ticks: DataFrame) -> DataFrame:
    """Best quotes after every tick; a key's live levels are its state, cleared by snapshots and gaps."""
    return ticks.groupBy(*KEY).applyInPandasWithState(_advance, BOOK_OUT, "book string", "append", GroupStateTimeout.NoTimeout)


def cut_partial(ticks: DataFrame, trades: DataFrame, tf: str) -> DataFrame:
    """A snapshot cuts the bar: its part before and after are rows of their own (``acc_epoch``), the part before is partial."""
    snaps = ticks.where("msg_type = 'snapshot'").select(*KEY, "ts", "seq", F.lit(1).alias("snap"))
    both = trades.withColumn("snap", F.lit(0)).unionByName(snaps, allowMissingColumns=True)
    cut = over_days(both, sums={"acc_epoch": F.col("snap")}).withColumn("bar", bucket(F.col("ts"), tf))
    ends = cut.where("snap = 1").select(*KEY, (F.col("acc_epoch") - 1).alias("acc_epoch"), F.col("bar").alias("cut_in"))
    out = cut.where("snap = 0").groupBy(*KEY, "bar", "acc_epoch").agg(*_bar_aggs()).join(ends, [*KEY, "acc_epoch"], "left")
    return out.select(*KEY, F.col("bar").alias("ts"), "acc_epoch", "open", "high", "low", "close", "volume", "buy_volume", "trade_count", F.coalesce(F.col("cut_in") == F.col("bar"), F.lit(False)).alias("is_partial"))


def barrier(bars: DataFrame, symbols: list[str], as_of: Column, timeout: int) -> tuple[DataFrame, DataFrame]:
    """Buckets (ts) that every expected symbol has reached or whose timeout has passed, and a ``barrier_timeout`` gap row for each symbol missing then. Of repeated bars the last version counts."""
    have = bars.where(F.col("symbol").isin(symbols)).groupBy("exchange", "ts").agg(F.collect_set("symbol").alias("got"))
    missing = F.array_except(F.array(*[F.lit(s) for s in symbols]), F.col("got"))
    due = F.unix_seconds("ts") + timeout <= F.unix_seconds(as_of)
    b = have.withColumn("missing", missing).where((F.size("missing") == 0) | due)
    gaps = b.select("exchange", "ts", F.explode("missing").alias("symbol"), F.lit("barrier_timeout").alias("gap_cause"))
    return b.select("exchange", "ts", F.size("got").alias("arrived"), (F.size("missing") == 0).alias("is_complete")), gaps


def drop_stale(pairs: DataFrame, as_of: Column, most: float = 5.0) -> DataFrame:
    """Rows at most ``most`` seconds old."""
    return pairs.where(F.unix_micros(as_of) - F.unix_micros("ts") <= int(most * 1e6))


def run_available(df: DataFrame, mode: str = "append", progress: list | None = None) -> DataFrame:
    """Run a streaming DataFrame over what its source has now and return what it wrote; ``progress`` gets the query's reports. In update mode the last version of a (key, ts) is not singled out."""
    spark: SparkSession = df.sparkSession
    path, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-state")
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    else:
        def put(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

        q = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    if progress is not None:
        progress += q.recentProgress
    shape = df.schema if mode == "append" else df.withColumn("batch", F.lit(0)).schema
    return spark.read.schema(shape).parquet(path)

