"""Order-book operators over ticks: epochs, level intervals, quotes, depth, sequence gaps."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, bucket, over_days

LEVEL = [*KEY, "epoch", "side", "price_str"]
#: What ``epochs`` adds.
EPOCHS = ["epoch", "acc_epoch", "waiting"]


def epochs(ticks: DataFrame) -> DataFrame:
    """Adds epoch (opens at a snapshot or gap), acc_epoch (at a snapshot) and waiting (see B01); ticks that have all three stay as they are."""
    if set(EPOCHS) <= set(ticks.columns):
        return ticks
    snap, cut = F.col("msg_type") == "snapshot", F.col("msg_type").isin("snapshot", "gap")
    mark = F.when(snap, 0).when((F.col("msg_type") == "gap") & (F.col("gap_cause") == "internal_merge_error"), 1)
    out = over_days(ticks, sums={"epoch": cut.cast("int"), "acc_epoch": snap.cast("int")}, lasts={"waiting": mark})
    return out.withColumn("waiting", F.coalesce("waiting", F.lit(0)) == 1)


def with_epoch(ticks: DataFrame) -> DataFrame:
    """A snapshot or gap opens a book epoch. ``waiting`` marks rows after an ``internal_merge_error`` until the next snapshot."""
    return epochs(ticks).drop("acc_epoch")


def cold_start_filter(ticks: DataFrame) -> DataFrame:
    """Before a key's first snapshot updates wait, and those above its sequence are replayed after it (column ``replayed``); trades stay."""
    first = ticks.groupBy(*KEY).agg(F.min(F.when(F.col("msg_type") == "snapshot", F.struct("ts", "seq"))).alias("snap"))
    t = ticks.join(first, KEY)
    early = F.struct("ts", "seq") < F.col("snap")
    update = (F.col("msg_type") == "tick") & (F.col("event_type") == "update")
    buffered = update & F.coalesce(early, F.lit(True))
    return t.where(~buffered | (F.col("seq") > F.col("snap.seq"))).withColumn("replayed", buffered).drop("snap")


def synthetic_gaps(ticks: DataFrame, overflow: int = 1000) -> DataFrame:
    """Gap rows that the book itself makes: a snapshot right after a snapshot with no update between (``snapshot_superseded``), a snapshot below half the largest
    sequence seen (``seq_reset``), more than ``overflow`` updates before the first snapshot (``cold_start_buffer_overflow``)."""
    snap, update = F.col("msg_type") == "snapshot", F.coalesce(F.col("event_type") == "update", F.lit(False))
    t = over_days(ticks, sums={"nth": snap.cast("int"), "updates": update.cast("int")}, priors={"prior": F.when(snap | update, F.col("event_type"))}, tops={"most": F.when(update, F.col("seq"))})
    t = t.withColumn("held", F.when((F.col("nth") == 0) & update, F.col("updates")))
    cause = F.when(snap & (F.col("prior") == "snapshot"), "snapshot_superseded").when(snap & (F.col("seq") < F.col("most") / 2), "seq_reset").when(F.col("held") == overflow + 1, "cold_start_buffer_overflow")
    return t.withColumn("cause", cause).where("cause is not null").select(*KEY, "ts", "seq", "cause")


def dedupe_updates(ticks: DataFrame) -> DataFrame:
    """An update whose message sequence is not above all earlier ones is dropped, as is one without side or price; levels of one message (equal sequence and time) stay together."""
    u = ticks.where("msg_type = 'tick' and event_type = 'update' and side in ('buy', 'sell') and price_str is not null and price_str <> ''")
    # Equal times are one step of the running maximum.
    at = over_days(u.groupBy(*KEY, "ts").agg(F.max("seq").alias("newest")), tops={"most": F.col("newest")}, order=("ts",)).select(*KEY, "ts", "most")
    return u.join(at, [*KEY, "ts"]).where("most is null or seq > most").drop("most").select(*u.columns)


def level_intervals(ticks: DataFrame) -> DataFrame:
    """What each level holds and from when to when (valid_to null: still valid at the end of its epoch); removals leave no row."""
    t = with_epoch(ticks)
    ends = t.groupBy(*KEY, "epoch").agg(F.min(F.struct("ts", "seq")).alias("open"))
    ends = ends.select(*KEY, "epoch", F.lead("open").over(Window.partitionBy(*KEY).orderBy("epoch")).alias("close"))
    u = t.where("msg_type = 'tick' and event_type = 'update' and price_str is not null")
    nxt = F.lead(F.struct("ts", "seq")).over(Window.partitionBy(*LEVEL).orderBy("ts", "seq"))
    u = u.withColumn("next", nxt).where("size > 0").join(ends, [*KEY, "epoch"])
    end = F.coalesce("next", "close")
    return u.select(*LEVEL, "price", "size", F.col("ts").alias("valid_from"), F.col("seq").alias("from_seq"), end["ts"].alias("valid_to"), end["seq"].alias("to_seq"))


def update_kind(ticks: DataFrame) -> DataFrame:
    """Cancel (size 0, even of an absent level), modify (the level is there), add."""
    u = with_epoch(ticks).where("msg_type = 'tick' and event_type = 'update'")
    last = F.lag("size").over(Window.partitionBy(*LEVEL).orderBy("ts", "seq"))
    return u.withColumn("kind", F.when(F.col("size") == 0, "cancel").when(F.coalesce(last, F.lit(0.0)) > 0, "modify").otherwise("add"))


def _replay(rows: pd.DataFrame) -> pd.DataFrame:
    """Best quotes after every row of one key's day, with two heaps whose stale tops are dropped lazily; a new epoch starts empty."""
    rows = rows.sort_values(["ts", "seq", "seed"], ascending=[True, True, False], kind="stable")
    books: tuple[dict, dict] = ({}, {})
    heaps: tuple[list, list] = ([], [])
    out, now = [], None
    for epoch, seed, kind, side, price, size in zip(*[rows[c].tolist() for c in ("epoch", "seed", "event_type", "side", "price", "size")], strict=True):
        if epoch != now:
            now, books, heaps = epoch, ({}, {}), ([], [])
        if kind == "update" and price == price and side in ("buy", "sell"):
            k, sign = (0, -1) if side == "buy" else (1, 1)
            if size > 0:
                if price not in books[k]:
                    heapq.heappush(heaps[k], sign * price)
                books[k][price] = size
            else:
                books[k].pop(price, None)
        if seed:
            continue
        best = []
        for k, sign in ((0, -1), (1, 1)):
            while heaps[k] and sign * heaps[k][0] not in books[k]:
                heapq.heappop(heaps[k])
            best.append(sign * heaps[k][0] if heaps[k] else None)
        both = best[0] is not None and best[1] is not None
        out.append((best[0], books[0][best[0]], best[1], books[1][best[1]]) if both else (None,) * 4)
    keep = rows[~rows["seed"]][[*KEY, "epoch", "acc_epoch", "ts", "seq", "msg_type", "event_type"]].reset_index(drop=True)
    return pd.concat([keep, pd.DataFrame(out, columns=["bid", "bid_size", "ask", "ask_size"], dtype="float64")], axis=1)


QUOTES = "exchange string, symbol string, epoch long, acc_epoch long, ts timestamp, seq long, msg_type string, event_type string, bid double, bid_size double, ask double, ask_size double"


def best_quotes(ticks: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Best bid and ask after every tick; null if either side is empty. Adds mid, acc_epoch and book_epoch. ``levels`` are the ticks' level intervals, if they are at hand.

    The unit of work is a key's day; it starts with the levels that are alive at its midnight (from ``level_intervals``), so days run in parallel and no
    task holds more than one.
    """
    t = epochs(ticks).withColumn("day", F.to_date("ts"))
    levels = level_intervals(ticks) if levels is None else levels
    alive = levels.where("valid_to is null or to_date(valid_to) > to_date(valid_from)")
    last_day = t.groupBy(*KEY, "epoch").agg(F.max("day").alias("last_day"))
    alive = alive.join(last_day, [*KEY, "epoch"])
    until = F.least(F.coalesce(F.to_date("valid_to"), "last_day"), "last_day")
    days = F.when(until > F.to_date("valid_from"), F.sequence(F.date_add(F.to_date("valid_from"), 1), until))
    seeds = alive.select(*KEY, "epoch", F.explode(days).alias("day"), "side", "price", "size").select("*", F.col("day").cast("timestamp").alias("ts"), F.lit(-1).cast("long").alias("seq"), F.lit("tick").alias("msg_type"), F.lit("update").alias("event_type"), F.lit(0).cast("long").alias("acc_epoch"), F.lit(True).alias("seed"))
    rows = t.select(*KEY, "epoch", "day", "acc_epoch", "ts", "seq", "msg_type", "event_type", "side", "price", "size", F.lit(False).alias("seed")).unionByName(seeds)
    q = rows.groupBy(*KEY, "day").applyInPandas(_replay, QUOTES)
    return q.withColumn("mid", (F.col("bid") + F.col("ask")) / 2).withColumnRenamed("epoch", "book_epoch")


def with_prev_quote(quotes: DataFrame) -> DataFrame:
    """The quote before each tick, inside its epoch."""
    parts = ["bid", "bid_size", "ask", "ask_size"]
    out = over_days(quotes, priors={"before": F.struct("book_epoch", *parts)})
    same = F.col("before.book_epoch") == F.col("book_epoch")
    return out.select(*quotes.columns, *[F.when(same, F.col(f"before.{c}")).alias(f"prev_{c}") for c in parts])


def grid_of(ticks: DataFrame, tf: str) -> DataFrame:
    """Bar opens of each key with ticks."""
    return ticks.select(*KEY, bucket(F.col("ts"), tf).alias("ts")).distinct()


def book_at(levels: DataFrame, step: int) -> DataFrame:
    """Levels that are valid at each multiple of ``step`` seconds (column ``ts``), by exploding intervals instead of a range join.

    A level still valid at the end of the data is shown up to the last change of its key.
    """
    last = levels.groupBy(*KEY).agg(F.max(F.greatest(F.col("valid_from"), F.coalesce("valid_to", "valid_from"))).alias("last"))
    x = levels.join(last, KEY)
    lo = F.ceil(F.unix_micros("valid_from") / (step * 1_000_000)) * step
    end = F.coalesce("valid_to", "last")
    hi = F.when(F.col("valid_to").isNull(), F.floor(F.unix_micros(end) / (step * 1_000_000)) * step).otherwise((F.ceil(F.unix_micros(end) / (step * 1_000_000)) - 1) * step)
    at = F.explode(F.when(hi >= lo, F.sequence(lo, hi, F.lit(step).cast("long"))))
    return x.withColumn("at", at).select(*KEY, F.timestamp_seconds("at").alias("ts"), "side", "price", "size")


def ranked(levels: DataFrame) -> DataFrame:
    """Levels (key, ts, side, price, size > 0) with their rank from the best."""
    best_first = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    return levels.where("size > 0").withColumn("rank", F.row_number().over(Window.partitionBy(*KEY, "ts", "side").orderBy(best_first)))


def depth_snapshot(levels: DataFrame) -> DataFrame:
    """Cumulative sizes of the best 1-5 and 10 levels, total and size-weighted price, of both sides."""
    r, aggs = ranked(levels), []
    for side, name in (("buy", "bid"), ("sell", "ask")):
        own = F.col("side") == side
        aggs += [F.sum(F.when(own & (F.col("rank") <= n), F.col("size"))).alias(f"{name}_depth_{label}") for n, label in ((1, "l1"), (2, "l2"), (3, "l3"), (4, "l4"), (5, "l5"), (10, "top10"), (1 << 30, "total"))]
        aggs.append((F.sum(F.when(own, F.col("price") * F.col("size"))) / F.sum(F.when(own, F.col("size")))).alias(f"weighted_{name}_price"))
    return r.groupBy(*KEY, "ts").agg(*aggs)


def depth_1pct(levels: DataFrame) -> DataFrame:
    """Volume within 1 % of the best price."""
    w = Window.partitionBy(*KEY, "ts", "side")
    x = levels.where("size > 0").select("*", F.max("price").over(w).alias("hi"), F.min("price").over(w).alias("lo"))
    bid = (F.col("side") == "buy") & (F.col("price") >= F.col("hi") * 0.99)
    ask = (F.col("side") == "sell") & (F.col("price") <= F.col("lo") * 1.01)
    return x.groupBy(*KEY, "ts").agg(F.sum(F.when(bid, F.col("size"))).alias("depth_to_1pct_bid"), F.sum(F.when(ask, F.col("size"))).alias("depth_to_1pct_ask"))


def top_n_depth(levels: DataFrame, n: int, side: str) -> DataFrame:
    """B11."""
    return ranked(levels).where((F.col("side") == side) & (F.col("rank") <= n)).groupBy(*KEY, "ts").agg(F.sum("size").alias("depth"))


def book_heatmap(levels: DataFrame, n: int = 20) -> DataFrame:
    """Bid rank i beside ask rank i, 0 for an absent side."""
    r = ranked(levels).where(F.col("rank") <= n)

    def of(side: str, what: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col(what))), F.lit(0.0))

    return r.groupBy(*KEY, "ts", "rank").agg(of("buy", "price").alias("bid_price"), of("buy", "size").alias("bid_size"), of("sell", "price").alias("ask_price"), of("sell", "size").alias("ask_size"))


def book_feed(levels: DataFrame, n: int = 20) -> DataFrame:
    """The best ``n`` levels of both sides as arrays, mid, spread and side volumes (0 when a side is empty)."""
    r = ranked(levels).where(F.col("rank") <= n)

    def side(name: str) -> Column:
        own = F.when(F.col("side") == name, F.struct("rank", "price", "size"))
        return F.transform(F.array_sort(F.collect_list(own)), lambda x: F.struct(x["price"].alias("price"), x["size"].alias("size")))

    out = r.groupBy(*KEY, "ts").agg(side("buy").alias("bids"), side("sell").alias("asks"), F.sum(F.when(F.col("side") == "buy", F.col("size")).otherwise(0.0)).alias("bid_volume"), F.sum(F.when(F.col("side") == "sell", F.col("size")).otherwise(0.0)).alias("ask_volume"))
    bid, ask = F.get("bids", F.lit(0))["price"], F.get("asks", F.lit(0))["price"]
    both = bid.isNotNull() & ask.isNotNull()
    return out.select("*", F.when(both, (bid + ask) / 2).otherwise(0.0).alias("mid"), F.when(both, ask - bid).otherwise(0.0).alias("spread"))


def detect_gaps(ticks: DataFrame) -> DataFrame:
    """A sequence that is not the previous one plus 1; message sequences where both rows have them."""
    t = ticks.where("msg_type = 'tick'")
    for c in ("msg_seq_start", "msg_seq_end"):
        if c not in t.columns:
            t = t.withColumn(c, F.lit(None).cast("long"))
    t = over_days(t, priors={"before": F.struct("seq", "msg_seq_end")}).select(*t.columns, F.col("before.seq").alias("seq0"), F.col("before.msg_seq_end").alias("end0"))
    message = F.col("msg_seq_start").isNotNull() & F.col("end0").isNotNull()
    before, after = F.when(message, F.col("end0")).otherwise(F.col("seq0")), F.when(message, F.col("msg_seq_start")).otherwise(F.col("seq"))
    one_message = F.coalesce((F.col("msg_seq_end") == F.col("end0")) & message, F.lit(False))
    return t.where(before.isNotNull() & (after != before + 1) & ~one_message).select(*KEY, "ts", before.alias("seq_before"), after.alias("seq_after"))


#: Causes that lie inside the pipeline.
INTERNAL = ["internal_merge_error", "snapshot_superseded", "seq_reset", "cold_start_buffer_overflow"]


def gap_log(gaps: DataFrame) -> DataFrame:
    """Missing sequences and whether the cause is internal."""
    return gaps.select(*KEY, "ts", "seq_before", "seq_after", "gap_cause", (F.col("seq_after") - F.col("seq_before") - 1).alias("seq_gap"), F.when(F.col("gap_cause").isin(INTERNAL), "internal").otherwise("external").alias("gap_class"))


def dedupe_gaps(gaps: DataFrame) -> DataFrame:
    """The first row of each (before, after, cause)."""
    return gaps.groupBy(*KEY, "seq_before", "seq_after", "gap_cause").agg(F.min("ts").alias("ts"))


def gap_count_24h(gaps: DataFrame, as_of: Column) -> DataFrame:
    """Internal gaps in the hour of ``as_of`` and the 23 before."""
    hour = F.floor(F.unix_seconds("ts") / 3600)
    now = F.floor(F.unix_seconds(as_of) / 3600)
    return gaps.where(F.col("gap_cause").isin(INTERNAL)).groupBy(*KEY).agg(F.count_if((hour <= now) & (hour >= now - 23)).alias("gap_count_24h"))


def gap_count_series(gaps: DataFrame) -> DataFrame:
    """B16 as a series: the rolling 24-hour count at each hour that has a gap."""
    hours = gaps.where(F.col("gap_cause").isin(INTERNAL)).groupBy(*KEY, F.floor(F.unix_seconds("ts") / 3600).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours.select(*KEY, "hour", F.sum("n").over(Window.partitionBy(*KEY).orderBy("hour").rangeBetween(-23, 0)).alias("gap_count_24h"))


def gap_health(gaps: DataFrame, persistent: list[str], n: int, as_of: Column) -> DataFrame:
    """0 if a gap of a persistent cause lies in the last ``n`` seconds."""
    last = F.max(F.when(F.col("gap_cause").isin(persistent), F.unix_seconds("ts")))
    return gaps.groupBy(*KEY).agg(F.when(last > F.unix_seconds(as_of) - n, 0).otherwise(1).alias("healthy"))


def snapshot_merge(ticks: DataFrame) -> DataFrame:
    """For each snapshot the oldest update buffered since the one before; stale if that is above its sequence + 1; and how many are replayed."""
    snap = (F.col("msg_type") == "snapshot").cast("int")
    t = over_days(ticks, sums={"nth": snap}).withColumn("nth", F.col("nth") - snap)
    s = t.where("msg_type = 'snapshot'").select(*KEY, "nth", F.col("seq").alias("snap_seq"), "ts")
    u = t.where("event_type = 'update'").select(*KEY, "nth", "seq")
    out = s.join(u, [*KEY, "nth"], "left").groupBy(*KEY, "ts", "snap_seq").agg(F.min("seq").alias("oldest"), F.count_if(F.col("seq") > F.col("snap_seq")).alias("replayed"))
    return out.withColumn("stale", F.coalesce(F.col("oldest") > F.col("snap_seq") + 1, F.lit(False)))


def drop_buffering(ticks: DataFrame) -> DataFrame:
    """Between a gap and the next snapshot trades and updates are dropped; the gap row stays."""
    state = F.when(F.col("msg_type") == "gap", 1).when(F.col("msg_type") == "snapshot", 0)
    return over_days(ticks, lasts={"state": state}).where("msg_type <> 'tick' or coalesce(state, 0) = 0").drop("state")
