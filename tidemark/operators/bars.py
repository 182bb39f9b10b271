"""Fields of feature bars; each operator takes ticks, trades or quotes and a bar length and gives one row per key and bar (column ``ts``: bar open)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, bucket, in_order, over_days, ratio, seconds, with_bar
from tidemark.operators import footprint
from tidemark.operators.book import EPOCHS
from tidemark.sources.io import scratch

BAR = [*KEY, "bar"]


def stream_order() -> Column:
    return F.struct("ts", "seq")


def per_bar(df: DataFrame, *aggs: Column) -> DataFrame:
    return df.groupBy(*BAR).agg(*aggs).withColumnRenamed("bar", "ts")


def in_bar():
    return in_order("bar")


def trade_steps(trades: DataFrame, tf: str) -> DataFrame:
    """Each trade with its bar and what it has before and after it there; windows run inside a bar."""
    w = in_bar()
    t = with_bar(trades, tf).withColumn("sign", F.when(F.col("side") == "buy", 1.0).otherwise(-1.0))
    end = F.unix_micros("bar") + seconds(tf) * 1_000_000
    t = t.select(
        "*", F.lag("price").over(w).alias("price0"), F.lag("sign").over(w).alias("sign0"), F.row_number().over(w).alias("nth"), (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))).alias("step"),
        ((F.coalesce(F.unix_micros(F.lead("ts").over(w)), end) - F.unix_micros("ts")) / 1e6).alias("held"),
    )
    t = t.withColumn("gap_us", F.when(F.col("step") > 0, F.col("step")).when(F.col("step").isNotNull(), F.lit(0)))
    turn = F.when(F.col("sign0").isNull() | (F.col("sign0") != F.col("sign")), F.col("nth"))
    run = F.col("nth") - F.max(turn).over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1
    by_gap = Window.partitionBy(*BAR).orderBy(F.col("gap_us").asc_nulls_last())
    return t.select("*", run.alias("run"), F.row_number().over(by_gap).alias("gap_rank"))


def quote_steps(quotes: DataFrame) -> DataFrame:
    """Each quote with the valid one before it (of any epoch), the one of its accumulator epoch, the log return since that, and the order flow against the row before."""
    valid = F.when(F.col("mid").isNotNull(), F.struct("ts", "acc_epoch", "bid", "ask", "mid"))
    q = over_days(quotes, priors={"valid0": valid, "row0": F.struct("book_epoch", "bid", "ask", "bid_size", "ask_size")})
    carried = F.when((F.col("valid0.acc_epoch") == F.col("acc_epoch")) & F.col("mid").isNotNull(), F.col("valid0"))
    old = F.when(F.col("row0.book_epoch") == F.col("book_epoch"), F.col("row0"))
    q = q.select(*quotes.columns, "valid0", carried.alias("carried"), old.alias("old"))
    bid = F.when(F.col("bid") == F.col("old.bid"), F.col("bid_size") - F.col("old.bid_size")).when(F.col("bid") > F.col("old.bid"), F.col("bid_size")).otherwise(0.0)
    ask = F.when(F.col("ask") == F.col("old.ask"), F.col("ask_size") - F.col("old.ask_size")).when(F.col("ask") < F.col("old.ask"), F.col("ask_size")).otherwise(0.0)
    whole = F.col("mid").isNotNull() & F.col("old.bid").isNotNull() & F.col("old.ask").isNotNull()
    return q.select("*", F.log(F.col("mid") / F.col("carried.mid")).alias("r"), F.when(whole, bid - ask).otherwise(0.0).alias("flow"))


def quote_bar(quotes: DataFrame, tf: str) -> DataFrame:
    """``quote_steps`` with the bar, the spread, and the valid quote before it in the bar."""
    q = with_bar(quote_steps(quotes), tf).withColumn("spread", F.when(F.col("mid").isNotNull(), F.col("ask") - F.col("bid")))
    return q.withColumn("in_bar", F.when((bucket(F.col("valid0.ts"), tf) == F.col("bar")) & F.col("mid").isNotNull(), F.col("valid0")))


def first_of(c: Column | str, where: Column) -> Column:
    return F.min_by(c, F.when(where, stream_order()))


def last_of(c: Column | str, where: Column) -> Column:
    return F.max_by(c, F.when(where, stream_order()))



def bought() -> Column:
    return F.col("side") == "buy"


def ohlcv_fields() -> list[Column]:
    return [
        F.min_by("price", stream_order()).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", stream_order()).alias("close"),
        F.sum("size").alias("volume"), F.sum(F.col("price") * F.col("size")).alias("quote_volume"), F.count(F.lit(1)).alias("trade_count"),
    ]


def ohlcv(trades: DataFrame, tf: str) -> DataFrame:
    """F01."""
    return per_bar(with_bar(trades, tf), *ohlcv_fields())


def twap_fields() -> list[Column]:
    return [F.coalesce(ratio(F.sum(F.col("price") * F.col("held")), F.sum("held")), F.max_by("price", stream_order())).alias("twap")]


def twap(trades: DataFrame, tf: str) -> DataFrame:
    """a price is held until the next trade, the last one until the bar ends; equal times only: the last price."""
    return per_bar(trade_steps(trades, tf), *twap_fields())


def mid_fields() -> list[Column]:
    mid = F.col("mid").isNotNull()
    return [first_of("mid", mid).alias("mid_price_open"), F.max("mid").alias("mid_price_high"), F.min("mid").alias("mid_price_low")]


def mid_path(quotes: DataFrame, tf: str) -> DataFrame:
    """F03, over ticks with both quotes."""
    return per_bar(with_bar(quotes.where("mid is not null"), tf), *mid_fields())


def spread_fields() -> list[Column]:
    return [F.max("spread").alias("spread_high"), F.min("spread").alias("spread_low"), F.avg("spread").alias("spread_mean")]


def spread_stats(quotes: DataFrame, tf: str) -> DataFrame:
    """tick-weighted mean."""
    return per_bar(with_bar(quotes.where("mid is not null"), tf).withColumn("spread", F.col("ask") - F.col("bid")), *spread_fields())


def mid_price_fields() -> list[Column]:
    sized = F.when(F.col("mid").isNotNull(), F.col("size"))
    return [ratio(F.sum(F.col("mid") * sized), F.sum(sized)).alias("vwmp"), F.avg(2 * F.abs(F.col("price") - F.col("mid"))).alias("effective_spread")]


def vwmp(trades_q: DataFrame, tf: str) -> DataFrame:
    """mid prices weighed by trade sizes, over trades with a mid."""
    return per_bar(with_bar(trades_q.where("mid is not null"), tf), mid_price_fields()[0])


def effective_spread(trades_q: DataFrame, tf: str) -> DataFrame:
    """mean of twice the distance of price and mid."""
    return per_bar(with_bar(trades_q.where("mid is not null"), tf), mid_price_fields()[1])


def edge_fields() -> list[Column]:
    mid = F.col("mid").isNotNull()
    opening = first_of(F.struct(F.coalesce("carried.bid", "bid").alias("bid"), F.coalesce("carried.ask", "ask").alias("ask")), mid)
    closing = last_of(F.struct("bid", "ask"), mid)
    return [opening["bid"].alias("best_bid_open"), opening["ask"].alias("best_ask_open"), closing["bid"].alias("best_bid"), closing["ask"].alias("best_ask")]


def open_close_quotes(quotes: DataFrame, tf: str) -> DataFrame:
    """the quote carried into the bar inside the accumulator epoch (the bar's first if none) and the bar's last."""
    return per_bar(quote_bar(quotes, tf).where("mid is not null"), *edge_fields())


def change_fields() -> list[Column]:
    return [F.when(F.count("mid") > 0, F.count_if(F.col(x) != F.col(f"in_bar.{x}"))).alias(f"best_{x}_changes") for x in ("bid", "ask")]


def quote_changes(quotes: DataFrame, tf: str) -> DataFrame:
    """changes against the previous valid quote of the bar."""
    return per_bar(quote_bar(quotes, tf).where("mid is not null"), *change_fields())


def ofi_l1(quotes: DataFrame, tf: str) -> DataFrame:
    """order-flow imbalance of the best quotes; a tick with any quote missing adds 0."""
    return per_bar(quote_bar(quotes, tf), F.sum("flow").alias("ofi_l1")).withColumn("ofi", F.col("ofi_l1"))


def side_fields() -> list[Column]:
    volume = F.sum(F.when(bought(), F.col("size")).otherwise(0.0))
    return [volume.alias("buy_volume"), F.count_if(bought()).alias("buy_count"), F.greatest(F.lit(0.0), F.sum("size") - volume).alias("sell_volume")]


def side_volumes(trades: DataFrame, tf: str) -> DataFrame:
    """F11."""
    return per_bar(with_bar(trades, tf), *side_fields())


def block_trades(trades_thr: DataFrame, tf: str) -> DataFrame:
    """trades strictly above the rolling threshold (W01); null where a bar has none."""
    big, buy = F.col("size") > F.col("threshold"), F.col("side") == "buy"
    t = with_bar(trades_thr, tf)
    return per_bar(
        t, F.sum(F.when(big & buy, F.col("size"))).alias("block_buy_volume"), F.sum(F.when(big & ~buy, F.col("size"))).alias("block_sell_volume"),
        F.sum(F.when(big & buy, 1)).alias("large_bid_orders"), F.sum(F.when(big & ~buy, 1)).alias("large_ask_orders"),
    )


def extreme_fields() -> list[Column]:
    ms = F.floor((F.unix_micros("ts") - F.unix_micros("bar")) / 1000)
    return [F.max("size").alias("max_trade_size"), F.greatest(F.min(ms), F.lit(0)).alias("first_trade_offset_ms"), F.greatest(F.max(ms), F.lit(0)).alias("last_trade_offset_ms")]


def trade_extremes(trades: DataFrame, tf: str) -> DataFrame:
    """offsets from the bar's open, in ms."""
    return per_bar(with_bar(trades, tf), *extreme_fields())


def max_run(trades: DataFrame, tf: str) -> DataFrame:
    """the longest run of trades of one side."""
    return per_bar(trade_steps(trades, tf), F.max("run").alias("max_consecutive_run"))


def gini() -> Column:
    gaps = F.count("gap_us")
    weighted = F.sum(F.col("gap_rank") * F.col("gap_us"))
    return ratio((2 * weighted - (gaps + 1) * F.sum("gap_us")).cast("double"), (gaps * F.sum("gap_us")).cast("double")).alias("trade_clustering")


def interval_gini(trades: DataFrame, tf: str) -> DataFrame:
    """Gini of the times between trades; null with fewer than two trades or a zero sum."""
    return per_bar(trade_steps(trades, tf), gini(), F.count("gap_us").alias("gaps")).where("gaps > 0").drop("gaps")


def return_fields() -> list[Column]:
    return [F.when(F.stddev_samp("r") > 0, F.stddev_samp("r")).alias("realized_vol"), F.when((F.count("r") >= 3) & (F.var_pop("r") > 0), F.skewness("r")).alias("realized_skewness")]


def realized_vol(quotes: DataFrame, tf: str) -> DataFrame:
    """F16: sample deviation of log mid returns, each from the previous mid of the accumulator epoch; null below two returns or without variance."""
    return per_bar(quote_bar(quotes, tf).where("r is not null"), return_fields()[0])


def realized_skew(quotes: DataFrame, tf: str) -> DataFrame:
    """population skewness; null below three returns or without variance."""
    return per_bar(quote_bar(quotes, tf).where("r is not null"), return_fields()[1])


def tick_fields() -> list[Column]:
    return [F.count_if(F.col("price") > F.col("price0")).alias("uptick_count"), F.count_if(F.col("price") < F.col("price0")).alias("downtick_count")]


def tick_counts(trades: DataFrame, tf: str) -> DataFrame:
    """F18."""
    return per_bar(trade_steps(trades, tf), *tick_fields())


def book_activity(kinds: DataFrame, tf: str) -> DataFrame:
    """F19, from updates with their kind (B08); null where a bar has no book event."""
    def n(kind: str, side: str) -> Column:
        return F.count_if((F.col("kind") == kind) & (F.col("side") == side))

    arrived = F.col("kind") == "add"
    return per_bar(
        with_bar(kinds, tf), n("add", "buy").alias("bid_order_arrivals"), n("add", "sell").alias("ask_order_arrivals"), n("cancel", "buy").alias("bid_cancel_count"), n("cancel", "sell").alias("ask_cancel_count"),
        F.count_if(F.col("kind") == "modify").alias("ob_modify_count"), F.avg(F.when(arrived & (F.col("side") == "buy"), F.col("size"))).alias("avg_bid_order_size"), F.avg(F.when(arrived & (F.col("side") == "sell"), F.col("size"))).alias("avg_ask_order_size"),
    )


def quote_stuff_ratio(bars: DataFrame) -> DataFrame:
    """arrivals and cancels over trades."""
    events = F.col("bid_order_arrivals") + F.col("ask_order_arrivals") + F.col("bid_cancel_count") + F.col("ask_cancel_count")
    return bars.withColumn("quote_stuff_ratio", ratio(events.cast("double"), F.col("trade_count").cast("double")))


def sign_autocorr_field() -> Column:
    now = F.when(F.col("sign0").isNotNull(), F.col("sign"))
    return ratio(F.covar_pop("sign0", now), F.stddev_pop(now) * F.stddev_pop("sign0")).alias("trade_sign_autocorr")


def sign_autocorr(trades: DataFrame, tf: str) -> DataFrame:
    """lag-1 correlation of trade signs; null below two trades or if either series is constant."""
    return per_bar(trade_steps(trades, tf).where("sign0 is not null"), sign_autocorr_field())


def interval_field() -> Column:
    return F.stddev_pop(F.col("gap_us") / 1000).alias("inter_trade_interval_std_ms")


def interval_std(trades: DataFrame, tf: str) -> DataFrame:
    """population deviation of the times between trades, in ms."""
    return per_bar(trade_steps(trades, tf).where("gap_us is not null"), interval_field())


def price_levels(trades: DataFrame, tf: str) -> DataFrame:
    """distinct price texts."""
    return per_bar(with_bar(trades, tf), F.countDistinct("price_str").alias("num_trade_price_levels"))


def hawkes(ticks: DataFrame, tf: str, alpha: float = 0.8, beta: float = 10.0, block: int = 3600) -> DataFrame:
    """excitation at the last tick of each bar, never reset. Sums of one second each are decayed over the last five seconds
    (older terms are below e^-50 of their size), so a frame holds six rows however dense the stream is. Windows run over blocks of ``block`` seconds, each with
    the five seconds before it."""
    t = ticks.where("msg_type = 'tick'").withColumn("s", F.unix_seconds("ts")).withColumn("at", F.unix_micros("ts") / 1e6 - F.col("s"))
    each = t.groupBy(*KEY, "s").agg(F.sum(F.exp(F.lit(beta) * (F.col("at") - 1))).alias("a"), F.max("at").alias("last"))
    home = F.floor(F.col("s") / block)
    each = each.withColumn("block", F.explode(F.array_distinct(F.array(home, F.floor((F.col("s") + 5) / block)))))
    near = Window.partitionBy(*KEY, "block").orderBy("s").rangeBetween(-5, 0)
    each = each.withColumn("near", F.collect_list(F.struct("s", "a")).over(near)).where(F.col("block") == home).withColumn("bar", bucket(F.timestamp_seconds("s"), tf))
    last = each.groupBy(*BAR).agg(F.max_by(F.struct("s", "last", "near"), "s").alias("x"))
    value = F.aggregate("x.near", F.lit(0.0), lambda acc, e: acc + e["a"] * F.exp(-F.lit(beta) * (F.col("x.s") - e["s"] + F.col("x.last") - 1)))
    return last.select(*KEY, F.col("bar").alias("ts"), (F.lit(alpha) * value).alias("hawkes_intensity"))


def with_reset_epochs(ticks: DataFrame) -> DataFrame:
    """Adds acc_epoch (opens at a snapshot), cvd_epoch (snapshot or gap) and book_epoch (the same boundaries as B01)."""
    if set(EPOCHS) <= set(ticks.columns):
        return ticks.withColumns({"cvd_epoch": F.col("epoch"), "book_epoch": F.col("epoch")})
    snap, cut = (F.col("msg_type") == "snapshot").cast("int"), F.col("msg_type").isin("snapshot", "gap").cast("int")
    return over_days(ticks, sums={"acc_epoch": snap, "cvd_epoch": cut}).withColumn("book_epoch", F.col("cvd_epoch"))


def bar_quality(ticks: DataFrame, tf: str) -> DataFrame:
    """gaps in the bar, the bar's number since the last snapshot, and whether a snapshot cut it."""
    t = with_bar(with_reset_epochs(ticks), tf)
    b = per_bar(t, F.count_if(F.col("msg_type") == "gap").alias("gap_count"), F.count_if(F.col("msg_type") == "snapshot").alias("cuts"), F.max("acc_epoch").alias("acc_epoch"))
    b = over_days(b, sums={"bar_seq": F.lit(1)}, by=[*KEY, "acc_epoch"], order=("ts",))
    return b.select(*KEY, "ts", "gap_count", F.col("bar_seq").cast("long").alias("bar_seq"), (F.col("cuts") > 0).alias("is_partial"))


def fill_empty_bars(bars: DataFrame, tf: str) -> DataFrame:
    """one row per slot between a key's first and last bar; absent ones have nulls."""
    step = seconds(tf)
    spine = bars.groupBy(*KEY).agg(F.min(F.unix_seconds("ts")).alias("a"), F.max(F.unix_seconds("ts")).alias("b"))
    spine = spine.select(*KEY, F.explode(F.sequence("a", "b", F.lit(step).cast("long"))).alias("s")).select(*KEY, F.timestamp_seconds("s").alias("ts"))
    return spine.join(bars, [*KEY, "ts"], "left")


def cum_delta(bars: DataFrame) -> DataFrame:
    """running buy minus sell volume of bars with trades inside a cvd_epoch, and its divergence from the close (+1 bearish)."""
    by = [*KEY, "cvd_epoch"]
    b = over_days(bars.where("trade_count > 0"), sums={"cum_delta": F.col("buy_volume") - F.col("sell_volume")}, by=by, order=("ts",))
    b = over_days(b, priors={"bar0": F.struct("close", "cum_delta")}, by=by, order=("ts",))
    up, down = F.col("close") - F.col("bar0.close"), F.col("cum_delta") - F.col("bar0.cum_delta")
    return b.withColumn("cvd_divergence", F.when(up.isNull(), None).when((up > 0) & (down < 0), 1).when((up < 0) & (down > 0), -1).otherwise(0)).drop("bar0")


def iceberg(bars: DataFrame) -> DataFrame:
    """F32: the best level was refilled although its side traded and orders arrived."""
    def refilled(side: str, volume: str) -> Column:
        o, c = F.col(f"{side}_depth_l1_open"), F.col(f"{side}_depth_l1_close")
        return F.coalesce((o > 0) & (c >= 0.8 * o) & (F.col(volume) > 0) & (F.col(f"{side}_order_arrivals") > 0), F.lit(False))

    bid, ask = refilled("bid", "buy_volume"), refilled("ask", "sell_volume")
    return bars.withColumn("iceberg_bid_detected", bid).withColumn("iceberg_ask_detected", ask).withColumn("iceberg_price", F.when(bid, F.col("best_bid")).when(ask, F.col("best_ask")))


def microprice(bars: DataFrame) -> DataFrame:
    """size-weighted mid of the closing quotes and its distance from the mid in basis points."""
    b, a, bs, sz = F.col("best_bid"), F.col("best_ask"), F.col("bid_depth_l1_close"), F.col("ask_depth_l1_close")
    mid = (b + a) / 2
    micro = F.when(bs + sz != 0, (a * bs + b * sz) / (bs + sz)).otherwise(mid)
    return bars.withColumn("microprice", micro).withColumn("microprice_mid_delta", ratio(micro - mid, mid) * 10_000)


def cancel_bias(bars: DataFrame) -> DataFrame:
    """F35."""
    b, a = F.col("bid_cancel_count"), F.col("ask_cancel_count")
    return bars.withColumn("cancel_bias", (b - a) / (b + a + 1).cast("double"))


def trade_aggressiveness(bars: DataFrame) -> DataFrame:
    """volume over the closing best bid size; 0 without one, null without trades."""
    d = F.coalesce("bid_depth_l1_close", F.lit(0.0))
    return bars.withColumn("trade_aggressiveness", F.when(F.coalesce("trade_count", F.lit(0)) == 0, None).when(d == 0, 0.0).otherwise(F.col("volume") / (d + 1e-9)))


def vwap_deviation(trades: DataFrame, closing: DataFrame, tf: str) -> DataFrame:
    """each side's VWAP against the closing mid (columns best_bid, best_ask of ``closing``), in basis points."""
    buy = F.col("side") == "buy"

    def vwap(cond: Column) -> Column:
        return ratio(F.sum(F.when(cond, F.col("price") * F.col("size"))), F.sum(F.when(cond, F.col("size"))))

    v = per_bar(with_bar(trades, tf), vwap(buy).alias("buy_vwap"), vwap(~buy).alias("sell_vwap"))
    mid = (F.col("best_bid") + F.col("best_ask")) / 2
    out = v.join(closing.select(*KEY, "ts", "best_bid", "best_ask"), [*KEY, "ts"])
    return out.select(*KEY, "ts", ((F.col("buy_vwap") - mid) / mid * 10_000).alias("buy_vwap_deviation_bps"), ((F.col("sell_vwap") - mid) / mid * 10_000).alias("sell_vwap_deviation_bps"))


def absorption(bars: DataFrame) -> DataFrame:
    """five trades or more, a lopsided side ratio and a close near the open."""
    share = ratio(F.col("buy_volume"), F.col("volume"))
    still = F.abs(F.col("close") - F.col("open")) / F.col("close") < 0.0005
    return bars.withColumn("absorption_detected", F.coalesce((F.col("trade_count") >= 5) & ((share > 0.6) | (share < 0.4)) & still, F.lit(False)))


def footprint_divergence(bars: DataFrame) -> DataFrame:
    """+1 an up bar with net selling, -1 a down bar with net buying."""
    net = F.col("buy_volume") - F.col("sell_volume")
    move = F.col("close") - F.col("open")
    return bars.withColumn("footprint_delta_divergence", F.when(move.isNull() | net.isNull(), None).when((move > 0) & (net < 0), 1).when((move < 0) & (net > 0), -1).otherwise(0))


def build_bars(ticks: DataFrame, quotes: DataFrame, kinds: DataFrame, trades: DataFrame, tf: str, more: list[DataFrame] | None = None) -> DataFrame:
    """F01-F23, F33 and F38 in one table (and ``more`` tables with the key and ts, such as depths): one row per bar with any message.

    Trades, quotes and updates are aggregated once each; what is joined are bars.
    """
    trades_q = trades.join(quotes.where("event_type = 'trade'").select(*KEY, "seq", "mid"), [*KEY, "seq"], "left")
    of_trades = per_bar(
        trade_steps(trades_q, tf), *ohlcv_fields(), *twap_fields(), *side_fields(), *extreme_fields(), *tick_fields(), *mid_price_fields(), F.max("run").alias("max_consecutive_run"), gini(), sign_autocorr_field(), interval_field(),
        F.countDistinct("price_str").alias("num_trade_price_levels"),
    )
    of_quotes = per_bar(quote_bar(quotes, tf), *mid_fields(), *spread_fields(), *edge_fields(), *change_fields(), *return_fields(), F.sum("flow").alias("ofi_l1")).withColumn("ofi", F.col("ofi_l1"))
    parts = [bar_quality(ticks, tf), of_trades, of_quotes, book_activity(kinds, tf), hawkes(ticks, tf), *(more or [])]
    return reduce(lambda a, b: a.join(b, [*KEY, "ts"], "left"), parts)


def whole_bars(ticks: DataFrame, quotes: DataFrame, kinds: DataFrame, trades_thr: DataFrame, depths: DataFrame, tf: str, fill: bool = False) -> DataFrame:
    """The whole bar row, F01-F38: ``build_bars`` with block trades, depths, footprint and what follows from it, book signals and cumulative delta; with ``fill`` (F39) absent bars between a key's first and last are rows too.

    ``trades_thr`` are trades with W01's threshold, ``depths`` the depth columns (F09) by key and ts. The footprint is aggregated once; what is joined are bars. Fields of trades are null in
    a bar without trades, flags are false there.
    """
    long = footprint.footprint_long(trades_thr, tf)
    parts = [depths, block_trades(trades_thr, tf), footprint.footprint(long), footprint.value_area(long), footprint.imbalance(long)]
    b = build_bars(ticks, quotes, kinds, trades_thr, tf, parts)
    for add in (quote_stuff_ratio, absorption, footprint_divergence, iceberg, microprice, cancel_bias, trade_aggressiveness):
        b = add(b)
    epochs = per_bar(with_bar(with_reset_epochs(ticks), tf), F.max("cvd_epoch").alias("cvd_epoch"))
    b = written_once(b.join(epochs, [*KEY, "ts"], "left"))  # three parts below read it
    more = [footprint.auction_signals(long, b), vwap_deviation(trades_thr, b, tf), cum_delta(b).select(*KEY, "ts", "cum_delta", "cvd_divergence")]
    b = reduce(lambda x, y: x.join(y, [*KEY, "ts"], "left"), [b.drop("cvd_epoch"), *more])
    return fill_empty_bars(b, tf) if fill else b


def written_once(df: DataFrame) -> DataFrame:
    path = scratch(df.sparkSession, "bars")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
