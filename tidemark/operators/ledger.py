"""Fills, profit and loss, backtest and validation tables. A book is (strategy, exchange, symbol)."""

from __future__ import annotations

import zlib
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import core
from tidemark.core import KEY, in_chunks, over_days, ratio, seconds, written
from tidemark.operators.places import in_ranks

BOOK = ["strategy", *KEY]
FILL_ORDER = ("ts", "seq")
#: Fills and trades are far fewer than ticks: a book's month is the unit of work.
over_months = partial(over_days, unit="month")


def book_order():
    return Window.partitionBy(*BOOK).orderBy(*FILL_ORDER)


def _with_costs(buys: pd.Series, prices: pd.Series, sizes: pd.Series, starts: pd.Series, values: pd.Series) -> pd.DataFrame:
    """The results of each block's fills from what its book held and what that had cost at the block's start."""
    out = []
    for fills in zip(buys, prices, sizes, starts, values, strict=True):
        held, value = fills[3:]
        cost = value / held if held else 0.0
        pnl, size, price = [], [], []
        for buy, p, q in zip(*(x.tolist() for x in fills[:3]), strict=True):
            gain = 0.0
            if buy:
                cost = (cost * held + p * q) / (held + q) if held + q else 0.0
                held += q
            else:
                sold = min(q, held)
                gain = sold * (p - cost)
                held -= sold
                cost = cost if held > 0 else 0.0
            pnl.append(gain)
            size.append(held)
            price.append(cost)
        out.append([np.array(x) for x in (pnl, size, price)])
    return pd.DataFrame(out, columns=["realized_pnl", "position_size_after", "avg_cost"])


def _held_map() -> Column:
    """A block turns the size held into max(held + x, y)."""
    def step(a: Column, r: Column) -> Column:
        q = r["size_"]
        return F.struct(F.when(r["buy_"], a["x"] + q).otherwise(a["x"] - q).alias("x"), F.when(r["buy_"], a["y"] + q).otherwise(F.greatest(a["y"] - q, F.lit(0.0))).alias("y"))

    return F.aggregate(F.arrays_zip("buy_", "size_"), F.struct(F.lit(0.0).alias("x"), F.lit(float("-inf")).alias("y")), step)


def _value_map() -> Column:
    """A block turns the cost of what is held, v, into x v + y: a sale keeps the share that is left, a buy adds its price."""
    def step(a: Column, r: Column) -> Column:
        q = r["size_"]
        left = F.greatest(a["held"] - q, F.lit(0.0))
        keep = F.when(r["buy_"], 1.0).when(a["held"] != 0, left / a["held"]).otherwise(0.0)
        return F.struct(F.when(r["buy_"], a["held"] + q).otherwise(left).alias("held"), (a["x"] * keep).alias("x"), F.when(r["buy_"], a["y"] + r["price_"] * q).otherwise(a["y"] * keep).alias("y"))

    return F.aggregate(F.arrays_zip("buy_", "price_", "size_"), F.struct(F.col("held_").alias("held"), F.lit(1.0).alias("x"), F.lit(0.0).alias("y")), step)


def _fold_blocks(out: str, step):
    """The state at the start of each block of one book, from 0 on; a book has one row for each block."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["month_", "block_"])
        at, state = [], 0.0
        for x, y in rows[["x", "y"]].itertuples(index=False):
            at.append(state)
            state = step(state, x, y)
        return rows.assign(**{out: at, "before_": rows["n_"].cumsum() - rows["n_"]})[["id_", "before_", out]]

    return run


def realize_pnl(fills: DataFrame) -> DataFrame:
    """Average cost, long only: buys average in, a sell realises what is held, flat resets.

    The unit of work is a block, a book's month or at most ``core.BLOCK`` fills of it, written once as arrays. It turns the size held into max(held + x, y) and, once that is known, its cost
    into an affine function of itself; both fold over a book's blocks, of which there are few, and then each block is computed from its own start. Fills are shuffled once.
    """
    columns = ["ts", "order_id", "side", "price", "size"]
    month = F.coalesce(F.year("ts") * 12 + F.month("ts"), F.lit(-1)).alias("month_")
    t = fills.withColumns({c: F.col(c).cast("double") for c in ("price", "size")}).select(*BOOK, month, F.struct(*FILL_ORDER).alias("at_"), *columns)
    t = t.withColumn("at_", F.row_number().over(Window.partitionBy(*BOOK, "month_").orderBy("at_")))
    t = t.withColumn("block_", F.floor((F.col("at_") - 1) / core.BLOCK)).groupBy(*BOOK, "month_", "block_").agg(F.array_sort(F.collect_list(F.struct("at_", *columns))).alias("rows_"))
    arrays = [F.col(f"rows_.{c}").alias(f"{c}_") for c in columns]
    buys = F.transform("rows_.side", lambda side: F.coalesce(side == "buy", F.lit(False))).alias("buy_")
    blocks = written(t.select(*BOOK, "month_", "block_", F.monotonically_increasing_id().alias("id_"), *arrays, buys), "blocks")
    place = [*BOOK, "month_", "block_", "id_", F.size("size_").alias("n_")]
    held = blocks.select(*place, _held_map().alias("f")).select("*", "f.x", "f.y").drop("f").groupBy(*BOOK).applyInPandas(_fold_blocks("held_", lambda h, x, y: max(h + x, y)), "id_ long, before_ long, held_ double")
    held = written(held, "held")
    maps = blocks.join(held, "id_").select(*place, _value_map().alias("f")).select("*", "f.x", "f.y").drop("f")
    value = maps.groupBy(*BOOK).applyInPandas(_fold_blocks("value_", lambda v, m, c: m * v + c), "id_ long, before_ long, value_ double").drop("before_")
    whole = blocks.join(held, "id_").join(written(value, "value"), "id_")
    results = ["realized_pnl", "position_size_after", "avg_cost"]
    costs = F.pandas_udf(_with_costs, "struct<" + ",".join(f"{c}:array<double>" for c in results) + ">")
    whole = whole.withColumn("r", costs("buy_", "price_", "size_", "held_", "value_"))
    rows = F.arrays_zip(*[F.col(f"{c}_").alias(c) for c in columns], *[F.col(f"r.{c}").alias(c) for c in results])
    out = whole.select(*BOOK, "before_", F.posexplode(rows).alias("i_", "f"))
    return out.select(*BOOK, (F.col("before_") + F.col("i_") + 1).alias("nth"), *[F.col(f"f.{c}").alias(c) for c in (*columns, *results)])


def dedupe_fills(fills: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One fill for each known order (the first), and the fills of unknown orders."""
    first = fills.withColumn("copy", F.row_number().over(Window.partitionBy("order_id").orderBy(*FILL_ORDER))).where("copy = 1").drop("copy")
    known = orders.select("order_id").distinct()
    return first.join(known, "order_id", "left_semi"), first.join(known, "order_id", "left_anti")


def with_slippage(fills: DataFrame) -> DataFrame:
    """L03."""
    return fills.withColumn("slippage", F.when(F.col("limit_price").isNotNull(), (F.col("price") - F.col("limit_price")) * F.col("size")))


def position_metrics(ledger: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Unrealised and cumulative pnl, drawdown from a peak that starts at 0. Fills in the order of nth; without that column they are numbered, and the columns ``keep`` (all) stay."""
    led = ledger.withColumn("unrealized_pnl", (F.col("price") - F.col("avg_cost")) * F.col("position_size_after"))
    led = _curve(led, 0.0, [*keep, "unrealized_pnl"] if keep else None).withColumnRenamed("equity", "cum_pnl")
    return led.withColumn("drawdown", F.col("peak") - F.col("cum_pnl")).drop("peak")


def order_gates(requests: DataFrame, max_order: float, max_position: float) -> DataFrame:
    """Refuse an entry while another entry of the book is open, above the single-order cap, or above the position cap; exits and stops pass.

    ``intent`` is entry, exit or stop; an entry stays open until the book's next exit.
    """
    r = requests.withColumn("notional", F.col("price") * F.col("size"))
    net = F.when(F.col("intent") == "entry", F.col("notional")).otherwise(-F.col("notional"))
    r = over_months(r, sums={"placed": net}, priors={"prior": F.col("intent")}, by=BOOK, order=FILL_ORDER, ties=False, stored=True)
    r = r.withColumn("placed", F.greatest(F.col("placed") - net, F.lit(0.0)))
    gate = F.when(F.col("intent") != "entry", "pass").when(F.col("prior") == "entry", "duplicate_entry").when(F.col("notional") > max_order, "order_cap").when(F.col("placed") + F.col("notional") > max_position, "position_cap").otherwise("pass")
    return r.withColumn("gate", gate).drop("prior", "placed")


def daily_loss_trips(ledger: DataFrame, limit: float) -> DataFrame:
    """The first fill of a UTC day at which the day's pnl of a strategy is below -limit."""
    w = Window.partitionBy("strategy", "day").orderBy("ts", *KEY, "nth")
    d = ledger.withColumn("day", F.to_date("ts")).withColumn("day_pnl", F.sum("realized_pnl").over(w))
    d = d.where(F.col("day_pnl") < -limit)
    return d.groupBy("strategy", "day").agg(F.min_by("day_pnl", F.struct("ts", *KEY, "nth")).alias("day_pnl"), F.min("ts").alias("tripped_at"))


#: Statuses after which nothing more happens.
TERMINAL = ["filled", "rejected", "cancelled", "failed"]


def nonterminal_orders(events: DataFrame) -> DataFrame:
    """The latest event of each order unless it is terminal."""
    w = Window.partitionBy("order_id").orderBy(F.desc("ts"), F.desc("seq"))
    return events.withColumn("back", F.row_number().over(w)).where((F.col("back") == 1) & ~F.col("status").isin(TERMINAL)).drop("back")


def strategy_overview(ledger: DataFrame) -> DataFrame:
    """Closed trades are fills with a realised result."""
    t = ledger.where("side = 'sell'")
    return t.groupBy(*BOOK).agg(F.count(F.lit(1)).alias("trades"), F.sum("realized_pnl").alias("total_pnl"), F.avg("realized_pnl").alias("avg_pnl"), F.avg((F.col("realized_pnl") > 0).cast("double")).alias("win_rate"), F.max("ts").alias("last_trade"))


def total_pnl(ledger: DataFrame, by: str = "paper") -> DataFrame:
    """L09."""
    return ledger.groupBy(by).agg(F.sum("realized_pnl").alias("total_pnl"))


def with_peak(df: DataFrame, pnl: str, capital: float | None, by: list[str], order: tuple[str, ...] = ("exit_ts", "seq"), time: str = "exit_ts", number: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds equity (running result, on top of ``capital``), its peak so far (at least ``capital``) and, as ``number``, the place from 1; of ``df`` the columns ``keep`` (all) stay.

    One window over a group's month gives its running result and the largest so far, written once; a window over the months' ends, which are few, carries them on.
    """
    keep = keep or df.columns
    own = Window.partitionBy(*by, "month_").orderBy(*order)
    t = df.withColumn("month_", F.trunc(F.to_date(time), "month")).withColumn("sum_", F.sum(pnl).over(own))
    t = t.select(*keep, "month_", F.col(pnl).alias("own_"), "sum_", F.max("sum_").over(own).alias("top_"), *([F.row_number().over(own).alias("nth_")] if number else []))
    t = written(t, "months")
    earlier = Window.partitionBy(*by).orderBy("month_").rowsBetween(Window.unboundedPreceding, -1)
    ends = t.groupBy(*by, "month_").agg(F.sum("own_").alias("s"), F.max("top_").alias("m"), F.count(F.lit(1)).alias("n"))
    ends = ends.select(*by, "month_", F.sum("s").over(earlier).alias("start_"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_"), "m")
    ends = ends.select(*by, "month_", "start_", "before_", F.max(F.coalesce(F.col("start_") + F.col("m"), "start_", "m")).over(earlier).alias("high_"))
    t = t.join(written(ends, "ends"), [*by, "month_"], "left")
    on = F.lit(0.0 if capital is None else capital)
    equity, top = (on + F.coalesce(F.col("start_") + F.col(c), "start_", c) for c in ("sum_", "top_"))
    peak = F.greatest(on + F.col("high_"), top, *([] if capital is None else [on]))
    return t.select(*keep, *([(F.coalesce("before_", F.lit(0)) + F.col("nth_")).alias(number)] if number else []), equity.alias("equity"), peak.alias("peak"))


def _curve(ledger: DataFrame, capital: float | None, keep: list[str] | None) -> DataFrame:
    """``with_peak`` of the realised results of each book."""
    if "nth" in ledger.columns:
        return with_peak(ledger, "realized_pnl", capital, BOOK, ("nth",), "ts", keep=keep)
    return with_peak(ledger, "realized_pnl", capital, BOOK, FILL_ORDER, "ts", "nth", keep)


def equity_curve(ledger: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Cumulative pnl, its running maximum and the distance, by book. Fills in the order of nth; without that column they are numbered, and the columns ``keep`` (all) stay."""
    return _curve(ledger, None, keep).withColumn("drawdown", F.col("peak") - F.col("equity"))


def drawdown_pct(equity: DataFrame, by: list[str], order: list[str], time: str = "ts", peak: str | None = None) -> DataFrame:
    """(peak - value) / peak of portfolio values in the order of ``order``, along which ``time`` never falls; over a group's months, unless the column ``peak`` has the peaks."""
    if peak:
        return equity.withColumn("drawdown_pct", ratio(F.col(peak) - F.col("portfolio_value"), F.col(peak)))
    e = over_months(equity, tops={"before_": F.col("portfolio_value")}, by=by, order=tuple(order), time=time)
    top = F.greatest("before_", "portfolio_value")
    return e.withColumn("drawdown_pct", ratio(top - F.col("portfolio_value"), top)).drop("before_")


def strategy_metrics(ledger: DataFrame) -> DataFrame:
    """The overview with the largest drawdown of each book."""
    curve = equity_curve(ledger, [*BOOK, "ts", "side", "realized_pnl"])
    deepest = curve.groupBy(*BOOK).agg(F.max("drawdown").alias("max_drawdown"))
    out = deepest.join(strategy_overview(curve), BOOK, "left")
    return out.fillna(0, ["trades", "total_pnl", "avg_pnl", "win_rate"])


#: Maker and taker fee rates by exchange.
FEES = {"kucoin": (0.001, 0.001), "bybit": (-0.0001, 0.0006)}


def with_fees(fills: DataFrame, fees: dict[str, tuple[float, float]] = FEES) -> DataFrame:
    """Limit orders pay as makers, others as takers."""
    rate = F.lit(None).cast("double")
    for name, (maker, taker) in fees.items():
        rate = F.when(F.col("exchange") == name, F.when(F.col("limit_price").isNotNull(), maker).otherwise(taker)).otherwise(rate)
    return fills.withColumn("fee", F.col("price") * F.col("size") * rate)


def pair_trades(fills: DataFrame) -> DataFrame:
    """A sell closes the latest buy before it that no sell has closed yet; gross result on the smaller size, and net of both fees.

    That buy is the fill right before the sell. One window over a book's month tells each fill the one before it; sells after a buy are written, and the month's first and last fill,
    from which a window over a book's months, which are few, tells the first ones theirs.
    """
    months, row = Window.partitionBy("hash_", *BOOK, "month_"), F.struct("side", "ts", "price", "size", "fee")
    own = months.orderBy(*FILL_ORDER)
    t = fills.where("side is not null").select(*BOOK, *FILL_ORDER, "side", "price", "size", "fee", F.trunc(F.to_date("ts"), "month").alias("month_"))
    t = t.withColumn("hash_", F.xxhash64(*BOOK, "month_"))  # sorting compares it alone where two rows are of different months
    t = t.select("*", F.lag(row).over(own).alias("entry"), F.lead("side").over(own).isNull().alias("last_")).withColumn("first_", F.col("entry").isNull())
    t = written(t.where("(side = 'sell' and entry.side = 'buy') or first_ or last_"), "sells")
    edges = t.where("first_ or last_").drop("entry").select("*", F.lag(row).over(Window.partitionBy(*BOOK).orderBy("month_", F.desc("first_"))).alias("entry"))
    both = t.where("not first_").unionByName(written(edges.where("first_"), "edges")).where("side = 'sell' and entry.side = 'buy'")
    q = F.least("size", "entry.size")
    both = both.withColumn("gross_pnl", (F.col("price") - F.col("entry.price")) * q)
    return both.select(*BOOK, F.col("entry.ts").alias("entry_ts"), F.col("ts").alias("exit_ts"), F.col("entry.price").alias("entry_price"), F.col("price").alias("exit_price"), q.alias("size"), "gross_pnl", (F.col("gross_pnl") - F.col("fee") - F.col("entry.fee")).alias("net_pnl"), "seq")


#: A run's summary over a stretch of trades: its length at the head and at the end, the longest one, and whether it covers all. Two stretches in a row compose.
_RUN = "struct<first:bigint,last:bigint,longest:bigint,whole:boolean>"


def _no_run() -> Column:
    zero = F.lit(0).cast("long")
    return F.struct(zero.alias("first"), zero.alias("last"), zero.alias("longest"), F.lit(True).alias("whole"))


def _run_step(r: Column, hit: Column) -> Column:
    last = F.when(hit, r["last"] + 1).otherwise(0)
    return F.struct(F.when(r["whole"] & hit, r["first"] + 1).otherwise(r["first"]).alias("first"), last.alias("last"), F.greatest(r["longest"], last).alias("longest"), (r["whole"] & hit).alias("whole")).cast(_RUN)


def _run_join(a: Column, b: Column) -> Column:
    first = F.when(a["whole"], a["first"] + b["first"]).otherwise(a["first"])
    last = F.when(b["whole"], a["last"] + b["last"]).otherwise(b["last"])
    return F.struct(first.alias("first"), last.alias("last"), F.greatest(a["longest"], b["longest"], a["last"] + b["first"]).alias("longest"), (a["whole"] & b["whole"]).alias("whole")).cast(_RUN)


def _month_arrays(trades: DataFrame, by: list[str], pnl: str, order: tuple[str, ...]) -> DataFrame:
    """Each group's months, written once: the month's results in order (p_) and a number (id_)."""
    t = trades.select(*by, F.trunc(F.to_date(order[0]), "month").alias("month_"), F.struct(*order, F.col(pnl).cast("double").alias("p_")).alias("row_"))
    t = t.groupBy(*by, "month_").agg(F.transform(F.array_sort(F.collect_list("row_")), lambda r: r["p_"]).alias("p_"))
    return written(t.select("*", F.monotonically_increasing_id().alias("id_")), "months")


def _starts(months: DataFrame, by: list[str], key: list[str], capital: float) -> DataFrame:
    """Equity and peak at the start of each month of a group, by ``key``. They are written, so that a join with the months knows them to be few and leaves the months spread as they are."""
    zero = F.lit(0.0)

    def step(a: Column, p: Column) -> Column:
        total = a["sum"] + F.coalesce(p, zero)
        return F.struct(total.alias("sum"), F.greatest(a["top"], total).alias("top"))

    reach = months.select(*by, *[c for c in key if c not in by], "month_", F.aggregate("p_", F.struct(zero.alias("sum"), zero.alias("top")), step).alias("r"))
    earlier = Window.partitionBy(*by).orderBy(F.col("month_").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(reach, "reach").withColumn("start", capital + F.coalesce(F.sum("r.sum").over(earlier), zero))
    return written(starts.select(*key, "start", F.greatest(F.max(F.col("start") + F.col("r.top")).over(earlier), F.lit(capital)).alias("peak")), "starts")


def path_summary(trades: DataFrame, capital: float, by: list[str], pnl: str = "net_pnl", order: tuple[str, ...] = ("exit_ts", "seq")) -> DataFrame:
    """One row per group: max_drawdown and max_drawdown_pct of the equity on top of ``capital``, max_drawdown_trades (the longest stretch of trades below the peak), win_streak and loss_streak.

    A group's month is a sorted array, read twice: its sum and largest prefix tell every month's equity and peak at its start by a window over the group's months, and a fold from there gives
    its drawdowns and, as composable summaries, its runs, which a fold over the months joins. Order is by ``order``, of which the first is a time.
    """
    months = _month_arrays(trades, by, pnl, order)
    starts = _starts(months, by, ["id_"], capital)
    zero = F.lit(0.0)

    def step(a: Column, p: Column) -> Column:
        equity = a["equity"] + F.coalesce(p, zero)
        peak = F.greatest(a["peak"], equity)
        return F.struct(equity.alias("equity"), peak.alias("peak"), F.greatest(a["depth"], peak - equity).alias("depth"), F.greatest(a["share"], (peak - equity) / peak * 100).alias("share"), _run_step(a["under"], equity < peak).alias("under"), _run_step(a["wins"], p > 0).alias("wins"), _run_step(a["losses"], ~(p > 0)).alias("losses"))

    begin = F.struct(F.col("start").alias("equity"), F.col("peak").alias("peak"), zero.alias("depth"), zero.alias("share"), *[_no_run().alias(n) for n in ("under", "wins", "losses")])
    folded = months.join(starts, "id_").select(*by, "month_", F.aggregate("p_", begin, step).alias("f"))
    runs = F.struct(*[_no_run().alias(n) for n in ("under", "wins", "losses")])
    whole = F.aggregate(F.array_sort(F.collect_list(F.struct(F.col("month_").isNull().alias("none_"), "month_", "f.under", "f.wins", "f.losses"))), runs, lambda a, m: F.struct(*[_run_join(a[n], m[n]).alias(n) for n in ("under", "wins", "losses")]))
    out = folded.groupBy(*by).agg(F.max("f.depth").alias("max_drawdown"), F.max("f.share").alias("max_drawdown_pct"), whole.alias("r"))  # a row for each month of a group
    return out.select(*by, "max_drawdown", "max_drawdown_pct", F.col("r.under.longest").alias("max_drawdown_trades"), F.col("r.wins.longest").alias("win_streak"), F.col("r.losses.longest").alias("loss_streak"))


def run_metrics(trades: DataFrame, capital: float, by: list[str] | None = None, tf: str = "1d") -> DataFrame:
    """L13, one row per run (book): return, Sharpe and SQN of trade results, drawdown with its duration in trades, win rate, profit factor, averages, extremes, streaks, mean duration in seconds and bars of ``tf``, long and short trades, fee gate (fees < 1 % of capital).

    Trades are long unless a column ``direction`` says ``short``.
    """
    by = by or BOOK
    std, win, loss = F.stddev_samp("net_pnl"), F.col("net_pnl") > 0, F.col("net_pnl") < 0
    short = F.coalesce(F.col("direction") == "short", F.lit(False)) if "direction" in trades.columns else F.lit(False)
    opened, closed = (F.floor(F.unix_seconds(c) / seconds(tf)) for c in ("entry_ts", "exit_ts"))
    out = trades.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_trades"), (F.sum("net_pnl") / capital * 100).alias("return_pct"), F.when(std > 0, F.avg("net_pnl") / std).alias("sharpe"), F.when(std > 0, F.sqrt(F.count(F.lit(1))) * F.avg("net_pnl") / std).alias("sqn"),
        F.avg(win.cast("double")).alias("win_rate"), ratio(F.sum(F.when(win, F.col("net_pnl")).otherwise(0.0)), -F.sum(F.when(loss, F.col("net_pnl")).otherwise(0.0))).alias("profit_factor"),
        F.avg("net_pnl").alias("avg_trade"), F.coalesce(F.avg(F.when(win, F.col("net_pnl"))), F.lit(0.0)).alias("avg_win"), F.coalesce(F.avg(F.when(loss, F.col("net_pnl"))), F.lit(0.0)).alias("avg_loss"), F.max("net_pnl").alias("best_trade"), F.min("net_pnl").alias("worst_trade"),
        F.avg(F.unix_seconds("exit_ts") - F.unix_seconds("entry_ts")).alias("avg_seconds"), F.avg(closed - opened).alias("avg_bars"), F.count_if(~short).alias("n_long"), F.count_if(short).alias("n_short"), (F.sum(F.col("gross_pnl") - F.col("net_pnl")) < 0.01 * capital).alias("passes_fee_gate"),
    )
    return out.join(path_summary(trades, capital, by), by)


def trade_table(trades: DataFrame) -> DataFrame:
    """Running net result and duration."""
    t = over_months(trades, sums={"running_pnl": F.col("net_pnl")}, by=BOOK, order=("exit_ts", "seq"), time="exit_ts")
    return t.select(*BOOK, "entry_ts", "exit_ts", "net_pnl", "running_pnl", (F.unix_seconds("exit_ts") - F.unix_seconds("entry_ts")).alias("seconds_held"))


def sample_equity(equity: DataFrame, k: int, by: list[str], order: list[str]) -> DataFrame:
    """Every k-th point; the order ``nth`` is a place already."""
    return (equity if order == ["nth"] else in_place(equity, by, order)).where(F.col("nth") % k == 0)


def in_place(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds nth (from 1) in each group: over its months if it has a key and the order begins with a time, else over ranges of all rows, so that no task holds a group."""
    if by and dict(df.dtypes)[order[0]] in ("timestamp", "timestamp_ntz", "date"):
        return over_months(df, sums={"nth": F.lit(1).cast("long")}, by=by, order=tuple(order), ties=False, time=order[0], stored=True)
    return in_ranks(df, by, order).withColumn("nth", F.col("nth_") + 1).drop("nth_", "n_")


def with_size(df: DataFrame, by: list[str]) -> DataFrame:
    """Adds n, the rows of each group."""
    size = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return df.join(size, by) if by else df.join(F.broadcast(size))  # one row


def walk_forward_folds(df: DataFrame, k: int, by: list[str], order: list[str]) -> DataFrame:
    """Expanding folds: fold i trains on the first i * size rows and tests on the next ``size``; size = n // (k + 1). Adds fold and part; a row is in several folds."""
    x = with_size(in_place(df, by, order), by)
    x = x.withColumn("size", F.floor(F.col("n") / (k + 1))).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
    part = F.when(F.col("nth") <= F.col("fold") * F.col("size"), "in").when(F.col("nth") <= (F.col("fold") + 1) * F.col("size"), "out")
    return x.withColumn("part", part).where("part is not null").drop("n", "size")


def purged_folds(df: DataFrame, k: int, gap: int, by: list[str], order: list[str]) -> DataFrame:
    """As above with a gap between training and test; folds whose test would pass the end are left out."""
    x = with_size(in_place(df, by, order).withColumn("nth", F.col("nth") - 1), by)
    x = x.withColumn("size", F.floor(F.col("n") / (k + 1))).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
    end = F.col("fold") * F.col("size")
    x = x.where(end + gap + F.col("size") <= F.col("n"))
    part = F.when(F.col("nth") < end, "train").when((F.col("nth") >= end + gap) & (F.col("nth") < end + gap + F.col("size")), "test")
    return x.withColumn("part", part).where("part is not null").drop("n", "size")


def walk_forward_report(trades: DataFrame, k: int, pnl: str, by: list[str], capital: float = 100_000.0, order: tuple[str, ...] = ("exit_ts", "seq")) -> DataFrame:
    """L16 by fold of ``walk_forward_folds``: Sharpe inside and outside, degradation of it, results inside and outside, pnl_degradation 1 - out / in (0 where in is 0), and the drawdown of the test part on top of ``capital`` as a share of its peak.

    A fold's test part is the segment of ``size`` rows that bears its number, its training part the segments before it, from 0. A group's months are arrays, so counts of months tell how segments cut them, and a row is sorted once, not once a fold.
    """
    months = _month_arrays(trades, by, pnl, order)
    group = Window.partitionBy(*by)
    earlier = group.orderBy(F.col("month_").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    counts = months.select(*by, "month_", "id_", F.size("p_").cast("long").alias("n_"))
    places = counts.select("id_", "n_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("before_"), F.floor(F.sum("n_").over(group) / (k + 1)).alias("size_"))
    cut = months.join(written(places.where("size_ > 0"), "places"), "id_")
    ends = [F.floor(c / F.col("size_")) for c in (F.col("before_"), F.col("before_") + F.col("n_") - 1)]
    cut = cut.where(ends[0] <= k).withColumn("segment_", F.explode(F.sequence(ends[0], F.least(ends[1], F.lit(k)))))
    low, high = (F.greatest(F.least((F.col("segment_") + i) * F.col("size_"), F.col("before_") + F.col("n_")), "before_") for i in (0, 1))
    cut = cut.select(*by, "month_", "id_", "segment_", F.slice("p_", (low - F.col("before_") + 1).cast("int"), (high - low).cast("int")).alias("p_"))
    starts = _starts(cut, [*by, "segment_"], ["id_", "segment_"], capital)

    def step(a: Column, p: Column) -> Column:
        equity = a["equity"] + F.coalesce(p, F.lit(0.0))
        peak = F.greatest(a["peak"], equity)
        return F.struct(equity.alias("equity"), peak.alias("peak"), F.greatest(a["share"], (peak - equity) / peak).alias("share"))

    share = F.aggregate("p_", F.struct(F.col("start").alias("equity"), F.col("peak").alias("peak"), F.lit(0.0).alias("share")), step)["share"]
    rows = cut.join(starts, ["id_", "segment_"]).select(*by, "segment_", share.alias("share_"), "p_")
    rows = rows.withColumn("fold", F.explode(F.sequence(F.greatest("segment_", F.lit(1)), F.lit(k)))).select(*by, "fold", "segment_", "share_", F.explode("p_").alias("p_"))

    def of(part: str, c: str = "p_") -> Column:
        return F.when(F.col("segment_") == F.col("fold") if part == "out" else F.col("segment_") < F.col("fold"), F.col(c))

    def sharpe(part: str) -> Column:
        return F.coalesce(F.when(F.stddev_samp(of(part)) > 0, F.avg(of(part)) / F.stddev_samp(of(part))), F.lit(0.0))

    f = rows.groupBy(*by, "fold").agg(sharpe("in").alias("is_sharpe"), sharpe("out").alias("oos_sharpe"), F.coalesce(F.sum(of("in")), F.lit(0.0)).alias("is_pnl"), F.coalesce(F.sum(of("out")), F.lit(0.0)).alias("oos_pnl"), F.coalesce(F.max(of("out", "share_")), F.lit(0.0)).alias("oos_drawdown"))
    lost = [F.when(F.col(a) == 0, 0.0).otherwise(1 - F.col(b) / F.col(a)) for a, b in (("is_sharpe", "oos_sharpe"), ("is_pnl", "oos_pnl"))]
    return f.withColumn("degradation", lost[0]).withColumn("pnl_degradation", lost[1])


def walk_forward_means(report: DataFrame, by: list[str]) -> DataFrame:
    """L16 over folds: mean Sharpe, drawdown and degradation of results of the test parts."""
    return report.groupBy(*by).agg(F.count(F.lit(1)).alias("folds"), F.avg("oos_sharpe").alias("mean_sharpe"), F.avg("oos_drawdown").alias("mean_drawdown"), F.avg("pnl_degradation").alias("mean_degradation"))


def stress_report(trades: DataFrame, windows: DataFrame, capital: float, by: list[str] | None = None) -> DataFrame:
    """Trades, result and drawdown in each (name, first_day, last_day), days inclusive; zeros for an empty window. Of all trades, or of each group ``by``. The list of windows is short and configured."""
    by = by or []
    day = F.to_date("exit_ts")
    j = trades.join(F.broadcast(windows), (day >= F.col("first_day")) & (day <= F.col("last_day")))
    j = with_peak(j, "net_pnl", capital, [*by, "name"], ("exit_ts", "seq", *BOOK)).withColumn("dd", (F.col("peak") - F.col("equity")) / F.col("peak"))
    s = j.groupBy(*by, "name").agg(F.count(F.lit(1)).alias("n_trades"), F.sum("net_pnl").alias("net_pnl"), F.max("dd").alias("max_drawdown"))
    every = windows.select("name")
    if by:
        every = trades.select(*by).distinct().join(F.broadcast(every))
    return every.join(s, [*by, "name"], "left").fillna(0, ["n_trades", "net_pnl", "max_drawdown"])


#: Trades of a book that one worker of the bootstrap holds.
BLOCK = 8192
#: Draws that it holds at a time.
SLAB = 1_000_000


def monte_carlo_p5(pnls: DataFrame, paths: int = 10_000, seed: int = 7, pnl: str = "net_pnl", by: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """L18, one row per book: bootstrap of its trade results: ``paths`` sums of n draws with replacement from its n trades, 5th percentile (linear).

    A book's trades lie in blocks of at most ``block``. How many of a path's n draws fall into a block follows from the seed, so the workers of a
    book's blocks agree on it without a word; each draws from its own trades, and the partial sums are added by path.
    """
    by = by or BOOK
    numbered = _numbered(pnls.select(*by, F.col(pnl).cast("double").alias("pnl")), by)
    blocks = numbered.withColumn("block", F.floor(F.col("pos") / block).cast("int"))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.select(*by).schema)
    parts = int(pnls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(parts, *by, "block")  # by number: blocks are few bytes and much work, so they are not to be put together by size
    drawn = blocks.groupBy(*by, "block").applyInPandas(_bootstrap(by, paths, seed, block), f"{shape}, n long, path int, part double")
    totals = drawn.groupBy(*by, "n", "path").agg(F.sum("part").alias("total"))
    return totals.groupBy(*by, F.col("n").alias("trades")).agg(F.percentile("total", 0.05).alias("p5"))


def _bootstrap(by: list[str], paths: int, seed: int, block: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        n, nth, book = int(first["n"]), int(first["block"]), zlib.crc32("|".join(str(first[c]) for c in by).encode())
        values = rows.sort_values("pos")["pnl"].to_numpy()
        counts = draws_in_block(seed, book, n, nth, block, paths)
        rng, out, at = np.random.default_rng([seed, book, nth]), np.zeros(paths), 0
        ends = np.cumsum(counts)
        while at < paths:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLAB, "right")))
            out[at:to] = _sums(values, counts[at:to], rng)
            at = to
        return pd.DataFrame({**{c: first[c] for c in by}, "n": n, "path": np.arange(paths, dtype=np.int32), "part": out})

    return run


def draws_in_block(seed: int, book: int, n: int, nth: int, block: int, paths: int) -> np.ndarray:
    """How many of the n draws of each path fall into block ``nth`` of a book: a multinomial count by binomial halving, each half from its own seed, so that the counts of a book's blocks add up to n."""
    low, high, counts = 0, -(-n // block), np.full(paths, n)
    while high - low > 1:
        middle = (low + high) // 2
        share = (middle - low) * block / (min(high * block, n) - low * block)
        left = np.random.default_rng([seed, book, low, high]).binomial(counts, share)
        low, high, counts = (low, middle, left) if nth < middle else (middle, high, counts - left)
    return counts


def _sums(values: np.ndarray, counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Sums of ``counts[i]`` draws with replacement."""
    drawn = values[rng.integers(0, len(values), int(counts.sum()), dtype=np.int32)]
    starts = np.cumsum(counts) - counts
    return np.where(counts > 0, np.add.reduceat(np.append(drawn, 0.0), starts), 0.0)


def _numbered(values: DataFrame, by: list[str]) -> DataFrame:
    """Positions 0, 1, ... by value in each book and the book's size n, from counts of value cells and a row number inside each."""
    v = values.withColumn("cell", F.pmod(F.xxhash64("pnl"), F.lit(256)))
    w = Window.partitionBy(*by)
    starts = v.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("m"))
    starts = starts.select(*by, "cell", (F.sum("m").over(w.orderBy("cell")) - F.col("m")).alias("start"), F.sum("m").over(w).alias("n"))  # at most 256 rows of a book
    inside = F.row_number().over(Window.partitionBy(*by, "cell").orderBy("pnl")) - 1
    return v.withColumn("nth", inside).join(starts, [*by, "cell"]).select(*by, "n", (F.col("start") + F.col("nth")).alias("pos"), "pnl")


def fee_impact(trades: DataFrame, taker: float, bps: float) -> DataFrame:
    """Does the mean edge of trades (gross result over entry value) exceed twice the costs?"""
    cost = max(0.0, 2 * (taker + bps / 10_000))
    t = trades.groupBy(*BOOK).agg(F.avg(F.col("gross_pnl") / (F.col("entry_price") * F.col("size"))).alias("mean_edge"))
    return t.withColumn("cost", F.lit(cost)).withColumn("passes", F.col("mean_edge") > cost)


def validation_verdict(reports: DataFrame) -> DataFrame:
    """L20, from one row per run with sharpe, max_drawdown, degradation, p5, worst_stress, passes_fee_gate; a failed fee gate decides alone."""
    rules = [("sharpe", F.col("sharpe") >= 1), ("drawdown", F.col("max_drawdown") <= 0.15), ("degradation", F.col("degradation") <= 0.30), ("monte_carlo", F.col("p5") > 0), ("stress", F.col("worst_stress") <= 0.30)]
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]))
    failures = F.when(~F.col("passes_fee_gate"), F.array(F.lit("fee_gate"))).otherwise(failed)
    return reports.withColumn("failures", F.array_join(failures, ",")).withColumn("passed", F.size(failures) == 0)


def validation_inputs(trades: DataFrame, windows: DataFrame, capital: float, folds: int = 4, paths: int = 10_000, seed: int = 7) -> DataFrame:
    """What L20 judges, one row per book: mean Sharpe, drawdown and degradation of its test folds (L16), its worst stress window (L17), its bootstrap percentile (L18) and its fee gate (L13). A book too small to fold has no fold means."""
    means = walk_forward_means(walk_forward_report(trades, folds, "net_pnl", BOOK, capital), BOOK).select(*BOOK, F.col("mean_sharpe").alias("sharpe"), F.col("mean_degradation").alias("degradation"), F.col("mean_drawdown").alias("max_drawdown"))
    stress = stress_report(trades, windows, capital, BOOK).groupBy(*BOOK).agg(F.max("max_drawdown").alias("worst_stress"))
    p5 = monte_carlo_p5(trades, paths, seed).select(*BOOK, "p5")
    gate = run_metrics(trades, capital).select(*BOOK, "passes_fee_gate")
    return reduce(lambda a, b: a.join(b, BOOK, "left"), [gate, means, stress, p5])


def strategy_ema_flip(bars: DataFrame, fast: int = 9, slow: int = 21) -> DataFrame:
    """Long while the fast mean is above the slow one: entries and exits of the flip strategy."""
    from tidemark.operators.rolling import ema_cross

    c = ema_cross(bars, fast, slow).where("action <> 'hold'")
    c = over_months(c, priors={"prior": F.col("action")}, order=("ts",)).where("(action = 'buy' and coalesce(prior, 'sell') = 'sell') or (action = 'sell' and prior = 'buy')")
    return c.select(*KEY, "ts", "close", F.when(F.col("action") == "buy", "enter").otherwise("exit").alias("order"))


def strategy_hold_k(bars: DataFrame, k: int) -> DataFrame:
    """Enter on a rising bar when flat and hold ``k`` bars. Whether a bar enters depends on the last entry: a block of bars turns the number of bars
    still held at its start (0 to k - 1) into that at its end, these tables fold over a key's blocks, and then each block enters by its own."""
    t = in_chunks(bars.where("close is not null")).select(*KEY, F.col("nth_").alias("nth"), "block_", "ts", "close", (F.col("close") > F.col("open")).alias("up"))
    b = t.drop("block_", "up")
    shape = "exchange string, symbol string, block_ long"
    waits = t.groupBy(*KEY, "block_").applyInPandas(_waits(k), f"{shape}, waits array<int>")
    heads = waits.groupBy(*KEY).applyInPandas(_first_waits, f"{shape}, wait int")
    entries = t.join(heads, [*KEY, "block_"]).groupBy(*KEY, "block_").applyInPandas(_entries(k), "exchange string, symbol string, nth long")
    ins = entries.join(b, [*KEY, "nth"]).select(*KEY, "nth", F.col("ts").alias("entry_ts"), F.col("close").alias("entry_price"))
    outs = b.select(*KEY, (F.col("nth") - k).alias("nth"), F.col("ts").alias("exit_ts"), F.col("close").alias("exit_price"))
    return ins.join(outs, [*KEY, "nth"], "left").drop("nth")


def _taken(up: np.ndarray, wait: int, k: int) -> tuple[list[int], int]:
    """Places of the bars that enter when the first ``wait`` bars are held through, and how many bars of the next block the last entry still holds."""
    out, free = [], wait
    for i in np.flatnonzero(up):
        if i >= free:
            out.append(int(i))
            free = int(i) + k
    return out, max(free - len(up), 0)


def _waits(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        up = rows.sort_values("nth")["up"].fillna(False).to_numpy(bool)
        return pd.DataFrame([(*[rows[c].iloc[0] for c in (*KEY, "block_")], [_taken(up, wait, k)[1] for wait in range(k)])])

    return run


def _first_waits(rows: pd.DataFrame) -> pd.DataFrame:
    rows, at, wait = rows.sort_values("block_"), [], 0
    for waits in rows["waits"]:
        at.append(wait)
        wait = int(waits[wait])
    return rows[[*KEY, "block_"]].assign(wait=at)


def _entries(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("nth")
        taken, _ = _taken(rows["up"].fillna(False).to_numpy(bool), int(rows["wait"].iloc[0]), k)
        return rows.iloc[taken][[*KEY, "nth"]]

    return run


def order_event_rows(df: DataFrame) -> DataFrame:
    """Ledger rows of order events, times in microseconds."""
    return df.select("order_id", *BOOK, "side", "status", F.unix_micros("ts").alias("ts_us"), F.col("size").alias("requested_size"), F.when(F.col("status") == "filled", F.col("size")).otherwise(0.0).alias("filled_size"), F.when(F.col("status") == "filled", F.col("price")).alias("avg_fill_price"), "limit_price", F.col("paper").alias("paper_trading"))


def empty_metrics(spark: SparkSession) -> DataFrame:
    """L10 of no fills: zeros."""
    return spark.createDataFrame([(0, 0.0, 0.0, 0.0, 0.0)], "trades long, total_pnl double, avg_pnl double, win_rate double, max_drawdown double")
