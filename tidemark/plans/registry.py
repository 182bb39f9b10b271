"""Registered queries: each has a column list that shapes both the Spark result and its SQL.

A column is ``name:kind``: s text, i whole number, d number to six places, e to four, b boolean, t time, D date.
Before rounding a number is nudged up by less than a tenth of its last place, so that both engines round a tie alike; the nudge has more
places than the data, so that it makes no ties itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import book, footprint, ledger
from tidemark.sources import adapter, io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The SQL of each query before its columns are shaped, for queries that join the answers of others.
RAW: dict[str, str] = {}

#: What the SQL side calls the engine's tables; a query gets those that its text names.
SQL = {
    "ticks": """select case when user_id % 2 = 0 then 'kucoin' else 'bybit' end as exchange, 'S' || ((user_id // 2) % 2) as symbol, event_id as seq, ts, gap, snap, k,
        case when gap then 'gap' when snap then 'snapshot' else 'tick' end as msg_type, case when snap then 'snapshot' when trade then 'trade' when not gap then 'update' end as event_type,
        case when not gap and not snap then case when event_id % 2 = 0 then 'buy' else 'sell' end end as side,
        case when not gap and not snap then (case when trade then round(value / 5) * 5 + 100 when event_id % 2 = 0 then 100 - k % 10 else 101 + k % 10 end)::double end as price, case when not gap and not snap then k::double end as size,
        case when gap then event_id - 1 - k end as seq_before, case when gap then event_id end as seq_after, case when gap then case k % 3 when 0 then 'internal_merge_error' when 1 then 'sequence_gap' else 'stream_disconnect' end end as gap_cause
        from (select *, regexp_extract(props, '[0-9]+')::bigint as k, event_type = 'error' and event_id % 10 = 0 as gap, event_type = 'error' and event_id % 10 = 5 as snap, event_type in ('purchase', 'click', 'view') as trade from events)""",
    "trades": "select *, time_bucket(interval '4 hours', ts) as bar, price::bigint::varchar as price_str from ticks where event_type = 'trade' and size > 0",
    "updates": "select *, price::bigint::varchar as price_str from ticks where event_type = 'update'",
    "gaps": "select exchange, symbol, seq, ts, seq_before, seq_after, gap_cause from ticks where gap",
    "epochs": """select *, sum(case when gap or snap then 1 else 0 end) over w as epoch, sum(case when snap then 1 else 0 end) over w as acc_epoch from ticks window w as (partition by exchange, symbol order by ts, seq)""",
    "epoch_ends": "select exchange, symbol, epoch, lead(o) over (partition by exchange, symbol order by epoch) as c from (select exchange, symbol, epoch, min(seq) as o from epochs group by all)",
    "levels": """select exchange, symbol, epoch, side, price, size, ts as valid_from, seq as from_seq, coalesce(nxt, c) as to_seq from
        (select *, lead(seq) over (partition by exchange, symbol, epoch, side, price order by ts, seq) as nxt from epochs where event_type = 'update') join epoch_ends using (exchange, symbol, epoch) where size > 0""",
    "kinds": """select *, time_bucket(interval '4 hours', ts) as bar, case when size = 0 then 'cancel' when coalesce(lag(size) over (partition by exchange, symbol, epoch, side, price order by ts, seq), 0) > 0 then 'modify' else 'add' end as kind
        from epochs where event_type = 'update'""",
    "quotes": """select exchange, symbol, epoch, acc_epoch, ts, seq, case when a is not null then b.p end as bid, case when a is not null then b.z end as bid_size, case when b is not null then a.p end as ask, case when b is not null then a.z end as ask_size,
        (b.p + a.p) / 2 as mid, time_bucket(interval '4 hours', ts) as bar from (select t.exchange, t.symbol, t.epoch, any_value(t.acc_epoch) as acc_epoch, any_value(t.ts) as ts, t.seq,
        max({'p': l.price, 'z': l.size}) filter (where l.side = 'buy') as b, min({'p': l.price, 'z': l.size}) filter (where l.side = 'sell') as a
        from epochs t left join levels l on t.exchange = l.exchange and t.symbol = l.symbol and t.epoch = l.epoch and l.from_seq <= t.seq and (l.to_seq is null or t.seq < l.to_seq) group by t.exchange, t.symbol, t.epoch, t.seq)""",
    "bars4": """select exchange, symbol, bar as ts, arg_min(price, seq) as open, max(price) as high, min(price) as low, arg_max(price, seq) as close, sum(size) as volume, sum(price * size) as quote_volume, count(*) as trade_count,
        sum(case when side = 'buy' then size else 0 end) as buy_volume, sum(case when side = 'sell' then size else 0 end) as sell_volume from trades group by all""",
    "all1": """select exchange, symbol, time_bucket(interval '1 hour', ts) as ts, arg_min(price, seq) filter (where event_type = 'trade' and size > 0) as open, max(price) filter (where event_type = 'trade' and size > 0) as high,
        min(price) filter (where event_type = 'trade' and size > 0) as low, arg_max(price, seq) filter (where event_type = 'trade' and size > 0) as close, sum(size) filter (where event_type = 'trade' and size > 0) as volume,
        count(*) filter (where event_type = 'trade' and size > 0) as n_trades, sum(case when event_type = 'trade' and side = 'buy' then size when event_type = 'trade' and side = 'sell' then 0 end) filter (where size > 0) as buy_volume,
        sum(case when event_type = 'trade' and side = 'sell' then size when event_type = 'trade' and side = 'buy' then 0 end) filter (where size > 0) as sell_volume, count(*) filter (where gap) as gap_count, bool_or(snap) as is_partial from ticks group by all""",
    "bars1": "select * exclude (n_trades), case when n_trades > 0 then n_trades end as trade_count from all1",
    "q1": """select exchange, symbol, time_bucket(interval '1 hour', ts) as ts, arg_max(bid, seq) as best_bid, arg_max(ask, seq) as best_ask, avg(ask - bid) as spread_mean from quotes where mid is not null group by all""",
    "flow": """select *, case when mid is null or b0 is null or a0 is null then 0 else (case when bid = b0 then bid_size - bz0 when bid > b0 then bid_size else 0 end) - (case when ask = a0 then ask_size - az0 when ask < a0 then ask_size else 0 end) end as f
        from (select *, lag(bid) over w as b0, lag(ask) over w as a0, lag(bid_size) over w as bz0, lag(ask_size) over w as az0 from quotes window w as (partition by exchange, symbol, epoch order by ts, seq))""",
    "f1": "select exchange, symbol, time_bucket(interval '1 hour', ts) as ts, sum(f) as ofi_l1 from flow group by all",
    "feat": "select * from bars1 left join q1 using (exchange, symbol, ts) left join f1 using (exchange, symbol, ts)",
    "fp": "select exchange, symbol, bar as ts, price, price_str, sum(case when side = 'buy' then size else 0 end) as b, sum(case when side = 'sell' then size else 0 end) as s from trades group by all",
    "grid": "select exchange, symbol, ts, side, price, size from depth_grid",
    "depth_grid": """select l.exchange, l.symbol, g.ts, side, price, size from (select l.*, e.ts as valid_to, max(greatest(l.valid_from, coalesce(e.ts, l.valid_from))) over (partition by l.exchange, l.symbol) as last
        from levels l left join ticks e on l.to_seq = e.seq) l join (select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-02-05', interval '4 hours')) as ts) g
        on g.ts >= l.valid_from and (g.ts < l.valid_to or (l.valid_to is null and g.ts <= l.last))""",
    "fills": """select l_shipdate as ts, 'o' || l_orderkey || '-' || l_linenumber as order_id, o_orderpriority as strategy, case when l_suppkey % 2 = 0 then 'kucoin' else 'bybit' end as exchange, 'P' || (l_partkey % 20) as symbol,
        case when l_linenumber % 2 = 1 then 'buy' else 'sell' end as side, case l_returnflag when 'R' then 'rejected' when 'A' then 'placed' else 'filled' end as status, l_extendedprice / l_quantity as price, l_quantity as size,
        case when l_linenumber % 3 = 0 then l_extendedprice / l_quantity * (1 - l_discount / 10) end as limit_price, l_linestatus = 'O' as paper,
        struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_suppkey, e := l_quantity, f := l_extendedprice) as seq from lineitem join orders on l_orderkey = o_orderkey""",
    "ledger": """select *, case when side = 'sell' then (price - 1500) * size / 100 else 0 end as realized_pnl, row_number() over (partition by strategy, exchange, symbol order by ts, seq) as nth from fills""",
    "fees": """select *, price * size * case exchange when 'kucoin' then 0.001 else case when limit_price is not null then -0.0001 else 0.0006 end end as fee from fills""",
    "paired": """select strategy, exchange, symbol, entry.ts as entry_ts, ts as exit_ts, entry.price as entry_price, price as exit_price, least(size, entry.size) as size, (price - entry.price) * least(size, entry.size) as gross_pnl,
        (price - entry.price) * least(size, entry.size) - fee - entry.fee as net_pnl, seq from (select *, lag(side) over w as side0, last_value(case when side = 'buy' then {'ts': ts, 'price': price, 'size': size, 'fee': fee} end ignore nulls) over (w rows between unbounded preceding and 1 preceding) as entry
        from fees window w as (partition by strategy, exchange, symbol order by ts, seq)) where side = 'sell' and side0 = 'buy'""",
}


def _needed(text: str) -> list[str]:
    """The tables that ``text`` names, each after those that it needs itself."""
    out: list[str] = []

    def visit(t: str) -> None:
        for name, body in SQL.items():
            if name not in out and re.search(rf"\b(from|join)\s+{name}\b", t):
                visit(body)
                if name not in out:
                    out.append(name)

    visit(text)
    return out


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(x.rsplit(":", 1)) for x in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _columns(spec):
        c = F.col(name)
        out.append({"s": lambda c=c: c.cast("string"), "i": lambda c=c: c.cast("bigint"), "d": lambda c=c: F.round(c.cast("double") + 3.137e-8, 6), "e": lambda c=c: F.round(c.cast("double") + 3.137e-6, 4), "b": lambda c=c: c.cast("boolean"), "t": lambda c=c: c.cast("timestamp_ntz"), "D": lambda c=c: c.cast("date")}[kind]().alias(name))
    return df.select(*out)


def oracle(spec: str, sql: str) -> str:
    kinds = {"s": "{}::varchar", "i": "{}::bigint", "d": "round({}::double + 3.137e-8, 6)", "e": "round({}::double + 3.137e-6, 4)", "b": "{}::boolean", "t": "{}::timestamp", "D": "{}::date"}
    columns = ", ".join(f'{kinds[k].format(chr(34) + n + chr(34))} as "{n}"' for n, k in _columns(spec))
    names = _needed(sql)
    ctes = ",\n".join([*(f"{n} as ({SQL[n]})" for n in names), f"answer as ({sql})"])
    return f"with {ctes}\nselect {columns} from answer"


def register(name: str, spec: str, fn: Callable[[Data], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(name)
    QUERIES[name] = lambda spark, sf_dir: shaped(fn(Data(spark, sf_dir)), spec)
    if sql is not None:
        RAW[name], ORACLES[name] = sql, oracle(spec, sql)


class Data:
    """The engine's tables over one data folder, built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def ticks(self) -> DataFrame:
        return adapter.ticks(self.spark, self.sf_dir)

    def with_epochs(self) -> Data:
        """The same tables over ticks that are written once with their epochs, and levels that are written once, for queries of many parts."""
        out = type(self)(self.spark, self.sf_dir)
        out.ticks = self.stored(book.epochs(self.ticks), "ticks")
        out.trades = adapter.trades(out.ticks.drop(*book.EPOCHS))
        out.levels = self.stored(book.level_intervals(out.ticks), "levels")
        return out

    @cached_property
    def trades(self) -> DataFrame:
        return adapter.trades(self.ticks)

    @cached_property
    def updates(self) -> DataFrame:
        return adapter.updates(self.ticks)

    @cached_property
    def gaps(self) -> DataFrame:
        return adapter.gaps(self.ticks)

    @cached_property
    def fills(self) -> DataFrame:
        return adapter.fills(self.spark, self.sf_dir)

    @cached_property
    def results(self) -> DataFrame:
        """The ledger without its numbers, for queries that number rows and run over them in one pass."""
        return self.fills.withColumn("realized_pnl", F.when(F.col("side") == "sell", (F.col("price") - 1500) * F.col("size") / 100).otherwise(0.0))

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger.over_months(self.results, sums={"nth": F.lit(1).cast("long")}, by=ledger.BOOK, order=ledger.FILL_ORDER, ties=False)

    @cached_property
    def paired(self) -> DataFrame:
        return ledger.pair_trades(ledger.with_fees(self.fills))  # written there

    @cached_property
    def levels(self) -> DataFrame:
        return book.level_intervals(self.ticks)

    @cached_property
    def grid(self) -> DataFrame:
        return book.book_at(self.levels, 14400)

    @cached_property
    def quotes(self) -> DataFrame:
        return book.best_quotes(self.ticks, self.levels)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """The rows written once to the shared folder, for queries that read them several times."""
        path = io.scratch(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def stored_quotes(self) -> DataFrame:
        return self.stored(self.quotes, "quotes")

    @cached_property
    def kinds(self) -> DataFrame:
        return book.update_kind(self.ticks)

    @cached_property
    def fp(self) -> DataFrame:
        return footprint.footprint_long(self.trades, "4h")

    @cached_property
    def bars4(self) -> DataFrame:
        return B.ohlcv(self.trades, "4h").join(B.side_volumes(self.trades, "4h"), [*B.KEY, "ts"])

    @cached_property
    def bars1(self) -> DataFrame:
        """One-hour bars with any message; trade fields are null without a trade."""
        at = [*B.KEY, "ts"]
        out = B.bar_quality(self.ticks, "1h").select(*at, "gap_count", "is_partial")
        return out.join(B.ohlcv(self.trades, "1h"), at, "left").join(B.side_volumes(self.trades, "1h"), at, "left")

    @cached_property
    def feat(self) -> DataFrame:
        """bars1 with closing quotes, mean spread and order flow."""
        at = [*B.KEY, "ts"]
        q = B.open_close_quotes(self.stored_quotes, "1h").select(*at, "best_bid", "best_ask")
        out = self.bars1.join(q, at, "left").join(B.spread_stats(self.stored_quotes, "1h").select(*at, "spread_mean"), at, "left")
        return self.stored(out.join(B.ofi_l1(self.stored_quotes, "1h"), at, "left"), "feat")
