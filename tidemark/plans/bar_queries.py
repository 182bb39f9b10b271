"""Queries over books, bars and footprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import book, cascade, footprint
from tidemark.plans.registry import RAW, register

K = "exchange:s symbol:s ts:t "
BY = "exchange, symbol, bar as ts"


def at(text: str):
    return F.lit(text).cast("timestamp")


# ---- book ---------------------------------------------------------------------------------------
register("b01_epochs", "exchange:s symbol:s seq:i epoch:i waiting:b", lambda d: book.with_epoch(d.ticks), "select exchange, symbol, seq, epoch, coalesce(last_value(case when snap then 0 when gap_cause = 'internal_merge_error' then 1 end ignore nulls) over (partition by exchange, symbol order by ts, seq), 0) = 1 as waiting from epochs")
register("b02_cold_start", "exchange:s symbol:s seq:i replayed:b", lambda d: book.cold_start_filter(d.ticks), "select exchange, symbol, seq, event_type = 'update' and event_type is not null and (s is null or seq < s) as replayed from (select *, min(case when snap then seq end) over (partition by exchange, symbol) as s from ticks) where not coalesce(event_type = 'update' and (s is null or seq < s), false) or seq > s")
register("b03_synthetic_gaps", K + "cause:s", lambda d: book.synthetic_gaps(d.ticks, 5), """select exchange, symbol, ts, case when snap and prior = 'snapshot' then 'snapshot_superseded' when snap and seq < most / 2 then 'seq_reset' when nth = 0 and event_type = 'update' and held = 6 then 'cold_start_buffer_overflow' end as cause
  from (select *, max(case when event_type = 'update' then seq end) over p as most, sum(snap::int) over w as nth, last_value(case when event_type in ('snapshot', 'update') then event_type end ignore nulls) over p as prior, sum((coalesce(event_type, '') = 'update')::int) over w as held
  from ticks window w as (partition by exchange, symbol order by ts, seq), p as (partition by exchange, symbol order by ts, seq rows between unbounded preceding and 1 preceding)) where cause is not null""")
register("b04_level_intervals", "exchange:s symbol:s epoch:i side:s price:d size:d valid_from:t to_seq:i", lambda d: d.levels, "select * from levels")
register("b05_dedupe_updates", "exchange:s symbol:s seq:i price:d size:d", lambda d: book.dedupe_updates(d.ticks), "select exchange, symbol, seq, price, size from (select *, max(seq) over (partition by exchange, symbol order by ts rows between unbounded preceding and 1 preceding) as m from updates) where m is null or seq > m")
register("b06_best_quotes", "exchange:s symbol:s seq:i bid:d bid_size:d ask:d ask_size:d mid:d", lambda d: d.quotes, "select * from quotes")
register("b07_previous_quote", "exchange:s symbol:s seq:i bid:d prev_bid:d prev_ask:d", lambda d: book.with_prev_quote(d.stored_quotes), "select exchange, symbol, seq, bid, lag(bid) over w as prev_bid, lag(ask) over w as prev_ask from quotes window w as (partition by exchange, symbol, epoch order by ts, seq)")
register("b08_update_kind", "exchange:s symbol:s seq:i kind:s", lambda d: d.kinds, "select * from kinds")
_depth = ", ".join(f"sum(size) filter (where side = '{s}' and r <= {n}) as {x}_depth_{label}" for s, x in (("buy", "bid"), ("sell", "ask")) for n, label in ((1, "l1"), (2, "l2"), (3, "l3"), (4, "l4"), (5, "l5"), (10, "top10"), (99999, "total")))
_ranked = "(select *, row_number() over (partition by exchange, symbol, ts, side order by case when side = 'buy' then -price else price end) as r from depth_grid)"
register("b09_depth_snapshot", K + " ".join(f"{x}_depth_{y}:d" for x in ("bid", "ask") for y in ("l1", "l2", "l3", "l4", "l5", "top10", "total")) + " weighted_bid_price:d weighted_ask_price:d", lambda d: book.depth_snapshot(d.grid),
         f"select exchange, symbol, ts, {_depth}, sum(price * size) filter (where side = 'buy') / sum(size) filter (where side = 'buy') as weighted_bid_price, sum(price * size) filter (where side = 'sell') / sum(size) filter (where side = 'sell') as weighted_ask_price from {_ranked} group by all")
register("b10_depth_1pct", K + "depth_to_1pct_bid:d depth_to_1pct_ask:d", lambda d: book.depth_1pct(d.grid), "select exchange, symbol, ts, sum(size) filter (where side = 'buy' and price >= hi * 0.99) as depth_to_1pct_bid, sum(size) filter (where side = 'sell' and price <= lo * 1.01) as depth_to_1pct_ask from (select *, max(price) over w as hi, min(price) over w as lo from depth_grid window w as (partition by exchange, symbol, ts, side)) group by all")
register("b11_top_n_depth", K + "depth:d", lambda d: book.top_n_depth(d.grid, 3, "sell"), f"select exchange, symbol, ts, sum(size) as depth from {_ranked} where side = 'sell' and r <= 3 group by all")
register("b12_heatmap", K + "rank:i bid_price:d bid_size:d ask_price:d ask_size:d", lambda d: book.book_heatmap(d.grid), f"select exchange, symbol, ts, r as rank, coalesce(max(case when side = 'buy' then price end), 0) as bid_price, coalesce(max(case when side = 'buy' then size end), 0) as bid_size, coalesce(max(case when side = 'sell' then price end), 0) as ask_price, coalesce(max(case when side = 'sell' then size end), 0) as ask_size from {_ranked} where r <= 20 group by all")
register("b13_detect_gaps", K + "seq_before:i seq_after:i", lambda d: book.detect_gaps(d.ticks), "select exchange, symbol, ts, p as seq_before, seq as seq_after from (select *, lag(seq) over (partition by exchange, symbol order by ts, seq) as p from ticks where msg_type = 'tick') where seq <> p + 1")
_int = "('internal_merge_error', 'snapshot_superseded', 'seq_reset', 'cold_start_buffer_overflow')"
register("b14_gap_log", K + "gap_cause:s seq_gap:i gap_class:s", lambda d: book.gap_log(d.gaps), f"select exchange, symbol, ts, gap_cause, seq_after - seq_before - 1 as seq_gap, case when gap_cause in {_int} then 'internal' else 'external' end as gap_class from gaps")
register("b15_dedupe_gaps", K + "seq_before:i seq_after:i gap_cause:s", lambda d: book.dedupe_gaps(d.gaps.unionByName(d.gaps)), "select exchange, symbol, seq_before, seq_after, gap_cause, min(ts) as ts from gaps group by all")
register("b16_gap_count_24h", "exchange:s symbol:s gap_count_24h:i", lambda d: book.gap_count_24h(d.gaps, at("2024-01-20 12:30:00")), f"select exchange, symbol, count(*) filter (where date_trunc('hour', ts) between timestamp '2024-01-19 13:00:00' and timestamp '2024-01-20 12:00:00') as gap_count_24h from gaps where gap_cause in {_int} group by all")
register("b16_gap_count_series", "exchange:s symbol:s hour:i gap_count_24h:i", lambda d: book.gap_count_series(d.gaps), f"select exchange, symbol, hour, sum(n) over (partition by exchange, symbol order by hour range between 23 preceding and current row) as gap_count_24h from (select exchange, symbol, epoch(date_trunc('hour', ts))::bigint // 3600 as hour, count(*) as n from gaps where gap_cause in {_int} group by all)")
register("b17_gap_health", "exchange:s symbol:s healthy:i", lambda d: book.gap_health(d.gaps, ["sequence_gap"], 86400, at("2024-01-20")), "select exchange, symbol, case when max(case when gap_cause = 'sequence_gap' then epoch(ts)::bigint end) > epoch(timestamp '2024-01-20')::bigint - 86400 then 0 else 1 end as healthy from gaps group by all")
register("b18_snapshot_merge", K + "snap_seq:i oldest:i replayed:i stale:b", lambda d: book.snapshot_merge(d.ticks), """with n as (select *, sum(snap::int) over (partition by exchange, symbol order by ts, seq) - snap::int as nth from ticks)
  select s.exchange, s.symbol, s.ts, s.seq as snap_seq, min(u.seq) as oldest, count(*) filter (where u.seq > s.seq) as replayed, coalesce(min(u.seq) > s.seq + 1, false) as stale from n s left join (select * from n where event_type = 'update') u on s.exchange = u.exchange and s.symbol = u.symbol and s.nth = u.nth where s.snap group by s.exchange, s.symbol, s.ts, s.seq""")
register("b19_drop_buffering", "exchange:s symbol:s seq:i msg_type:s", lambda d: book.drop_buffering(d.ticks), "select exchange, symbol, seq, msg_type from (select *, last_value(case when gap then 1 when snap then 0 end ignore nulls) over (partition by exchange, symbol order by ts, seq) as st from ticks) where msg_type <> 'tick' or coalesce(st, 0) = 0")
register("j03_book_at", K + "side:s price:d size:d", lambda d: d.grid, "select * from depth_grid")
register("s18_book_feed", K + "mid:d spread:d bid_volume:d ask_volume:d n_bids:i", lambda d: book.book_feed(d.grid).withColumn("n_bids", F.size("bids")), f"select exchange, symbol, ts, case when b is not null and a is not null then (b + a) / 2 else 0 end as mid, case when b is not null and a is not null then a - b else 0 end as spread, bid_volume, ask_volume, n_bids from (select exchange, symbol, ts, max(price) filter (where side = 'buy') as b, min(price) filter (where side = 'sell') as a, sum(case when side = 'buy' then size else 0 end) as bid_volume, sum(case when side = 'sell' then size else 0 end) as ask_volume, count(*) filter (where side = 'buy') as n_bids from {_ranked} where r <= 20 group by all)")

# ---- bar fields ---------------------------------------------------------------------------------
T = "from trades group by all"
register("f01_ohlcv", K + "open:d high:d low:d close:d volume:d quote_volume:d trade_count:i", lambda d: B.ohlcv(d.trades, "4h"), "select * from bars4")
register("f02_twap", K + "twap:d", lambda d: B.twap(d.trades, "4h"), f"select {BY}, case when sum(h) > 0 then sum(price * h) / sum(h) else arg_max(price, seq) end as twap from (select *, (epoch_us(coalesce(lead(ts) over (partition by exchange, symbol, bar order by ts, seq), bar + interval '4 hours')) - epoch_us(ts)) / 1e6 as h from trades) group by all")
_q = "from quotes where mid is not null group by all"
register("f03_mid_path", K + "mid_price_open:d mid_price_high:d mid_price_low:d", lambda d: B.mid_path(d.quotes, "4h"), f"select {BY}, arg_min(mid, seq) as mid_price_open, max(mid) as mid_price_high, min(mid) as mid_price_low {_q}")
register("f04_spread_stats", K + "spread_high:d spread_low:d spread_mean:d", lambda d: B.spread_stats(d.quotes, "4h"), f"select {BY}, max(ask - bid) as spread_high, min(ask - bid) as spread_low, avg(ask - bid) as spread_mean {_q}")
_tq = "from trades t join quotes q using (exchange, symbol, seq) where q.mid is not null"


def _trades_q(d):
    return d.trades.join(d.quotes.select(*B.KEY, "seq", "mid"), [*B.KEY, "seq"], "left")


register("f05_vwmp", K + "vwmp:d", lambda d: B.vwmp(_trades_q(d), "4h"), f"select exchange, symbol, t.bar as ts, sum(q.mid * t.size) / sum(t.size) as vwmp {_tq} group by all")
register("f06_effective_spread", K + "effective_spread:d", lambda d: B.effective_spread(_trades_q(d), "4h"), f"select exchange, symbol, t.bar as ts, avg(2 * abs(t.price - q.mid)) as effective_spread {_tq} group by all")
register("f07_open_close_quotes", K + "best_bid_open:d best_ask_open:d best_bid:d best_ask:d", lambda d: B.open_close_quotes(d.stored_quotes, "4h"), f"select {BY}, arg_min(coalesce(b0, bid), seq) as best_bid_open, arg_min(coalesce(a0, ask), seq) as best_ask_open, arg_max(bid, seq) as best_bid, arg_max(ask, seq) as best_ask from (select *, lag(bid) over w as b0, lag(ask) over w as a0 from quotes where mid is not null window w as (partition by exchange, symbol, acc_epoch order by ts, seq)) group by all")
register("f08_quote_changes", K + "best_bid_changes:i best_ask_changes:i", lambda d: B.quote_changes(d.stored_quotes, "4h"), f"select {BY}, count(*) filter (where bid <> b0) as best_bid_changes, count(*) filter (where ask <> a0) as best_ask_changes from (select *, lag(bid) over w as b0, lag(ask) over w as a0 from quotes where mid is not null window w as (partition by exchange, symbol, bar order by ts, seq)) group by all")


def _depth_columns(d):
    now = book.depth_snapshot(d.grid).join(book.depth_1pct(d.grid), [*B.KEY, "ts"])
    back = now.select(*B.KEY, F.timestamp_seconds(F.unix_seconds("ts") - 14400).alias("ts"), F.col("bid_depth_l1").alias("bid_depth_l1_close"), F.col("ask_depth_l1").alias("ask_depth_l1_close"), F.col("bid_depth_top10").alias("bid_depth_top10_close"), F.col("ask_depth_top10").alias("ask_depth_top10_close"), "depth_to_1pct_bid")
    first = now.select(*B.KEY, "ts", F.col("bid_depth_l1").alias("bid_depth_l1_open"), F.col("ask_depth_l1").alias("ask_depth_l1_open"))
    return first.join(back, [*B.KEY, "ts"], "full_outer")


_dsql = f"""(select coalesce(o.exchange, c.exchange) as exchange, coalesce(o.symbol, c.symbol) as symbol, coalesce(o.ts, c.ts) as ts, o.bl1 as bid_depth_l1_open, o.al1 as ask_depth_l1_open, c.bl1 as bid_depth_l1_close, c.al1 as ask_depth_l1_close, c.b10 as bid_depth_top10_close, c.a10 as ask_depth_top10_close
  from (select exchange, symbol, ts, sum(size) filter (where side = 'buy' and r = 1) as bl1, sum(size) filter (where side = 'sell' and r = 1) as al1 from {_ranked} group by all) o full outer join
  (select exchange, symbol, ts - interval '4 hours' as ts, sum(size) filter (where side = 'buy' and r = 1) as bl1, sum(size) filter (where side = 'sell' and r = 1) as al1, sum(size) filter (where side = 'buy' and r <= 10) as b10, sum(size) filter (where side = 'sell' and r <= 10) as a10 from {_ranked} group by all) c
  on o.exchange = c.exchange and o.symbol = c.symbol and o.ts = c.ts)"""
register("f09_depth_columns", K + "bid_depth_l1_open:d ask_depth_l1_open:d bid_depth_l1_close:d ask_depth_l1_close:d bid_depth_top10_close:d", _depth_columns, f"select * from {_dsql}")
register("f10_ofi_l1", K + "ofi_l1:d ofi:d", lambda d: B.ofi_l1(d.stored_quotes, "4h"), f"select {BY}, sum(f) as ofi_l1, sum(f) as ofi from flow group by all")
register("f11_side_volumes", K + "buy_volume:d buy_count:i sell_volume:d", lambda d: B.side_volumes(d.trades, "4h"), f"select {BY}, sum(case when side = 'buy' then size else 0 end) as buy_volume, count(*) filter (where side = 'buy') as buy_count, sum(case when side = 'sell' then size else 0 end) as sell_volume {T}")


def _thr(d):
    from tidemark.operators.rolling import block_threshold

    return block_threshold(d.trades)


_thr_sql = "(select *, case when n >= 100 then list_sort(l)[ceil(0.99 * n)::bigint] end as threshold from (select *, list(size) over w as l, count(*) over w as n from trades window w as (partition by exchange, symbol order by ts, seq rows between 999 preceding and current row)))"
register("w01_block_threshold", "exchange:s symbol:s seq:i threshold:d", _thr, f"select * from {_thr_sql}")
register("f12_block_trades", K + "block_buy_volume:d block_sell_volume:d large_bid_orders:i large_ask_orders:i", lambda d: B.block_trades(_thr(d), "4h"), f"select {BY}, sum(size) filter (where size > threshold and side = 'buy') as block_buy_volume, sum(size) filter (where size > threshold and side = 'sell') as block_sell_volume, sum(1) filter (where size > threshold and side = 'buy') as large_bid_orders, sum(1) filter (where size > threshold and side = 'sell') as large_ask_orders from {_thr_sql} group by all")
register("f13_trade_extremes", K + "max_trade_size:d first_trade_offset_ms:i last_trade_offset_ms:i", lambda d: B.trade_extremes(d.trades, "4h"), f"select {BY}, max(size) as max_trade_size, min((epoch_us(ts) - epoch_us(bar)) // 1000) as first_trade_offset_ms, max((epoch_us(ts) - epoch_us(bar)) // 1000) as last_trade_offset_ms {T}")
register("f14_max_run", K + "max_consecutive_run:i", lambda d: B.max_run(d.trades, "4h"), "select exchange, symbol, bar as ts, max(n) as max_consecutive_run from (select exchange, symbol, bar, side, g, count(*) as n from (select *, row_number() over (partition by exchange, symbol, bar order by ts, seq) - row_number() over (partition by exchange, symbol, bar, side order by ts, seq) as g from trades) group by all) group by all")
_gap = "(select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by exchange, symbol, bar order by ts, seq)) as g from trades)"
register("f15_interval_gini", K + "trade_clustering:d", lambda d: B.interval_gini(d.trades, "4h"), f"select {BY}, case when sum(g) > 0 then sum((2 * i - m - 1) * g)::double / (max(m) * sum(g))::double end as trade_clustering from (select *, row_number() over (partition by exchange, symbol, bar order by g) as i, count(*) over (partition by exchange, symbol, bar) as m from {_gap} where g is not null) group by all")
_ret = "(select *, ln(mid / lag(mid) over (partition by exchange, symbol, acc_epoch order by ts, seq)) as r from quotes where mid is not null)"
register("f16_realized_vol", K + "realized_vol:d", lambda d: B.realized_vol(d.stored_quotes, "4h"), f"select {BY}, case when stddev_samp(r) > 0 then stddev_samp(r) end as realized_vol from {_ret} where r is not null group by all")
register("f17_realized_skew", K + "realized_skewness:d", lambda d: B.realized_skew(d.stored_quotes, "4h"), f"select {BY}, case when count(*) >= 3 and sum((r - m) ** 2) > 0 then sqrt(count(*)) * sum((r - m) ** 3) / sum((r - m) ** 2) ** 1.5 end as realized_skewness from (select *, avg(r) over (partition by exchange, symbol, bar) as m from {_ret} where r is not null) group by all")
register("f18_tick_counts", K + "uptick_count:i downtick_count:i", lambda d: B.tick_counts(d.trades, "4h"), f"select {BY}, count(*) filter (where price > p) as uptick_count, count(*) filter (where price < p) as downtick_count from (select *, lag(price) over (partition by exchange, symbol, bar order by ts, seq) as p from trades) group by all")
_act = ", ".join(f"count(*) filter (where kind = '{k}' and side = '{s}') as {n}" for k, s, n in (("add", "buy", "bid_order_arrivals"), ("add", "sell", "ask_order_arrivals"), ("cancel", "buy", "bid_cancel_count"), ("cancel", "sell", "ask_cancel_count")))
register("f19_book_activity", K + "bid_order_arrivals:i ask_order_arrivals:i bid_cancel_count:i ask_cancel_count:i ob_modify_count:i avg_bid_order_size:d avg_ask_order_size:d", lambda d: B.book_activity(d.kinds, "4h"), f"select {BY}, {_act}, count(*) filter (where kind = 'modify') as ob_modify_count, avg(size) filter (where kind = 'add' and side = 'buy') as avg_bid_order_size, avg(size) filter (where kind = 'add' and side = 'sell') as avg_ask_order_size from kinds group by all")
register("f20_quote_stuff_ratio", K + "quote_stuff_ratio:d", lambda d: B.quote_stuff_ratio(B.book_activity(d.kinds, "4h").join(d.bars4.drop("volume"), [*B.KEY, "ts"])), "select exchange, symbol, ts, n::double / trade_count as quote_stuff_ratio from bars4 join (select exchange, symbol, bar as ts, count(*) filter (where kind <> 'modify') as n from kinds group by all) using (exchange, symbol, ts)")
register("f21_sign_autocorr", K + "trade_sign_autocorr:d", lambda d: B.sign_autocorr(d.trades, "4h"), f"select {BY}, case when var_pop(s) > 0 and var_pop(s0) > 0 then corr(s0, s) end as trade_sign_autocorr from (select *, case when side = 'buy' then 1.0 else -1.0 end::double as s, lag(case when side = 'buy' then 1.0 else -1.0 end::double) over (partition by exchange, symbol, bar order by ts, seq) as s0 from trades) where s0 is not null group by all")
register("f22_interval_std", K + "inter_trade_interval_std_ms:e", lambda d: B.interval_std(d.trades, "4h"), f"select {BY}, stddev_pop(g / 1000.0) as inter_trade_interval_std_ms from {_gap} where g is not null group by all")
register("f23_price_levels", K + "num_trade_price_levels:i", lambda d: B.price_levels(d.trades, "4h"), f"select {BY}, count(distinct price_str) as num_trade_price_levels {T}")
register("f24_footprint", K + "levels:i text_keys:s total:d", lambda d: footprint.footprint(d.fp).withColumn("m", footprint.parsed(F.col("footprint_json"))).select("exchange", "symbol", "ts", F.size("m").alias("levels"), F.array_join(F.map_keys("m"), ",").alias("text_keys"), F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, x: a + x["b"] * 2 + x["s"]).alias("total")), "select exchange, symbol, ts, count(*) as levels, string_agg(price_str, ',' order by price_str) as text_keys, sum(b * 2 + s) as total from fp group by all")
register("f25_value_area", K + "poc_price:d value_area_high:d value_area_low:d poc_volume:d", lambda d: footprint.value_area(d.fp), """with recursive lv as (select exchange, symbol, ts, price, b + s as v, row_number() over (partition by exchange, symbol, ts order by price) as i, count(*) over (partition by exchange, symbol, ts) as n, sum(b + s) over (partition by exchange, symbol, ts) as total from fp),
  poc as (select exchange, symbol, ts, arg_max(i, {'v': v, 'p': price}) as i, arg_max(price, {'v': v, 'p': price}) as p, max(v) as v, any_value(n) as n, any_value(total) as total from lv group by all),
  grow as (select exchange, symbol, ts, i as lo, i as hi, v as acc, n, total, p, v from poc union all
    select g.exchange, g.symbol, g.ts, case when coalesce(u.v, -1) >= coalesce(l.v, -1) then lo else lo - 1 end, case when coalesce(u.v, -1) >= coalesce(l.v, -1) then hi + 1 else hi end, acc + greatest(coalesce(u.v, -1), coalesce(l.v, -1)), g.n, g.total, g.p, g.v
    from grow g left join lv u on g.exchange = u.exchange and g.symbol = u.symbol and g.ts = u.ts and u.i = hi + 1 left join lv l on g.exchange = l.exchange and g.symbol = l.symbol and g.ts = l.ts and l.i = lo - 1 where acc < 0.7 * g.total and (u.v is not null or l.v is not null)),
  done as (select exchange, symbol, ts, min(lo) as lo, max(hi) as hi, any_value(p) as p, any_value(v) as v from grow group by all)
  select d.exchange, d.symbol, d.ts, p as poc_price, h.price as value_area_high, l.price as value_area_low, d.v as poc_volume from done d join lv h on d.exchange = h.exchange and d.symbol = h.symbol and d.ts = h.ts and h.i = d.hi join lv l on d.exchange = l.exchange and d.symbol = l.symbol and d.ts = l.ts and l.i = d.lo""")
_flag = "(select *, s > 0 and b > 3 * s as bf, b > 0 and s > 3 * b as sf, row_number() over (partition by exchange, symbol, ts order by price) as i from fp)"
_stack = lambda f, n: f"(select exchange, symbol, ts, max(c) as {n} from (select exchange, symbol, ts, g, count(*) as c from (select *, i - row_number() over (partition by exchange, symbol, ts order by price) as g from {_flag} where {f}) group by all) group by all)"
register("f26_imbalance", K + "imbalance_buy_count:i imbalance_sell_count:i imbalance_stack_buy:i imbalance_stack_sell:i imbalance_ratio:d", lambda d: footprint.imbalance(d.fp), f"select exchange, symbol, ts, x as imbalance_buy_count, y as imbalance_sell_count, coalesce(sb, 0) as imbalance_stack_buy, coalesce(ss, 0) as imbalance_stack_sell, (x - y) / n as imbalance_ratio from (select exchange, symbol, ts, count(*) filter (where bf) as x, count(*) filter (where sf) as y, count(*)::double as n from {_flag} group by all) left join {_stack('bf', 'sb')} using (exchange, symbol, ts) left join {_stack('sf', 'ss')} using (exchange, symbol, ts)")
register("f27_auction_signals", K + "single_print_count:i unfinished_top:b unfinished_bottom:b", lambda d: footprint.auction_signals(d.fp, d.bars4), "select exchange, symbol, ts, count(*) filter (where b + s < 0.1 * m and price > low and price < high) as single_print_count, coalesce(sum(s) filter (where price = high), 0) = 0 as unfinished_top, coalesce(sum(b) filter (where price = low), 0) = 0 as unfinished_bottom from (select *, avg(b + s) over (partition by exchange, symbol, ts) as m from fp) join (select exchange, symbol, ts, high, low from bars4) using (exchange, symbol, ts) group by all")
register("f28_absorption", K + "absorption_detected:b", lambda d: B.absorption(d.bars4.select(*B.KEY, "ts", "open", "close", "trade_count", "buy_volume", (F.col("buy_volume") + F.col("sell_volume")).alias("volume"))), "select exchange, symbol, ts, trade_count >= 5 and (buy_volume / volume > 0.6 or buy_volume / volume < 0.4) and abs(close - open) / close < 0.0005 as absorption_detected from bars4")
register("f29_footprint_divergence", K + "footprint_delta_divergence:i", lambda d: B.footprint_divergence(d.bars4), "select exchange, symbol, ts, case when close > open and buy_volume < sell_volume then 1 when close < open and buy_volume > sell_volume then -1 else 0 end as footprint_delta_divergence from bars4")
_cvd = "(select *, sum(buy_volume - sell_volume) over (partition by exchange, symbol, e order by ts) as cd from (select b.*, e from bars4 b join (select exchange, symbol, time_bucket(interval '4 hours', ts) as ts, max(epoch) as e from epochs group by all) using (exchange, symbol, ts)))"


def _with_cvd_epoch(d):
    e = B.with_bar(B.with_reset_epochs(d.ticks), "4h").groupBy(*B.BAR).agg(F.max("cvd_epoch").alias("cvd_epoch")).withColumnRenamed("bar", "ts")
    return B.cum_delta(d.bars4.join(e, [*B.KEY, "ts"]))


register("f30_cum_delta", K + "cum_delta:d", _with_cvd_epoch, f"select exchange, symbol, ts, cd as cum_delta from {_cvd}")
register("f31_cvd_divergence", K + "cvd_divergence:i", _with_cvd_epoch, f"select exchange, symbol, ts, case when c0 is null then null when close > c0 and cd < d0 then 1 when close < c0 and cd > d0 then -1 else 0 end as cvd_divergence from (select *, lag(close) over w as c0, lag(cd) over w as d0 from {_cvd} window w as (partition by exchange, symbol, e order by ts))")


def _closing(d):
    return d.bars4.drop("volume").join(B.ohlcv(d.trades, "4h").select(*B.KEY, "ts", "volume"), [*B.KEY, "ts"]).join(_depth_columns(d), [*B.KEY, "ts"], "left").join(B.book_activity(d.kinds, "4h"), [*B.KEY, "ts"], "left").join(B.open_close_quotes(d.stored_quotes, "4h"), [*B.KEY, "ts"], "left")


_closing_sql = f"(select b.*, bid_depth_l1_open, ask_depth_l1_open, bid_depth_l1_close, ask_depth_l1_close, bid_depth_top10_close, ask_depth_top10_close, ba, aa, bc, ac, best_bid, best_ask from bars4 b left join {_dsql} using (exchange, symbol, ts) left join (select exchange, symbol, bar as ts, count(*) filter (where kind = 'add' and side = 'buy') as ba, count(*) filter (where kind = 'add' and side = 'sell') as aa, count(*) filter (where kind = 'cancel' and side = 'buy') as bc, count(*) filter (where kind = 'cancel' and side = 'sell') as ac from kinds group by all) using (exchange, symbol, ts) left join (select exchange, symbol, bar as ts, arg_max(bid, seq) as best_bid, arg_max(ask, seq) as best_ask from quotes where mid is not null group by all) using (exchange, symbol, ts))"
_ib = "coalesce(bid_depth_l1_open > 0 and bid_depth_l1_close >= 0.8 * bid_depth_l1_open and buy_volume > 0 and ba > 0, false)"
_ia = "coalesce(ask_depth_l1_open > 0 and ask_depth_l1_close >= 0.8 * ask_depth_l1_open and sell_volume > 0 and aa > 0, false)"
register("f32_iceberg", K + "iceberg_bid_detected:b iceberg_ask_detected:b iceberg_price:d", lambda d: B.iceberg(_closing(d)), f"select exchange, symbol, ts, {_ib} as iceberg_bid_detected, {_ia} as iceberg_ask_detected, case when {_ib} then best_bid when {_ia} then best_ask end as iceberg_price from {_closing_sql}")
register("f33_hawkes", K + "hawkes_intensity:d", lambda d: B.hawkes(d.ticks, "4h"), "select exchange, symbol, ts, 0.8 * sum(exp(-10 * (epoch_us(l) - epoch_us(t.ts2)) / 1e6)) as hawkes_intensity from (select exchange, symbol, time_bucket(interval '4 hours', ts) as ts, max(ts) as l from ticks where msg_type = 'tick' group by all) join (select exchange as e2, symbol as s2, ts as ts2 from ticks where msg_type = 'tick') t on exchange = t.e2 and symbol = t.s2 and t.ts2 <= l and t.ts2 > l - interval '5 seconds' group by all")
_micro = "case when bid_depth_l1_close + ask_depth_l1_close <> 0 then (best_ask * bid_depth_l1_close + best_bid * ask_depth_l1_close) / (bid_depth_l1_close + ask_depth_l1_close) else (best_bid + best_ask) / 2 end"
register("f34_microprice", K + "microprice:d microprice_mid_delta:d", lambda d: B.microprice(_closing(d)), f"select exchange, symbol, ts, {_micro} as microprice, ({_micro} - (best_bid + best_ask) / 2) / ((best_bid + best_ask) / 2) * 10000 as microprice_mid_delta from {_closing_sql}")
register("f35_cancel_bias", K + "cancel_bias:d", lambda d: B.cancel_bias(_closing(d)), f"select exchange, symbol, ts, (bc - ac) / (bc + ac + 1)::double as cancel_bias from {_closing_sql}")
register("f36_trade_aggressiveness", K + "trade_aggressiveness:d", lambda d: B.trade_aggressiveness(_closing(d)), f"select exchange, symbol, ts, case when coalesce(bid_depth_l1_close, 0) = 0 then 0 else volume / (bid_depth_l1_close + 1e-9) end as trade_aggressiveness from {_closing_sql}")
register("f37_vwap_deviation", K + "buy_vwap_deviation_bps:d sell_vwap_deviation_bps:d", lambda d: B.vwap_deviation(d.trades, B.open_close_quotes(d.stored_quotes, "4h"), "4h"), "select exchange, symbol, ts, (bv - m) / m * 10000 as buy_vwap_deviation_bps, (sv - m) / m * 10000 as sell_vwap_deviation_bps from (select exchange, symbol, bar as ts, sum(price * size) filter (where side = 'buy') / sum(size) filter (where side = 'buy') as bv, sum(price * size) filter (where side = 'sell') / sum(size) filter (where side = 'sell') as sv from trades group by all) join (select exchange, symbol, bar as ts, (arg_max(bid, seq) + arg_max(ask, seq)) / 2 as m from quotes where mid is not null group by all) using (exchange, symbol, ts)")
register("f38_bar_quality", K + "gap_count:i bar_seq:i is_partial:b", lambda d: B.bar_quality(d.ticks, "4h"), "select exchange, symbol, ts, gap_count, row_number() over (partition by exchange, symbol, e order by ts) as bar_seq, is_partial from (select exchange, symbol, time_bucket(interval '4 hours', ts) as ts, count(*) filter (where gap) as gap_count, bool_or(snap) as is_partial, max(acc_epoch) as e from epochs group by all)")
register("f39_fill_empty_bars", K + "open:d volume:d", lambda d: B.fill_empty_bars(B.ohlcv(d.trades, "1h"), "1h"), "select s.exchange, s.symbol, s.ts, open, volume from (select exchange, symbol, unnest(generate_series(min(ts), max(ts), interval '1 hour')) as ts from bars1 where open is not null group by exchange, symbol) s left join bars1 b on s.exchange = b.exchange and s.symbol = b.symbol and s.ts = b.ts")


def _cascade_sql(tf: str, step: str) -> str:
    return f"select '{tf}' as tf, exchange, symbol, time_bucket(interval '{step}', ts) as slot, arg_min(open, ts) filter (where open is not null) as open, max(high) as high, min(low) as low, arg_max(close, ts) filter (where open is not null) as close, coalesce(sum(volume), 0) as volume, coalesce(sum(trade_count), 0) as trade_count, avg(spread_mean) as spread_mean, sum(gap_count) as gap_count, count(*) as bar_count from feat group by all"


_casc = "tf:s " + K + "open:d high:d low:d close:d volume:d trade_count:i spread_mean:d gap_count:i bar_count:i"
register("f40_cascade", _casc, lambda d: cascade.cascade(d.feat, ["4h", "1d", "1w"]), "select * exclude (slot), slot as ts from (" + " union all ".join(_cascade_sql(a, b) for a, b in (("4h", "4 hours"), ("1d", "1 day"), ("1w", "7 days"))) + ")")
register("f41_open_bars", K + "open:d close:d volume:d is_complete:b", lambda d: cascade.open_bars(d.bars1.withColumn("spread_mean", F.lit(None).cast("double")), "1w", at("2024-01-17 10:00:00")), "select exchange, symbol, time_bucket(interval '7 days', ts) as ts, arg_min(open, ts) filter (where open is not null) as open, arg_max(close, ts) filter (where open is not null) as close, coalesce(sum(volume), 0) as volume, false as is_complete from bars1 where ts <= timestamp '2024-01-17 10:00:00' and time_bucket(interval '7 days', ts) + interval '7 days' > timestamp '2024-01-17 10:00:00' group by all")
register("f42_completeness", K + "found:i expected:i completeness:d", lambda d: cascade.completeness(d.bars1, "1h", "1d", at("2024-01-20 07:30:00")), "select exchange, symbol, slot as ts, n as found, e as expected, n / e as completeness from (select exchange, symbol, date_trunc('day', ts) as slot, count(distinct ts)::double as n, ceil((epoch(least(date_trunc('day', ts) + interval '1 day', timestamp '2024-01-20 07:30:00')) - epoch(date_trunc('day', ts))) / 3600) as e from bars1 where ts < timestamp '2024-01-20 07:30:00' group by all)")
_res = "select exchange, symbol, time_bucket(interval '7 days', ts) as ts, arg_min(open, ts) filter (where open is not null) as open, max(high) as high, min(low) as low, arg_max(close, ts) filter (where close is not null) as close, coalesce(sum(volume), 0) as volume, coalesce(sum(gap_count), 0) as gap_count, bool_or(is_partial) as is_partial from bars1 group by all"
register("f43_resample", K + "open:d high:d low:d close:d volume:d gap_count:i is_partial:b", lambda d: cascade.resample(d.bars1, "1w", at("2024-01-29")), f"select * from ({_res}) where ts + interval '7 days' <= timestamp '2024-01-29'")
register("f44_resample_spine", K + "open:d volume:d", lambda d: cascade.resample_spine(B.ohlcv(d.trades, "5m"), "30m"), "select s.exchange, s.symbol, s.ts, open, coalesce(volume, 0) as volume from (select exchange, symbol, unnest(generate_series(min(h), max(h), interval '30 minutes')) as ts from (select exchange, symbol, time_bucket(interval '30 minutes', ts) as h from trades) group by exchange, symbol) s left join (select exchange, symbol, time_bucket(interval '30 minutes', ts) as ts, arg_min(price, seq) as open, sum(size) as volume from trades group by all) b on s.exchange = b.exchange and s.symbol = b.symbol and s.ts = b.ts")


def _day_merge(d):
    m = footprint.merge_footprints(footprint.footprint(d.fp), "1d").withColumn("m", footprint.parsed(F.col("footprint_json")))
    return m.select("exchange", "symbol", "ts", F.explode("m").alias("price_str", "v")).select("exchange", "symbol", "ts", "price_str", F.col("v.b").alias("b"), F.col("v.s").alias("s"))


register("f45_merge_footprints", K + "price_str:s b:d s:d", _day_merge, "select exchange, symbol, date_trunc('day', ts) as ts, price_str, sum(b) as b, sum(s) as s from fp group by all")
register("f46_merge_single_prints", K + "n:i levels:s", lambda d: footprint.merge_single_prints(footprint.auction_signals(d.fp, d.bars4), "1w").select("*", F.from_json("single_print_levels_json", "array<double>").alias("l")).select("exchange", "symbol", "ts", F.size("l").alias("n"), F.array_join(F.transform("l", lambda x: x.cast("long").cast("string")), ",").alias("levels")), "select exchange, symbol, ts, count(p) as n, coalesce(string_agg(p::bigint::varchar, ',' order by p), '') as levels from (select distinct exchange, symbol, time_bucket(interval '7 days', ts) as ts, case when b + s < 0.1 * m and price > lo and price < hi then price end as p from (select *, avg(b + s) over w as m, min(price) over w as lo, max(price) over w as hi from fp window w as (partition by exchange, symbol, ts))) group by all")


_BAR = """open high low close volume quote_volume twap buy_volume sell_volume max_trade_size vwmp effective_spread mid_price_open mid_price_high mid_price_low spread_high spread_low spread_mean best_bid_open best_ask_open best_bid best_ask
ofi_l1 ofi realized_vol realized_skewness trade_clustering trade_sign_autocorr avg_bid_order_size avg_ask_order_size hawkes_intensity""".split()
_BAR_COUNTS = """trade_count buy_count first_trade_offset_ms last_trade_offset_ms max_consecutive_run uptick_count downtick_count num_trade_price_levels best_bid_changes best_ask_changes bid_order_arrivals ask_order_arrivals bid_cancel_count
ask_cancel_count ob_modify_count gap_count bar_seq""".split()
_OF_BARS = "f01_ohlcv f02_twap f11_side_volumes f13_trade_extremes f14_max_run f15_interval_gini f18_tick_counts f21_sign_autocorr f22_interval_std f23_price_levels f05_vwmp f06_effective_spread f03_mid_path f04_spread_stats f07_open_close_quotes f08_quote_changes f10_ofi_l1 f16_realized_vol f17_realized_skew f19_book_activity f33_hawkes".split()


def _bar_sql() -> str:
    """The joined row from the SQL of its parts, each with its own columns."""
    parts = []
    for name in _OF_BARS:
        raw = RAW[name] if name != "f01_ohlcv" else "select * exclude (buy_volume, sell_volume) from bars4"
        parts.append(f"left join ({raw}) using (exchange, symbol, ts)")
    return f"select * from ({RAW['f38_bar_quality']}) " + " ".join(parts)


register(
    "build_bars_4h", K + " ".join(f"{c}:d" for c in _BAR) + " " + " ".join(f"{c}:i" for c in _BAR_COUNTS) + " inter_trade_interval_std_ms:e is_partial:b",
    lambda d: B.build_bars(d.ticks, d.stored_quotes, d.kinds, d.trades, "4h"), _bar_sql(),
)


_MORE = """block_buy_volume block_sell_volume bid_depth_l1_open ask_depth_l1_open bid_depth_l1_close ask_depth_l1_close bid_depth_top10_close poc_price value_area_high value_area_low poc_volume imbalance_ratio quote_stuff_ratio iceberg_price
microprice microprice_mid_delta cancel_bias trade_aggressiveness buy_vwap_deviation_bps sell_vwap_deviation_bps cum_delta""".split()
_MORE_COUNTS = "large_bid_orders large_ask_orders imbalance_buy_count imbalance_sell_count imbalance_stack_buy imbalance_stack_sell single_print_count cvd_divergence footprint_delta_divergence levels".split()
_MORE_FLAGS = "absorption_detected iceberg_bid_detected iceberg_ask_detected unfinished_top unfinished_bottom".split()


def _whole_sql() -> str:
    """The row above with what follows from it; parts of the footprint and of block trades have their own SQL."""
    joined = " ".join(f"left join ({RAW[name]}) using (exchange, symbol, ts)" for name in "f12_block_trades f24_footprint f25_value_area f26_imbalance f27_auction_signals f30_cum_delta f31_cvd_divergence f37_vwap_deviation".split())
    ice = [f"coalesce({s}_depth_l1_open > 0 and {s}_depth_l1_close >= 0.8 * {s}_depth_l1_open and {v} > 0 and {s}_order_arrivals > 0, false)" for s, v in (("bid", "buy_volume"), ("ask", "sell_volume"))]
    return f"""select *, (bid_order_arrivals + ask_order_arrivals + bid_cancel_count + ask_cancel_count)::double / nullif(trade_count, 0) as quote_stuff_ratio, {ice[0]} as iceberg_bid_detected, {ice[1]} as iceberg_ask_detected,
      case when {ice[0]} then best_bid when {ice[1]} then best_ask end as iceberg_price, coalesce(trade_count >= 5 and (buy_volume / volume > 0.6 or buy_volume / volume < 0.4) and abs(close - open) / close < 0.0005, false) as absorption_detected,
      case when close > open and buy_volume < sell_volume then 1 when close < open and buy_volume > sell_volume then -1 when close is not null then 0 end as footprint_delta_divergence,
      {_micro} as microprice, ({_micro} - (best_bid + best_ask) / 2) / ((best_bid + best_ask) / 2) * 10000 as microprice_mid_delta, (bid_cancel_count - ask_cancel_count) / (bid_cancel_count + ask_cancel_count + 1)::double as cancel_bias,
      case when coalesce(trade_count, 0) = 0 then null when coalesce(bid_depth_l1_close, 0) = 0 then 0 else volume / (bid_depth_l1_close + 1e-9) end as trade_aggressiveness
      from ({_bar_sql()}) left join {_dsql} using (exchange, symbol, ts) {joined}"""


def _whole(d):
    d = d.with_epochs()
    out = B.whole_bars(d.ticks, d.stored_quotes, d.kinds, d.stored(_thr(d), "thresholds"), _depth_columns(d), "4h")
    return out.withColumn("levels", F.size(footprint.parsed(F.col("footprint_json"))))


_WHOLE = K + " ".join(f"{c}:d" for c in _BAR + _MORE) + " " + " ".join(f"{c}:i" for c in _BAR_COUNTS + _MORE_COUNTS) + " inter_trade_interval_std_ms:e is_partial:b " + " ".join(f"{c}:b" for c in _MORE_FLAGS)
register("build_bars_whole_4h", _WHOLE, _whole, _whole_sql())
