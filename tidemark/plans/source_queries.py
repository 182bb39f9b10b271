"""Queries over wire messages, files, streams and models, all derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.core import KEY
from tidemark.operators import bars as B
from tidemark.operators import data_quality, ledger, ml, rolling
from tidemark.plans.bar_queries import at
from tidemark.plans.more_queries import _DELTA, _delta, _fixed, _pair, _z
from tidemark.plans.registry import RAW, Data, register
from tidemark.sources import io, normalize
from tidemark.streaming import stateful
from tidemark.streaming import ticks as stream

K = "exchange:s symbol:s ts:t "


# ---- wire messages --------------------------------------------------------------------------------
def _raw(d: Data, exchange: str, rows: DataFrame, body) -> DataFrame:
    return rows.where(F.col("exchange") == exchange).select("exchange", body.alias("body"))


def _ms() -> str:
    return F.unix_millis("ts")


def _level():
    return F.array(F.array("price_str", "size_str"))


def _none():
    return F.array().cast("array<array<string>>")


def _bybit_book(d: Data) -> DataFrame:
    buy = F.col("side") == "buy"
    data = F.struct(F.concat("symbol", F.lit("USDT")).alias("s"), F.when(buy, _level()).otherwise(_none()).alias("b"), F.when(~buy, _level()).otherwise(_none()).alias("a"), F.col("seq").alias("u"))
    body = F.to_json(F.struct(F.concat(F.lit("orderbook.50."), "symbol", F.lit("USDT")).alias("topic"), F.lit("delta").alias("type"), _ms().alias("ts"), data.alias("data")))
    return _raw(d, "bybit", d.updates, body)


register("s01_bybit_book", K + "seq:i side:s price:d size:d", lambda d: normalize.normalize_bybit_book(_bybit_book(d))[0], "select exchange, symbol || '-USDT' as symbol, time_bucket(interval '1 millisecond', ts) as ts, seq, side, price, size from updates where exchange = 'bybit'")


def _bybit_trades(d: Data) -> DataFrame:
    t = F.struct(_ms().alias("T"), F.col("price_str").alias("p"), F.col("size_str").alias("v"), F.initcap("side").alias("S"), F.col("seq").cast("string").alias("i"))
    body = F.to_json(F.struct(F.concat(F.lit("publicTrade."), "symbol", F.lit("USDC")).alias("topic"), F.array(t, t).alias("data")))
    return _raw(d, "bybit", d.trades, body)


register("s02_bybit_trades", K + "side:s price:d size:d", lambda d: normalize.normalize_bybit_trades(_bybit_trades(d)), "select exchange, symbol || '-USDC' as symbol, time_bucket(interval '1 millisecond', ts) as ts, side, price, size from trades, range(0, 2) where exchange = 'bybit'")


def _kucoin_book(d: Data) -> DataFrame:
    level = F.array(F.array("price_str", "size_str", F.col("seq").cast("string")))
    buy = F.col("side") == "buy"
    data = F.struct(F.col("seq").alias("sequenceStart"), (F.col("seq") + 1).alias("sequenceEnd"), _ms().alias("time"), F.struct(F.when(buy, level).otherwise(_none()).alias("bids"), F.when(~buy, level).otherwise(_none()).alias("asks")).alias("changes"))
    return _raw(d, "kucoin", d.updates, F.to_json(F.struct(F.concat(F.lit("/market/level2:"), "symbol", F.lit("-USDT")).alias("topic"), data.alias("data"))))


register("s03_kucoin_book", K + "seq:i msg_seq_start:i msg_seq_end:i side:s price:d size:d", lambda d: normalize.normalize_kucoin_book(_kucoin_book(d)), "select exchange, symbol || '-USDT' as symbol, time_bucket(interval '1 millisecond', ts) as ts, seq, seq as msg_seq_start, seq + 1 as msg_seq_end, side, price, size from updates where exchange = 'kucoin'")


def _kucoin_trades(d: Data) -> DataFrame:
    data = F.struct(F.col("seq").cast("string").alias("sequence"), F.col("price_str").alias("price"), F.col("size_str").alias("size"), "side", (F.unix_micros("ts") * 1000).cast("string").alias("time"), F.concat("symbol", F.lit("-USDT")).alias("symbol"))
    return _raw(d, "kucoin", d.trades, F.to_json(F.struct(F.lit("t").alias("topic"), data.alias("data"))))


register("s04_kucoin_trades", K + "seq:i side:s price:d size:d", lambda d: normalize.normalize_kucoin_trades(_kucoin_trades(d)), "select exchange, symbol || '-USDT' as symbol, ts, seq, side, price, size from trades where exchange = 'kucoin'")
register("s05_canonical_symbol", "raw:s canonical:s n:i", lambda d: d.fills.withColumn("raw", F.concat(F.lower("symbol"), F.when(F.col("size") % 3 == 0, "usdt").when(F.col("size") % 3 == 1, "btc").otherwise("-xyz"))).withColumn("canonical", normalize.canonical_symbol(F.col("exchange"), F.col("raw"))).groupBy("raw", "canonical").agg(F.count(F.lit(1)).alias("n")), "select lower(symbol) || e as raw, symbol || case e when 'usdt' then '-USDT' when 'btc' then '-BTC' else '-XYZ' end as canonical, count(*) as n from (select *, case size % 3 when 0 then 'usdt' when 1 then 'btc' else '-xyz' end as e from fills) group by all")


def _unified(d: Data) -> DataFrame:
    t = d.ticks
    bad = F.col("seq") % 17 == 0
    return t.select("exchange", "symbol", F.when(F.col("seq") % 23 == 0, "odd").otherwise(F.col("msg_type")).alias("type"), F.when(F.col("event_type") == "trade", "0").otherwise("1").alias("level"), F.when(bad, "x").otherwise(F.col("seq").cast("string")).alias("seq"), (F.unix_micros("ts") * 1000).cast("string").alias("ts_ns"), "side", F.col("price_str").alias("price"), F.col("size_str").alias("size"))


register("s06_decode_messages", K + "msg_type:s unknown:b event_type:s seq:i side:s", lambda d: normalize.decode_messages(_unified(d)), "select exchange, symbol, ts, case when seq % 23 <> 0 then msg_type end as msg_type, seq % 23 = 0 as unknown, case when seq % 23 = 0 then null when msg_type = 'tick' then event_type when msg_type = 'snapshot' then 'snapshot' end as event_type, case when seq % 17 = 0 then 0 else seq end as seq, side from ticks")
register("s07_clean_messages", "exchange:s symbol:s seq:i size:d", lambda d: normalize.clean_messages(d.ticks.unionByName(d.ticks)), "select exchange, symbol, seq, size from ticks where not coalesce(event_type = 'trade' and size <= 0, false)")


def _funding_raw(d: Data) -> DataFrame:
    g, ku = d.gaps, F.col("exchange") == "kucoin"
    rate = (F.col("seq") % 100 / 10000).cast("string")
    body = F.struct(F.concat("symbol", F.lit("USDT")).alias("symbol"), F.when(~ku, rate).alias("fundingRate"), F.when(~ku, _ms() + 1000).alias("nextFundingTime"), F.when(ku, rate).alias("value"), F.when(ku, _ms()).alias("timePoint"), F.when(ku, F.lit(28800000)).alias("granularity"), _ms().alias("ts"))
    return g.select("exchange", F.to_json(body).alias("body"))


register("s22_funding", K + "funding_rate:d next_funding_ts:t", lambda d: normalize.normalize_funding(_funding_raw(d)), "select exchange, symbol || '-USDT' as symbol, time_bucket(interval '1 millisecond', ts) as ts, (seq % 100) / 10000.0::double as funding_rate, time_bucket(interval '1 millisecond', ts) + case when exchange = 'kucoin' then interval '8 hours' else interval '1 second' end as next_funding_ts from gaps")


# ---- files ------------------------------------------------------------------------------------------
def _stored(d: Data) -> str:
    path = io.scratch(d.spark, "bars")
    io.write_bars(d.bars4, path)
    return path


register("s08_read_bars", K + "close:d volume:d", lambda d: io.read_bars(d.spark, _stored(d), "bybit", "S1", at("2024-01-05 04:00:00"), at("2024-01-09")), "select * from bars4 where exchange = 'bybit' and symbol = 'S1' and ts >= timestamp '2024-01-05 04:00:00' and ts < timestamp '2024-01-09'")
register("s09_read_day", K + "close:d volume:d", lambda d: io.read_day(d.spark, _stored(d), "kucoin", "S0", "2024-01-07"), "select * from bars4 where exchange = 'kucoin' and symbol = 'S0' and ts::date = date '2024-01-07'")
register("s10_read_features", K + "close:d volume:d", lambda d: io.read_features(d.spark, _stored(d), "kucoin", "S0", "2024-01-07", "2024-01-12"), "select * from bars4 where exchange = 'kucoin' and symbol = 'S0' and ts::date between date '2024-01-07' and date '2024-01-12'")


def _ticks_back(d: Data) -> DataFrame:
    path = io.scratch(d.spark, "ticks")
    io.write_ticks(d.ticks, path)
    return d.spark.read.parquet(path)


register("s11_write_ticks", "exchange:s date:D msg_type:s n:i", lambda d: _ticks_back(d).groupBy("exchange", "date", "msg_type").agg(F.count(F.lit(1)).alias("n")), "select exchange, ts::date as date, msg_type, count(*) as n from ticks group by all")


def _upserted(d: Data) -> DataFrame:
    path, b = io.scratch(d.spark, "bars"), d.bars4.select(*KEY, "ts", "close", "volume")
    io.upsert_bars(d.spark, path, b.withColumn("version", F.lit(1)))
    io.upsert_bars(d.spark, path, b.where("volume > 300").withColumn("close", -F.col("close")).withColumn("version", F.lit(2)))
    return d.spark.read.parquet(path)


register("s12_upsert_bars", K + "close:d volume:d version:i", _upserted, "select exchange, symbol, ts, case when volume > 300 then -close else close end as close, volume, case when volume > 300 then 2 else 1 end as version from bars4")
register("s13_live_bars", K + "close:d", lambda d: io.live_bars(d.bars4, "1s", at("2024-02-10")), "select * from bars4 where ts::date >= date '2024-02-10' - 30")


def _after_expiry(d: Data) -> DataFrame:
    path = _stored(d)
    io.expire_bars(d.spark, path, "1s", at("2024-02-10"))
    return d.spark.read.parquet(path)


register("s13_expire_bars", K + "close:d", _after_expiry, "select * from bars4 where ts::date >= date '2024-02-10' - 30")


def _exported(d: Data) -> DataFrame:
    path = io.scratch(d.spark, "export")
    for day in ("2024-01-03", "2024-01-04", "2030-01-01"):
        io.export_day(d.bars4, day, path)
    return d.spark.read.parquet(path)


register("s14_export_day", K + "close:d date:D", _exported, "select *, ts::date as date from bars4 where ts::date in (date '2024-01-03', date '2024-01-04')")


def _manifest(d: Data) -> DataFrame:
    """A manifest from the gap log: a day failed if it has an odd number of gaps."""
    return d.gaps.groupBy(F.to_date("ts").alias("day")).agg((F.count("seq") % 2 == 0).alias("success"), F.concat(F.lit("gaps "), F.array_join(F.array_sort(F.collect_list(F.col("seq").cast("string"))), " ")).alias("error"))


_MAN = "(select ts::date as day, count(seq) % 2 = 0 as success, 'gaps ' || string_agg(seq::varchar, ' ' order by seq::varchar) as error from gaps group by all)"
register("s15_missing_export_days", "day:D", lambda d: io.missing_export_days(_manifest(d), F.lit("2024-02-03").cast("date")), f"select x as day from (select unnest(generate_series((select min(day) from {_MAN}), date '2024-02-02', interval '1 day'))::date as x) where x not in (select day from {_MAN} where success)")


def _manifest_back(d: Data) -> DataFrame:
    path, m = io.scratch(d.spark, "manifest"), _manifest(d)
    io.append_manifest(m.where("success"), path)
    io.append_manifest(m.where("not success"), path)
    return d.spark.read.parquet(path)


register("s16_append_manifest", "day:D success:b error:s", _manifest_back, f"select * from {_MAN}")
register("s17_export_alerts", "day:D alert_type:s detail:s", lambda d: io.export_alerts(_manifest(d)), f"select day, 'export_failed' as alert_type, substr(error, 1, 512) as detail from {_MAN} where not success")
register("s19_bar_feed", K + "close:d is_complete:b", lambda d: io.bar_feed(d.bars4, at("2024-01-20 06:00:00"), "4h"), "select exchange, symbol, ts, close, ts + interval '4 hours' <= timestamp '2024-01-20 06:00:00' as is_complete from bars4")
register("s20_book_feature_feed", K + "mid_price:d bid_depth_l1_close:d ofi_l1:d", lambda d: io.book_feature_feed(_delta(d)), f"select exchange, symbol, ts, (best_bid + best_ask) / 2 as mid_price, bid_depth_l1_close, ofi_l1 from {_DELTA}")
register("s21_wide_bar_feed", K + "volume:d best_bid:d partial:b", lambda d: io.wide_bar_feed(d.feat, ["volume"], [["best_bid", "best_ask"]], ["is_partial"]).select(*KEY, "ts", F.get_json_object("body", "$.volume").alias("volume"), F.get_json_object("body", "$.best_bid").alias("best_bid"), F.get_json_object("body", "$.is_partial").alias("partial")), "select exchange, symbol, ts, coalesce(volume, 0) as volume, best_bid, case when is_partial then true end as partial from feat")


def _runs_back(d: Data) -> DataFrame:
    path = io.scratch(d.spark, "runs")
    m = ledger.run_metrics(d.paired, 100000.0).withColumn("run_at", at("2024-01-05"))
    io.write_run(m, ledger.trade_table(d.paired).withColumn("run_at", at("2024-01-05")), path)
    return d.spark.read.parquet(f"{path}/runs")


register("s24_write_run", "strategy:s exchange:s symbol:s n_trades:i month:s", _runs_back, "select strategy, exchange, symbol, count(*) as n_trades, '2024-01' as month from paired group by all")


#: What several queries read, by application and data folder: written once, then read.
_ONCE: dict[tuple, DataFrame] = {}


def _once(d: Data, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (d.spark.sparkContext.applicationId, d.sf_dir, name)
    if key not in _ONCE:
        _ONCE[key] = build()
    return _ONCE[key]


#: Triggers of a stream in time order; larger tables have as many as hold about MOST_IN_ORDERED_FILE rows each.
STREAM_FILES = 4
#: Files of such a trigger, which are read in parallel, where each has LEAST_IN_PART rows; else one.
STREAM_PARTS, LEAST_IN_PART = 8, 10_000


# ---- streams ----------------------------------------------------------------------------------------
def _stream_ticks(d: Data, repeated: int = 0) -> DataFrame:
    """``events`` as a file stream in time order, shaped as ticks; what a trigger takes does not grow with the table. ``repeated`` times more, each row comes again in its trigger."""
    from tidemark.sources import adapter

    events = adapter.table(d.spark, d.sf_dir, "events")
    path = io.scratch(d.spark, "stream-in")
    triggers = max(STREAM_FILES, -(-events.count() * (1 + repeated) // MOST_IN_ORDERED_FILE))
    ordered = events.repartitionByRange(triggers * STREAM_PARTS, "ts", "event_id")
    if repeated:
        ordered = ordered.withColumn("again", F.explode(F.sequence(F.lit(0), F.lit(repeated)))).drop("again")
    file = F.floor(F.spark_partition_id() / STREAM_PARTS).cast("int")
    ordered.withColumn("file", file).sortWithinPartitions("file", "ts", "event_id").write.partitionBy("file").parquet(path)
    sizes = {r["file"]: r["count"] for r in d.spark.read.parquet(path).groupBy("file").count().collect()}  # as many as triggers
    parts = STREAM_PARTS if min(sizes.values(), default=0) >= STREAM_PARTS * LEAST_IN_PART else 1
    # Triggers take files by their time of change, so each trigger's are one write, of exactly ``parts`` files: those of one write may tie.
    for k in sorted(sizes):
        rows = d.spark.read.schema(events.schema).parquet(f"{path}/file={k}")
        (rows.repartition(parts) if parts > 1 else rows.coalesce(1)).write.mode("append").parquet(f"{path}-in")
    return adapter.ticks_of(d.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", parts).parquet(f"{path}-in"))


def _stream_trades(d: Data) -> DataFrame:
    from tidemark.sources import adapter

    return adapter.trades(_stream_ticks(d))


register("t01_stream_bars", K + "open:d high:d low:d close:d volume:d trade_count:i", lambda d: stream.run_available(stream.stream_bars(_stream_trades(d), "4h")), "select * from bars4 where ts + interval '4 hours' <= (select max(ts) from trades) - interval '10 seconds'")
register("t02_stream_partial_bars", K + "close:d volume:d", lambda d: io.latest_rows(stream.run_available(stream.stream_partial_bars(_stream_trades(d), "4h"), "update"), [*KEY, "ts"], "batch"), "select * from bars4")
register("t03_stream_book", "exchange:s symbol:s seq:i bid:d bid_size:d ask:d ask_size:d", lambda d: stream.run_available(stream.stream_book(_stream_ticks(d))), "select exchange, symbol, seq, bid, bid_size, ask, ask_size from quotes")
register("t04_stream_dedupe", "exchange:s symbol:s seq:i", lambda d: stream.run_available(stream.stream_dedupe(_stream_ticks(d, repeated=1))), "select exchange, symbol, seq from ticks")
register("t05_barrier", "exchange:s ts:t arrived:i is_complete:b", lambda d: stream.barrier(d.bars1.where("close is not null"), ["S0", "S1"], at("2024-01-20"), 3600)[0], "select exchange, ts, count(*) as arrived, count(*) = 2 as is_complete from bars1 where close is not null group by all having count(*) = 2 or ts + interval '1 hour' <= timestamp '2024-01-20'")
register("t05_barrier_gaps", "exchange:s ts:t symbol:s gap_cause:s", lambda d: stream.barrier(d.bars1.where("close is not null"), ["S0", "S1"], at("2024-01-20"), 3600)[1], "select exchange, ts, case when max(symbol) = 'S0' then 'S1' else 'S0' end as symbol, 'barrier_timeout' as gap_cause from bars1 where close is not null and ts + interval '1 hour' <= timestamp '2024-01-20' group by all having count(*) = 1")
_CUT = """select x.*, coalesce(time_bucket(interval '4 hours', s.cut) = ts, false) as is_partial, s.cut from (select exchange, symbol, time_bucket(interval '4 hours', ts) as ts, acc_epoch, arg_min(price, seq) as open, arg_max(price, seq) as close, sum(size) as volume
    from epochs where event_type = 'trade' and size > 0 and {0} group by all) x left join (select exchange, symbol, acc_epoch - 1 as acc_epoch, min(ts) as cut from epochs where snap and {0} group by all) s using (exchange, symbol, acc_epoch)"""
register("t06_cut_partial", K + "acc_epoch:i open:d close:d volume:d is_partial:b", lambda d: stream.cut_partial(d.ticks, d.trades, "4h"), _CUT.format("true"))

#: Seconds that streams of ticks and of bars wait for late rows here.
_DELAY, _TIMEOUT = 7200, 100_000


#: Rows of a file, and so of a trigger, of ``t04_dropped_rows``: the number of files grows with the table.
MOST_IN_FILE = 400_000


def _files(d: Data, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stream of files, one a trigger, in the order of its column ``file``; rows of a file in no order."""
    raw, path = io.scratch(d.spark, name), io.scratch(d.spark, f"{name}-in")
    shape = df.drop("file").schema
    df.repartition("file", F.pmod(F.xxhash64(*KEY, "ts"), F.lit(8))).write.partitionBy("file").parquet(raw)
    for k in sorted(r["file"] for r in d.spark.read.parquet(raw).select("file").distinct().collect()):  # as many as triggers
        d.spark.read.schema(shape).parquet(f"{raw}/file={k}").coalesce(1).sortWithinPartitions(F.xxhash64(*KEY, "ts")).write.mode("append").parquet(path)
    return d.spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(path)


def _stateful(d: Data, df: DataFrame) -> DataFrame:
    with stateful.with_state_store(d.spark):
        return stream.run_available(df)


#: Rows of a file of the streams that take rows in order; small tables have four files.
MOST_IN_ORDERED_FILE = 2_000_000


def _disordered(d: Data) -> DataFrame:
    """Ticks in files by time, four of them or as many as hold about MOST_IN_ORDERED_FILE rows each; each hour's last ten minutes come a file later than the others of their time, if by less than the delay."""
    s = F.unix_seconds("ts")
    span = d.ticks.agg(F.min(s).alias("a"), F.max(s).alias("b"), F.greatest(F.lit(3), F.ceil(F.count(F.lit(1)) / MOST_IN_ORDERED_FILE)).alias("n"))
    t = d.ticks.join(F.broadcast(span))  # one row
    file = F.floor((s - F.col("a")) * F.col("n") / (F.col("b") - F.col("a") + 1)).cast("int")
    near = file != F.floor((s + _DELAY // 2 - F.col("a")) * F.col("n") / (F.col("b") - F.col("a") + 1)).cast("int")  # shortly before a file's end
    return _files(d, t.withColumn("file", file + (near & (F.minute("ts") >= 50)).cast("int")).drop("a", "b", "n"), "disordered")


register("t06_stream_cut", K + "acc_epoch:i open:d close:d volume:d is_partial:b", lambda d: _stateful(d, stateful.stream_cut(_disordered(d), "4h", f"{_DELAY} seconds")),
    f"with m as (select max(ts) - interval '{_DELAY} seconds' as mark from ticks where snap or (event_type = 'trade' and size > 0)) select x.* from ({_CUT.format('ts <= (select mark from m)')}) x, m where ts + interval '4 hours' <= mark or cut <= mark")


_LIVE = f"""with m as (select max(ts) - interval '{_DELAY} seconds' as mark from ticks), w as (select exchange, symbol, seq, ts, coalesce(last_value(case when snap then 0 when gap and gap_cause = 'internal_merge_error' then 1 end ignore nulls) over (partition by exchange, symbol order by ts, seq), 1) = 0 as live from ticks)
    select w.exchange, w.symbol, w.seq, live, case when live then bid end as bid, case when live then bid_size end as bid_size, case when live then ask end as ask, case when live then ask_size end as ask_size from w join quotes q using (exchange, symbol, seq), m where w.ts <= mark"""
register("t03_live_book", "exchange:s symbol:s seq:i bid:d bid_size:d ask:d ask_size:d live:b", lambda d: _stateful(d, stateful.stream_live_book(_disordered(d), f"{_DELAY} seconds")), _LIVE)


def _upsert_stream(d: Data) -> DataFrame:
    """Three files: all bars, corrections of the large ones, and the first versions again, which change nothing."""
    b = d.bars4.select(*KEY, "ts", "close", "volume")
    first = b.withColumn("version", F.lit(1))
    fixed = b.where("volume > 300").withColumn("close", -F.col("close")).withColumn("version", F.lit(2))
    rows = first.withColumn("file", F.lit(0)).unionByName(fixed.withColumn("file", F.lit(1))).unionByName(first.withColumn("file", F.lit(2)))
    path, checkpoint = io.scratch(d.spark, "upserted"), io.scratch(d.spark, "upsert-state")
    stream_in = _files(d, rows, "versions")
    for _ in range(2):  # the second run finds nothing to do
        io.upsert_stream(stream_in, path, checkpoint, "version").awaitTermination()
    return d.spark.read.parquet(path)


register("s12_stream_upsert", K + "close:d volume:d version:i", _upsert_stream, RAW["s12_upsert_bars"])


def _late_bars(d: Data) -> DataFrame:
    """Hourly bars of two symbols in four files by time, each row in an older version first; some of S1 come with the last file, most of them too late."""
    b = d.bars1.where("close is not null and symbol in ('S0', 'S1')").select(*KEY, "ts", "close")
    span = b.agg(F.min(F.unix_seconds("ts")).alias("a"), F.max(F.unix_seconds("ts")).alias("b"))
    held = (F.col("symbol") == "S1") & (F.floor(F.unix_seconds("ts") / 3600) % 50 == 7)
    part = F.floor((F.unix_seconds("ts") - F.col("a")) * 3 / (F.col("b") - F.col("a") + 1)).cast("int")
    t = b.join(F.broadcast(span)).withColumn("file", F.when(held, 3).otherwise(part)).drop("a", "b")  # one row
    return _files(d, t.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("close", F.col("close") * F.col("version")), "late-bars")


#: A trigger drops what is behind the watermark that the trigger before it ran with, so for the last of four files that of the first two.
_ARRIVED = f"""(with b as (select exchange, symbol, ts, close, epoch(ts)::bigint as s, symbol = 'S1' and (epoch(ts)::bigint // 3600) % 50 = 7 as held from bars1 where close is not null and symbol in ('S0', 'S1')),
    r as (select min(s) as a, max(s) as z from b), m as (select max(ts) filter (where not held and (s - a) * 3 // (z - a + 1) <= 1) - interval '{_TIMEOUT} seconds' as before, max(ts) - interval '{_TIMEOUT} seconds' as mark from b, r)
    select exchange, ts, count(*) as n, max(symbol) as who, sum(2 * close) as total, any_value(mark) as mark from b, m where not held or ts > before group by all)"""


def _barred(d: Data) -> DataFrame:
    return _once(d, "barrier", lambda: _stateful(d, stateful.stream_barrier(_late_bars(d), ["S0", "S1"], _TIMEOUT)))


def _with_total(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.aggregate(F.map_values(F.from_json("closes", "map<string,double>")), F.lit(0.0), lambda a, v: a + v))


register("t05_stream_barrier", "exchange:s ts:t arrived:i is_complete:b total:d", lambda d: _with_total(_barred(d).where("gap_cause is null")), f"select exchange, ts, n as arrived, n = 2 as is_complete, total from {_ARRIVED} where n = 2 or ts <= mark")
register("t05_stream_gaps", "exchange:s ts:t symbol:s gap_cause:s", lambda d: _barred(d).where("gap_cause is not null"), f"select exchange, ts, case who when 'S0' then 'S1' else 'S0' end as symbol, 'barrier_timeout' as gap_cause from {_ARRIVED} where n = 1 and ts <= mark")


def _dropped(d: Data) -> DataFrame:
    """Every fiftieth tick comes after all others, with a trigger between. These come in files by time, of about MOST_IN_FILE rows, another fiftieth a file later than its time, which is not too late."""
    rest, s = F.col("seq") % 50, F.unix_seconds("ts")
    span = d.ticks.agg(F.min(s).alias("a"), F.max(s).alias("b"), F.ceil(F.count(F.lit(1)) / MOST_IN_FILE).alias("n"))
    file = F.floor((s - F.col("a")) * F.col("n") / (F.col("b") - F.col("a") + 1))
    t = d.ticks.join(F.broadcast(span))  # one row
    rows = _files(d, t.withColumn("file", F.when(rest == 3, F.col("n") + 1).when(rest == 4, file + 1).otherwise(file).cast("int")).drop("a", "b", "n"), "held-back")
    _, dropped = stateful.counted(stream.stream_dedupe(rows), lambda df, progress: stream.run_available(df, progress=progress))
    return dropped.groupBy("operator").agg(F.sum("dropped").alias("dropped"))


register("t04_dropped_rows", "operator:s dropped:i", _dropped, "select 'dedupeWithinWatermark' as operator, count(*) filter (where seq % 50 = 3 and ts <= (select max(ts) - interval '1 second' from ticks where seq % 50 not in (3, 4))) as dropped from ticks")
register("t07_drop_stale", "exchange:s ts:t mid_a:d", lambda d: stream.drop_stale(_pair(d), at("2024-01-30"), 864000), "select exchange, a.ts, a.mid_a from (select a.exchange, a.ts, a.close as mid_a, b.close as mid_b, b.ts as bts from (select * from bars1 where symbol = 'S0' and close is not null) a asof join (select * from bars1 where symbol = 'S1' and close is not null) b on a.exchange = b.exchange and a.ts >= b.ts) a where epoch(a.ts) - epoch(bts) <= 7200 and epoch(timestamp '2024-01-30') - epoch(a.ts) <= 864000")


# ---- models -----------------------------------------------------------------------------------------
def _built(d: Data) -> DataFrame:
    """M02 of the hourly bars with their excitation and cancel counts."""
    at = [*KEY, "ts"]
    b = _delta(d).join(B.hawkes(d.ticks, "1h"), at, "left").join(B.book_activity(d.kinds, "1h").select(*at, "bid_cancel_count", "ask_cancel_count"), at, "left")
    return ml.build_features(d.stored(b, "bars-in"), d.stored(rolling.classify_regime(d.feat).select(*at, "regime"), "regimes"))


def _features(d: Data) -> DataFrame:
    return rolling.reversion_labels(d.stored(_built(d), "built"), [1], 20.0)


def _clustered(d: Data) -> DataFrame:
    def build() -> DataFrame:
        raw = d.stored(_features(d), "features")
        return d.stored(ml.cluster_regimes(raw, ml.feature_cols(raw)), "clustered")

    return _once(d, "clustered", build)


def _registry(d: Data) -> DataFrame:
    """M07 over all feature columns; m07, m08 and m09 read the same fits."""
    f = _clustered(d)
    return _once(d, "registry", lambda: ml.train_slots(f, "label_revert_1", ml.feature_cols(f)))


#: Columns of the wide bars that the SQL side lacks, and columns that are null in the same rows.
_AS_STORED = {"quote_volume": "volume", "buy_count": "volume", "ofi": "ofi_l1"}
_FEATURES = "gap_count open high low close volume quote_volume trade_count buy_volume buy_count sell_volume best_bid best_ask spread_mean ofi_l1 ofi".split()
register("m01_feature_cols", "name:s rows:i nulls:i", lambda d: ml.feature_profile(d.feat.withColumn("adf_pvalue_60", F.lit(1))), " union all ".join(f"select '{c}' as name, count(*) as rows, count(*) - count({_AS_STORED.get(c, c)}) as nulls from feat" for c in _FEATURES))
register("m02_build_features", K + "ofi_l1_sg:d hurst_20:d hurst_60:d ou_halflife:e kyle_lambda:d ofi_x_spread:d microprice_x_hawkes:d microprice_mid_delta:d cancel_bias:d regime:s", _built)


def _labels_back(d: Data) -> DataFrame:
    path = io.scratch(d.spark, "labels")
    f = rolling.reversion_labels(_delta(d).withColumn("hurst_60", F.col("gap_count") * 0.6), [1], 50.0).select(*KEY, "ts", "label_revert_1")
    ml.write_labels(f.withColumn("label_revert_1", F.lit("stale")), path)
    ml.write_labels(f.where("exchange = 'kucoin'"), path)  # reruns of some partitions replace them
    ml.write_labels(f.where("exchange = 'bybit'"), path)
    return d.spark.read.parquet(path)


register("m03_write_labels", K + "date:D label_revert_1:s", _labels_back, f"select *, ts::date as date from ({RAW['w10_reversion_labels']})")
register("m04_cluster_regimes", K + "regime:s cluster:i", _clustered)
register("m04_cluster_stats", "regime:s n_samples:i n_clusters:i noise_pct:d", lambda d: ml.cluster_stats(_clustered(d)))
register("m06_with_weights", K + "label:i weight:d", lambda d: ml.with_weights(_delta(d).withColumn("l", F.when(F.col("volume") > 100, "TREND").when(F.col("volume") > 50, "REVERT")), "l"), "select exchange, symbol, ts, case when volume > 100 then 2 when volume > 50 then 0 else 1 end as label, case when volume > 50 then 2 else 1 end as weight from feat")
register("m07_train_slots", "regime:s cluster:i model_id:s cv_score:d n:i", _registry)
register("m08_importances", "regime:s cluster:i feature:s importance:d", lambda d: ml.importances(_registry(d)))
register("m09_score", K + "label:s confidence:d model_id:s model_cluster:i deviation:d", lambda d: ml.score(_clustered(d), _registry(d)))
def _spread_rows(d: Data) -> DataFrame:
    """The pair with its filtered hedge ratio, z-score, unit-root test, labels and the features of its first symbol."""
    p = rolling.spread_labels(rolling.adf_pvalue(rolling.spread_zscore(rolling.kalman_hedge(_pair(d)))))
    first = d.feat.where("symbol = 'S0'").drop("symbol")
    return d.stored(p.join(first, ["exchange", "ts"], "left"), "pair")


def _spread_scored(d: Data) -> DataFrame:
    rows = _once(d, "pair", lambda: _spread_rows(d))
    cols = [c for c in ml.feature_cols(d.feat) if c in rows.columns]
    return ml.score_spread(rows, _once(d, "pair-models", lambda: ml.train_spread(rows, cols)))


register("m10_score_spread", "exchange:s ts:t label:s reason:s confidence:d model_id:s", _spread_scored)
register("m10_spread_gates", "exchange:s ts:t label:s reason:s confidence:d", lambda d: ml.score_spread(_fixed(d).withColumn("adf_pvalue_60", F.when(F.unix_seconds("ts") % 10800 == 0, 0.2).otherwise(0.05))), f"select exchange, ts, 'NEUTRAL' as label, case when z is null or abs(z) <= 1.5 then 'neutral_zone' when epoch(ts)::bigint % 10800 = 0 then 'adf_fail' else 'no_spread_model' end as reason, 0 as confidence from {_z}")


def _contract() -> dict:
    return {"bars": {"open": ("double", F.col("open") > 0), "close": ("double", F.col("close") < 200), "twap": ("double", None)}, "ticks": {"seq": ("bigint", None), "side": ("int", None), "size": ("double", F.col("size") >= 0)}}


_DSQL = "select '{}' as \"table\", '{}' as \"column\", '{}' as expected, {} as status, count(*) as rows, {} as nulls, {} as failing from {}"
_CONTRACT_SQL = " union all ".join([
    _DSQL.format("bars", "open", "double", "case when count(*) filter (where open <= 0) > 0 then 'values' else 'ok' end", "count(*) - count(open)", "count(*) filter (where open <= 0)", "bars4"),
    _DSQL.format("bars", "close", "double", "case when count(*) filter (where close >= 200) > 0 then 'values' else 'ok' end", "count(*) - count(close)", "count(*) filter (where close >= 200)", "bars4"),
    _DSQL.format("bars", "twap", "double", "'missing'", "count(*)", "0", "bars4"), _DSQL.format("ticks", "seq", "bigint", "'ok'", "count(*) - count(seq)", "0", "ticks"),
    _DSQL.format("ticks", "side", "int", "'type'", "count(*) - count(side)", "0", "ticks"), _DSQL.format("ticks", "size", "double", "case when count(*) filter (where size < 0) > 0 then 'values' else 'ok' end", "count(*) - count(size)", "count(*) filter (where size < 0)", "ticks"),
])
register("d04_contract_check", "table:s column:s expected:s status:s rows:i nulls:i failing:i", lambda d: data_quality.contract_check(d.spark, {"bars": d.bars4, "ticks": d.ticks}, _contract()), _CONTRACT_SQL)
