"""Exact search for the k best inner products by segment statistics of several resolutions.

A vector is cut into 1, 4 and 16 segments; of each segment its mean and deviation are kept. For segments of length L
``|q - c|^2 >= sum of L * ((mean_q - mean_c)^2 + (dev_q - dev_c)^2)``, a bound that rises from coarse to fine; as ``2 <q, c> = |q|^2 + |c|^2 - |q - c|^2`` a bound
from below on the distance bounds the score from above. Whoever cannot reach the query's k-th best score so far is left out, and exact scores are computed for the survivors only.

Rows are laid out by coarse statistics into blocks of at most ``BLOCK``, so that blocks have narrow envelopes. Every query first meets its own block, which gives its
first k scores; then those blocks whose envelope may hold a better one. Blocks and envelopes stay where they are while queries stream past them: a task
holds one block (or the envelopes of ``BLOCK`` blocks) and a batch of queries, whatever their numbers, and no side is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, table, written
from tidemark.llm.merkle import ranked

BLOCK = 4096
RESOLUTIONS = (1, 4, 16)
#: Queries of a batch: BATCH x BLOCK scores are in memory at a time.
BATCH = 256
#: Lengths of vectors up to which the table of lengths is broadcast.
MOST_WIDTHS = 65_536
EXACT = float(1 << 53)
SLACK = 1e-9


def segments(width: int, count: int) -> list[tuple[int, int]]:
    """``count`` runs of nearly equal length, empty ones left out."""
    edges = [width * k // count for k in range(count + 1)]
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def statistics(x: np.ndarray, count: int) -> np.ndarray:
    """Each row's means and deviations by segment, both times the root of the length: the bound on a score is the inner product of two such rows."""
    if not x.shape[1]:
        return np.zeros((len(x), 2))
    parts = [(x[:, a:b], np.sqrt(b - a)) for a, b in segments(x.shape[1], count)]
    return np.concatenate([np.stack([p.mean(axis=1) * w for p, w in parts], axis=1), np.stack([p.std(axis=1) * w for p, w in parts], axis=1)], axis=1)


def highest(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Bounds on the scores from statistics: ``(|q|^2 + |c|^2 - bound of the distance) / 2``."""
    return q @ c.T


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held in doubles as long as every sum is exact there, else computed with long integers and cut to the range of a long."""
    if not q.size or not c.size or np.abs(q).max() * np.abs(c).max() * q.shape[1] < EXACT:
        return q @ c.T
    a, b = (np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (q, c))
    return np.clip(a.dot(b.T), -(1 << 63), (1 << 63) - 1)


class Block:
    """Candidates of one block: ids, vectors, rows, and their statistics."""

    def __init__(self, uid: np.ndarray, vec_id: np.ndarray, known: np.ndarray, x: np.ndarray) -> None:
        self.uid, self.vec_id, self.known, self.x = uid, vec_id, known, x
        self.stats = [statistics(x, n) for n in RESOLUTIONS]
        self.norm = np.sqrt((x * x).sum(axis=1))

    def best(self, uid: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[list[np.ndarray], int]:
        """For each query the places and scores of its k best rows of at least ``floor`` (ties by vec_id, null last), without the query's own row; and how many exact scores that took."""
        slack = SLACK * np.outer(np.sqrt((q * q).sum(axis=1)), self.norm) + 1e-6
        alive = uid[:, None] != self.uid[None, :]
        for n, stats in zip(RESOLUTIONS, self.stats, strict=True):
            some = alive.any(axis=0)
            if not some.any():
                break
            bound = highest(statistics(q, n), stats[some]) + slack[:, some]
            alive[:, some] &= bound >= floor[:, None]
        some = np.flatnonzero(alive.any(axis=0))
        out = []
        exact = scores(q, self.x[some])
        for i in range(len(q)):
            there = some[alive[i, some]]
            value = exact[i, alive[i, some]]
            order = np.lexsort((self.uid[there], self.vec_id[there], ~self.known[there], -value if value.dtype != object else np.array([-int(v) for v in value], np.float64)))[: k if value.dtype != object else None]
            if value.dtype == object:  # doubles do not tell neighbours apart: sort once more
                order = np.array(sorted(order, key=lambda j: (-value[j], not self.known[there[j]], self.vec_id[there[j]], self.uid[there[j]]))[:k], np.int64)
            out.append((there[order], value[order]))
        return out, int(alive.sum())


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 0))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _floors(column: pa.Array) -> np.ndarray:
    """Scores to reach; a query without k hits yet takes any. A score cut to the lowest long may be lower still."""
    floor = np.where(column.is_valid().to_numpy(zero_copy_only=False), _numbers(column).astype(np.float64), -np.inf)
    return np.where(floor <= -float(1 << 63), -np.inf, floor)


HITS = "query_uid long, query_id long, uid long, vec_id long, score long"
_HITS = pa.schema([("query_uid", pa.int64()), ("query_id", pa.int64()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def streamed(kept: DataFrame, passing: DataFrame, by: list[str], fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over partitions that hold, group by group, the rows of ``kept`` (passing 0) and then those of ``passing`` (1), all with the same columns."""
    both = kept.withColumn("passing", F.lit(0)).unionByName(passing.withColumn("passing", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*by).sortWithinPartitions(*by, "passing").mapInArrow(fn, schema)


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.Table | None, pa.RecordBatch]]:
    """(what the group keeps, a batch of at most BATCH rows that pass it); the first of a group comes with a fresh table."""
    key, held, whole = None, [], None
    for b in batches:
        if not len(b):
            continue
        marks = [*[b.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in by], b.column("passing").to_numpy(zero_copy_only=False)]
        cut = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
        for lo, hi in zip([0, *cut], [*cut, len(b)], strict=True):
            here = tuple(m[lo] for m in marks[:-1])
            if here != key:
                key, held, whole = here, [], None
            if marks[-1][lo] == 0:
                held.append(b.slice(lo, hi - lo))
                continue
            if whole is None:
                whole = pa.Table.from_batches(held, b.schema).combine_chunks() if held else pa.Table.from_batches([], b.schema)
            for at in range(lo, hi, BATCH):
                yield whole, b.slice(at, min(BATCH, hi - at))


def _search(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for held, q in _groups(batches, ["width", "block"]):
            if not held.num_rows:
                continue
            if held is not last:
                ids = held.column("vec_id").combine_chunks()
                last, block = held, Block(_numbers(held.column("uid").combine_chunks()), _numbers(ids), np.asarray(ids.is_valid()), _matrix(held.column("x").combine_chunks()))
            uid, query_id = _numbers(q.column("uid")), _numbers(q.column("vec_id"))
            floor = _floors(q.column("floor"))
            found, _ = block.best(uid, _matrix(q.column("x")), floor, k)
            n = [len(p) for p, _ in found]
            at = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
            value = [int(v) for _, s in found for v in s]
            ids = pa.array(block.vec_id[at], pa.int64(), mask=~block.known[at])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(uid, n), pa.int64()), pa.array(np.repeat(query_id, n), pa.int64()), pa.array(block.uid[at], pa.int64()), ids, pa.array(value, pa.int64())], schema=_HITS)

    return run


def _envelopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block of rows (sorted by block): lowest and highest scaled mean and highest deviation of each segment, by resolution."""
    key, low, high, norm = None, None, None, 0.0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"width": [key[0]], "block": [key[1]], "low": [low.tolist()], "high": [high.tolist()], "norm": [norm]}, schema=pa.schema([("width", pa.int32()), ("block", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("norm", pa.float64())]))

    for b in batches:
        if not len(b):
            continue
        width, block = (b.column(c).to_numpy(zero_copy_only=False) for c in ("width", "block"))
        cut = np.flatnonzero((width[1:] != width[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *cut], [*cut, len(b)], strict=True):
            x = _matrix(b.column("x").slice(lo, hi - lo))
            stats = np.concatenate([statistics(x, n) for n in RESOLUTIONS], axis=1)
            here, most = (width[lo], block[lo]), float(np.sqrt((x * x).sum(axis=1)).max())
            if here != key:
                if key is not None:
                    yield row()
                key, low, high, norm = here, stats.min(axis=0), stats.max(axis=0), most
            else:
                low, high, norm = np.minimum(low, stats.min(axis=0)), np.maximum(high, stats.max(axis=0)), max(norm, most)
    if key is not None:
        yield row()


ASKED = "uid long, block long"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of a group whose envelope may hold a score of at least the query's floor, other than its own block. Coarse to fine: a block out at one resolution is not looked at again."""
    last, low, high, norm, blocks = None, None, None, None, None
    for held, q in _groups(batches, ["width", "group"]):
        if not held.num_rows:
            continue
        if held is not last:
            last, blocks = held, _numbers(held.column("block").combine_chunks())
            low, high = (_matrix(held.column(c).combine_chunks()) for c in ("low", "high"))
            norm = held.column("norm").combine_chunks().to_numpy(zero_copy_only=False)
        x, own = _matrix(q.column("x")), _numbers(q.column("block"))
        floor = _floors(q.column("floor"))
        slack = SLACK * np.outer(np.sqrt((x * x).sum(axis=1)), norm) + 1e-6
        alive = own[:, None] != blocks[None, :]
        at = 0
        for n in RESOLUTIONS:
            s = statistics(x, n)
            lo, hi = low[:, at : at + s.shape[1]], high[:, at : at + s.shape[1]]
            at += s.shape[1]
            some = np.flatnonzero(alive.any(axis=0))
            up, down = np.maximum(s, 0), np.minimum(s, 0)  # a positive factor wants the highest, a negative one the lowest
            bound = up @ hi[some].T + down @ lo[some].T + slack[:, some]
            alive[:, some] &= bound >= floor[:, None]
        i, j = np.nonzero(alive)
        yield pa.RecordBatch.from_arrays([pa.array(_numbers(q.column("uid"))[i], pa.int64()), pa.array(blocks[j], pa.int64())], names=["uid", "block"])


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, x (floor of ``scale`` times each component, held in doubles), width; without the rows that take no part."""
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double") * scale) == float("inf")))
    t = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("embedding").isNotNull() & ~odd)
    x = F.transform("embedding", lambda v: F.when(F.abs(v.cast("double") * scale) < EXACT, F.floor(v.cast("double") * scale).cast("double")).otherwise(v.cast("double") * scale))
    return t.select("vec_id", x.alias("x"), F.size("embedding").alias("width"))


def _cell(x: Column, width: Column) -> Column:
    """Signs of the means of four segments, one bit each, and the vector's mean: rows that are near each other in coarse statistics."""
    bits = F.lit(0)
    for k in range(4):
        part = F.slice(x, F.floor(width * k / 4).cast("int") + 1, F.greatest(F.floor(width / 4).cast("int"), F.lit(0)))
        bits = bits * 2 + (F.aggregate(part, F.lit(0.0), lambda a, v: a + v) > 0).cast("int")
    return bits


def best_hits(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query with their rank; ranks are cut before the exchange too."""
    order = Window.partitionBy("query_uid", "query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, asks: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``asks`` (a condition on vec_id) the k other rows with the highest inner products of whole components.

    Ties go to the smaller vec_id, a null vec_id last. A row is a candidate unless it is the query's own row: repeated rows find each other, and a query that stands twice is answered
    twice. Vectors that are null or have a null or non-finite component (or one whose 256-fold is not finite) take no part; vectors meet those of their own length (empty ones score 0). Fewer than k
    candidates: all. Scores beyond a long are cut to its range before they are ranked. An empty table gives an empty result; other columns are ignored.
    """
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    plain = written(whole_vectors(vectors))
    spread = plain.select("*", place.alias("uid"), _cell(F.col("x"), F.col("width")).alias("cell"), F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v).alias("energy"))
    rows, _ = ranked(spread, ["width"], ["cell", "energy", "uid"])
    part, spot = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    blocks = written(rows.select("vec_id", "x", "width", "uid", (part * (1 << 32) + F.floor(spot / BLOCK)).alias("block")))
    discard(plain, rows)
    asking = F.col("vec_id").isNotNull() & asks
    own = written(streamed(blocks, blocks.where(asking).withColumn("floor", F.lit(None).cast("long")), ["width", "block"], _search(k), HITS))
    floors = own.groupBy("query_uid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).select(F.col("query_uid").alias("uid"), F.when(F.col("n") >= k, F.col("least")).alias("floor"))
    queries = written(blocks.where(asking).join(floors, "uid", "left"))
    shapes = blocks.select("width", "block", "x").repartition("width", "block").sortWithinPartitions("width", "block").mapInArrow(_envelopes, "width int, block long, low array<double>, high array<double>, norm double")
    listed, ends = ranked(shapes, ["width"], ["block"])
    nth = F.col("at") - F.col("first") + F.col("before")
    grouped = written(listed.withColumn("part", part).join(ends.select("width", "part", "first", "before"), ["width", "part"]).withColumn("group", F.floor(nth / BLOCK)).drop("at", "part", "first", "before"))
    widths = grouped.groupBy("width").agg(F.max("group").alias("last_group"))
    widths = F.broadcast(widths) if widths.count() <= MOST_WIDTHS else widths
    asked = queries.join(widths, "width").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), "last_group"))).drop("last_group")
    pairs = streamed(grouped, asked, ["width", "group"], _candidates, ASKED)
    rest = streamed(blocks, queries.drop("block").join(pairs, "uid"), ["width", "block"], _search(k), HITS)
    out = best_hits(own.unionByName(rest), k).select(F.col("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return out


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: vec_ids that 50 divides."""
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP12_SQL = """
with v as (select row_number() over () as uid, vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as x from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.uid as quid, q.vec_id as query_id, c.vec_id, c.uid, list_inner_product(q.x, c.x)::bigint as score from v q join v c on q.uid <> c.uid and len(q.x) = len(c.x) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by quid order by score desc, vec_id nulls last, uid) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""
