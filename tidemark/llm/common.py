"""Helpers that the training-data operators share.

Words are maximal runs of ``[0-9a-z]`` and of characters beyond ASCII, after lower-casing A-Z only.
The Python side works on Arrow buffers with numpy: a slice of at most ``SLICE_BYTES`` of text (or one
document, if that is longer) is in memory at a time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
#: A key is hot if it holds at least this share of the rows (and ``LEAST_HOT`` of them), so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 65_536
LEAST_HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``. Where it names none, a local session gets a temporary folder
    of this application; on a cluster that is an error, as each executor would write to a disk of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOTS:
        _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="spark-")
    return _OWN_ROOTS[app]


def written(df: DataFrame) -> DataFrame:
    """The rows from a table written to the shared folder: the lineage ends here, and a lost executor costs no more than a reread."""
    path = f"{scratch_root(df.sparkSession)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete the folders of ``written`` tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "__dict__", {}).get("scratch")
        if path:
            jvm = t.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def row_struct(docs: DataFrame) -> Column:
    """The whole row as one value, so that no column of the caller meets one of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def join_hot(big: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``big`` with ``groups`` (one row for each key, with the number ``size`` of its rows in ``big``).

    Keys that hold ``HOT_SHARE`` of the ``total`` rows or more number at most ``1 / HOT_SHARE``: they are broadcast, so that no
    task gets all rows of one. The others (of 1e11 rows, 1.5 million at most) meet in a shuffle join. ``how`` is inner or left; null keys match nothing.
    """
    least = max(LEAST_HOT, total * HOT_SHARE)
    hot = groups.where(F.col(size) >= least)
    cold = groups.where(F.col(size) < least)
    marked = big.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return big.join(F.broadcast(hot), keys, "inner").unionByName(marked)


def crowded(rows: DataFrame, keys: list[str], total: int, piece: int = LEAST_HOT) -> DataFrame:
    """(keys, pieces) of the keys that are to be split into pieces of ``piece`` rows: at most 1 / HOT_SHARE of them, so that they may be broadcast."""
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= max(piece, total * HOT_SHARE))
    return held.select(*keys, F.ceil(F.col("held") / piece).cast("int").alias("pieces"))


def join_pieces(many: DataFrame, one: DataFrame, keys: list[str], split: DataFrame, spread: Column) -> DataFrame:
    """Inner join on ``keys``, where the rows of ``many`` with a key in ``split`` are dealt over its pieces by the hash ``spread``, and
    the rows of ``one`` with such a key are repeated for each piece."""
    dealt = many.join(F.broadcast(split), keys, "left").withColumn("piece", F.coalesce(F.pmod(spread, F.col("pieces").cast("long")).cast("int"), F.lit(0))).drop("pieces")
    copies = one.join(F.broadcast(split), keys, "left").withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))).drop("pieces")
    return dealt.join(copies, [*keys, "piece"]).drop("piece")


# ---- Arrow and numpy side ------------------------------------------------------------------------

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[0x41:0x5B] += 32
FALSE = np.zeros(1, bool)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _STEP)]))


_POWERS = powers(256)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (from 0); a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(column) and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of few bytes of text each; a single document is never cut."""
    for batch in batches:
        _, offsets = text_buffers(batch.column(column))
        lo = 0
        while lo < len(batch):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


class Words:
    """The words of a column: 64-bit ``hash`` and byte ``start`` and ``end`` of each, ``first`` word of each row (one more at the end)."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = text_buffers(column)
        data = TO_LOWER[data]
        inside = WORD_BYTE[data]
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        fresh, last = inside.copy(), inside.copy()
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        before = np.concatenate([FALSE, inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], FALSE]) if len(inside) else inside
        before[cuts] = False
        after[cuts - 1] = False
        fresh &= ~before
        last &= ~after
        self.start = np.flatnonzero(fresh)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        at = np.flatnonzero(inside)
        size = self.end - self.start
        if len(at):
            heads = np.cumsum(size) - size
            place = np.arange(len(at)) - np.repeat(heads, size)
            most = int(size.max())
            values = BYTE_CODE[data[at]] * (_POWERS if most <= len(_POWERS) else powers(most))[place]
            self.hash = mix(np.add.reduceat(values, heads) + size.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.count)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and their rows; a shorter row that is not empty has one, of all its words."""
    n = len(words.hash)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row, left = words.row_of(), np.repeat(words.first[1:], words.count) - np.arange(n)
    out = np.zeros(n, np.uint64)
    for k in range(width):  # beyond the row's end nothing is added
        part = np.zeros(n, np.uint64)
        part[: n - k] = words.hash[k:]
        part[left <= k] = 0
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1))
    at_head = np.arange(n) == np.repeat(words.first[:-1], words.count)
    keep = (left >= width) | at_head
    return out[keep], row[keep]


def row_digest(words: Words) -> list[str]:
    """128 bits, as hex, of each row's sequence of words."""
    n, first, count = len(words.hash), words.first[:-1], words.count
    out = np.zeros((words.rows, 2), np.uint64)
    if n:
        place = (np.arange(n) - np.repeat(first, count)).astype(np.uint64)
        full = np.flatnonzero(count)
        for k, salt in enumerate((0x8CB92BA72F3D8DD7, 0xA0761D6478BD642F)):
            v = mix(words.hash * np.uint64(salt) + mix((place + np.uint64(1)) * np.uint64(0xE7037ED1A0B428DB)))
            out[full, k] = mix(np.add.reduceat(v, first[full]) + count[full].astype(np.uint64))
    raw = out.astype(">u8").tobytes()
    return [raw[16 * i : 16 * i + 16].hex() for i in range(words.rows)]
