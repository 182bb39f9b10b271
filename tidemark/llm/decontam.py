"""Benchmark decontamination by a distributed positional inverted index.

Test items become windows of ten consecutive words. One pass over the corpus counts the test terms; the corpus frequencies
choose each window's rarest terms as its anchors (a window with a term that the corpus lacks cannot occur). A second
pass stores the postings (term, document, position) of all anchor terms: this is the stored
index. Phrase matches are the documents and offset-adjusted positions that all of a window's anchor lists share; proximity matches start from
the documents and positions where its anchors stand near each other. The remaining words are then compared in the documents that are left.

Words and windows are equal if their 64-bit hashes are. A document is known in the index by a hash of doc_id and text; what is found
for one is compared with the row's own words, so that a clash costs time and changes nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import HOT_SHARE, Words, discard, join_hot, join_pieces, mix, row_struct, sliced, written

WINDOW = 10
#: A proximity match has all words of a window, each as often as the window has it, in so many consecutive words.
SPAN = 15
#: Test terms go to the tasks as 8-byte hashes, so many at a time; more terms take more passes.
BLOCK = 4_000_000
POSTINGS_A_PIECE = 200_000
GOLD, STEP = np.uint64(0x9E3779B97F4A7C15), 0xD1B54A32D192ED03


def window_hash(terms: np.ndarray) -> np.ndarray:
    """Of each row of word hashes (all of one width)."""
    out = np.full(len(terms), terms.shape[1] * STEP % 2**64, np.uint64)
    for k in range(terms.shape[1]):
        out = mix(out * GOLD + terms[:, k].astype(np.uint64))
    return out.view(np.int64)


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(hashes, width)


def item_windows(width: int):
    """Each item's windows: item_id, the window's hash and its word hashes; an item of fewer words, but not none, is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words = Words(batch.column("text"))
            ids = batch.column("item_id")
            for i in range(words.rows):
                own = words.hash[words.first[i] : words.first[i + 1]]
                if len(own):
                    parts = runs(own, min(width, len(own)))
                    ends = pa.array(np.arange(len(parts) + 1) * parts.shape[1], pa.int32())
                    terms = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(parts).reshape(-1).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i].as_py()] * len(parts), pa.int64()), pa.array(window_hash(parts)), terms], ["item_id", "window", "terms"])

    return run


def term_counts(vocabulary):
    """(term, n) of each task for terms in the broadcast, sorted ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total = vocabulary.value, np.zeros(len(vocabulary.value), np.int64)
        for batch in sliced(batches):
            h = Words(batch.column("text")).hash.view(np.int64)
            at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
            total += np.bincount(at[terms[at] == h], minlength=len(terms))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms[some]), pa.array(total[some])], ["term", "n"])

    return run


def posting_rows(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = vocabulary.value
        for batch in sliced(batches):
            words = Words(batch.column("text"))
            h = words.hash.view(np.int64)
            at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
            hit = np.flatnonzero(terms[at] == h)
            row = words.row_of()[hit]
            keys = np.asarray(batch.column("key"))[row]
            yield pa.RecordBatch.from_arrays([pa.array(h[hit]), pa.array(keys), pa.array(hit - words.first[row])], ["term", "key", "pos"])

    return run


def phrase_hits(own: np.ndarray, found: list[dict]) -> tuple[np.ndarray, set[int]]:
    """Words of one document that an occurrence of a candidate window covers, and the windows that occur."""
    hit, seen = np.zeros(len(own), bool), set()
    at = np.array([(s, c["width"], c["window"]) for c in found for s in c["starts"]], np.int64).reshape(-1, 3)
    for width in np.unique(at[:, 1]):
        part = at[(at[:, 1] == width) & (at[:, 0] <= len(own) - width)]
        if len(part):
            same = part[window_hash(runs(own, int(width))[part[:, 0]]) == part[:, 2]]
            for k in range(int(width)):
                hit[same[:, 0] + k] = True
            seen.update(same[:, 2].tolist())
    return hit, seen


def near(own: np.ndarray, pos: int, need: Counter, span: int) -> bool:
    """Whether ``span`` consecutive words around ``pos`` have all of ``need``."""
    lo, hi = max(0, pos - span + 1), min(len(own), pos + span)
    around, left = own[lo:hi].tolist(), need.copy()
    missing = len(left)
    for k, w in enumerate(around):
        if w in left:
            left[w] -= 1
            missing -= left[w] == 0
        if k >= span and (old := around[k - span]) in left:
            missing += left[old] == 0
            left[old] += 1
        if not missing:
            return True
    return False


def judged_rows(span: int):
    """n_words, n_hit, windows that occur and windows with a proximity match of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words = Words(batch.column("text"))
            h, found = words.hash.view(np.int64), batch.column("found")
            n_hit, windows, nears = [], [], []
            for i in range(words.rows):
                own, asked = h[words.first[i] : words.first[i + 1]], found[i].as_py() or []
                hit, seen = phrase_hits(own.view(np.uint64), asked)
                n_hit.append(int(hit.sum()))
                windows.append(sorted(seen))
                # A phrase is a proximity match; other windows are looked for around the places of their rarest word.
                nears.append(sorted(c["window"] for c in asked if c["window"] in seen or any(near(own, p, need, span) for need in [Counter(c["terms"])] for p in c["places"])))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(words.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(windows, kind), pa.array(nears, kind)], ["doc_id", "key", "n_words", "n_hit", "windows", "nears"])

    return run


def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without an occurrence of a window."""
    for batch in batches:
        flat = pa.RecordBatch.from_arrays([batch.column("row"), batch.column("row").field("text"), batch.column("found")], ["row", "text", "found"])
        for part in sliced(iter([flat])):
            asked = np.flatnonzero(np.asarray(part.column("found").is_valid()))
            keep = np.ones(len(part), bool)
            if len(asked):
                some = part.take(pa.array(asked))
                words = Words(some.column("text"))
                for k, i in enumerate(asked):
                    keep[i] = not phrase_hits(words.hash[words.first[k] : words.first[k + 1]], some.column("found")[k].as_py())[1]
            yield pa.RecordBatch.from_arrays([part.column("row").filter(pa.array(keep))], ["row"])


def blocks(terms: DataFrame, most: int | None = None) -> Iterator[np.ndarray]:
    """Distinct test terms on the driver, sorted, about ``most`` at a time (dealt by their hash)."""
    parts = max(1, -(-terms.count() // (most or BLOCK)))
    for k in range(parts):
        block = terms.where(F.pmod("term", F.lit(parts)) == k).toPandas()["term"].to_numpy(np.int64)
        if len(block):
            yield np.sort(block)


def over_blocks(docs: DataFrame, terms: DataFrame, rows, shape: str) -> DataFrame | None:
    """``docs`` mapped by ``rows(broadcast block)`` for each block of terms."""
    out = None
    for block in blocks(terms):
        part = docs.mapInArrow(rows(docs.sparkSession.sparkContext.broadcast(block)), shape)
        out = part if out is None else out.unionByName(part)
    return out


def windows_of(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows: window (its content's hash), terms, items (a null item_id is none)."""
    raw = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(item_windows(width), "item_id long, window long, terms array<bigint>")
    return raw.groupBy("window").agg(F.first("terms").alias("terms"), F.collect_set("item_id").alias("items"))


def anchors_of(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """(window, width, term, offset, term2, offset2): each window's two rarest words by corpus frequency (one, if it has no more); none for a window with an absent word."""
    spread = windows.select("window", F.size("terms").alias("width"), F.posexplode("terms").alias("offset", "term"))
    rank = F.row_number().over(Window.partitionBy("window").orderBy("n", "offset"))
    known = spread.join(frequency, "term").withColumn("rank", rank)

    def of_rank(name: str, k: int) -> Column:
        return F.max(F.when(F.col("rank") == k, F.col(name)))

    plan = known.groupBy("window").agg(F.first("width").alias("width"), F.count(F.lit(1)).alias("seen"), of_rank("term", 1).alias("term"), of_rank("offset", 1).alias("offset"), of_rank("term", 2).alias("term2"), of_rank("offset", 2).alias("offset2"))
    return plan.where("seen = width").drop("seen")


def intersected(postings: DataFrame, anchors: DataFrame, split: DataFrame, span: int) -> DataFrame:
    """(key, window, width, start, pos, exact): places ``pos`` of each window's rarest word that have the other anchor less than ``span`` words away in the document.

    ``exact``: the offset-adjusted lists meet, so that the window may start at ``start``. The rarest word's list gives the places and the other list only confirms them, in cells of
    ``span`` positions, so that nothing grows beyond the rarest lists. ``split`` has the terms whose lists are dealt over several tasks.
    """
    first = join_pieces(postings, anchors, ["term"], split, F.xxhash64("key", "pos"))
    places = first.select("key", "window", "width", "pos", (F.col("pos") - F.col("offset")).alias("start"), F.col("term2").alias("term"), (F.col("pos") - F.col("offset") + F.col("offset2")).alias("wanted"))
    lone = places.where("term is null").select("key", "window", "width", "start", "pos", F.lit(True).alias("exact")).distinct()
    cell = F.floor(F.col("pos") / span)
    asked = places.where("term is not null").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    there = postings.select("term", "key", F.col("pos").alias("there"), cell.alias("cell"))
    met = asked.join(there, ["term", "key", "cell"]).where(F.abs(F.col("there") - F.col("pos")) < span)
    return met.groupBy("key", "window", "width", "start", "pos").agg(F.max(F.col("there") == F.col("wanted")).alias("exact")).unionByName(lone)


def document_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


class PositionalIndex:
    """The windows of ``items``, their anchors by the frequencies in ``docs``, and the stored postings of all anchor terms over whole texts."""

    def __init__(self, docs: DataFrame, items: DataFrame, width: int = WINDOW) -> None:
        self.width, self.windows = width, written(windows_of(items, width))
        texts = docs.select("text")
        counts = over_blocks(texts, self.windows.select(F.explode("terms").alias("term")).distinct(), term_counts, "term long, n long")
        self.anchors = self.postings = self.split = None
        if counts is None:
            return
        frequency = written(counts.groupBy("term").agg(F.sum("n").alias("n")))
        self.anchors = written(anchors_of(self.windows, frequency))
        terms = self.anchors.select(F.explode(F.array_compact(F.array("term", "term2"))).alias("term")).distinct()
        postings = over_blocks(docs.select(document_key().alias("key"), "text"), terms, posting_rows, "term long, key long, pos long")
        if postings is not None:
            self.postings = written(postings)
            listed = frequency.join(terms, "term", "left_semi")
            total = listed.agg(F.sum("n")).first()[0] or 0
            long = listed.where(F.col("n") >= max(POSTINGS_A_PIECE, total * HOT_SHARE))
            self.split = written(long.select("term", F.ceil(F.col("n") / POSTINGS_A_PIECE).cast("int").alias("pieces")))
        discard(frequency)

    def candidates(self, span: int | None) -> DataFrame:
        """(key, found): for each document the windows that may occur in it: starts of possible phrases, and with ``span`` also the places of the rarest word for
        proximity, with the window's words."""
        places = intersected(self.postings, self.anchors, self.split, max(span or 0, self.width))
        starts = F.collect_set(F.when(F.col("exact") & (F.col("start") >= 0), F.col("start"))).alias("starts")
        if span is None:
            each = places.where("exact").groupBy("key", "window", "width").agg(starts)
            return each.groupBy("key").agg(F.collect_list(F.struct("window", "width", "starts")).alias("found"))
        each = places.groupBy("key", "window", "width").agg(starts, F.collect_set("pos").alias("places"))
        return each.join(self.windows.select("window", "terms"), "window").groupBy("key").agg(F.collect_list(F.struct("window", "width", "starts", "places", "terms")).alias("found"))

    def discard(self) -> None:
        discard(self.anchors, self.postings, self.split)


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, span: int = SPAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    n_near_items counts the items with a window all of whose words, each as often as the window has it, stand in ``span`` consecutive words in any order.
    Null and empty texts have no words; a null item_id counts as no item but its words hit. Items with equal windows all count.
    Repeated rows, rows that share a doc_id and rows with a null doc_id are judged each on its own text. Empty tables give no rows, or no hits.
    """
    index = PositionalIndex(docs, items, width)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", document_key().alias("key"))
    if index.postings is None:
        shape = "array<struct<window:bigint,width:int,starts:array<bigint>,places:array<bigint>,terms:array<bigint>>>"
        joined = rows.withColumn("found", F.lit(None).cast(shape))
    else:
        joined = rows.join(index.candidates(span), "key", "left")
    shape = "doc_id long, key long, n_words long, n_hit long, windows array<bigint>, nears array<bigint>"
    judged = written(joined.select("doc_id", "key", "text", "found").mapInArrow(judged_rows(span), shape))
    index.discard()
    # Items come in once the windows are certain.
    held = written(judged.select("doc_id", "key", F.explode(F.concat(F.transform("windows", lambda w: F.struct(w.alias("window"), F.lit(True).alias("exact"))), F.transform("nears", lambda w: F.struct(w.alias("window"), F.lit(False).alias("exact"))))).alias("w")).select("doc_id", "key", "w.window", "w.exact").distinct())
    size = held.groupBy("window").agg(F.count(F.lit(1)).alias("held")).join(index.windows.select("window", "items"), "window")
    listed = join_hot(held, size, ["window"], "held", held.count()).select("doc_id", "key", "exact", F.explode("items").alias("item"))
    sums = listed.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item").cast("string")))).alias("items"), F.countDistinct(F.when(~F.col("exact"), F.col("item"))).alias("n_near_items"))
    sums = sums.withColumnsRenamed({"doc_id": "of_id", "key": "of_key"})
    out = judged.join(sums, (F.col("key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.encode(F.array_join(ids, ","), "UTF-8"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged on its own text (see ``contamination``); all columns."""
    index = PositionalIndex(docs, items)
    if index.postings is None:
        return docs
    found = written(index.candidates(None))
    index.discard()
    rows = docs.select(row_struct(docs).alias("row"), document_key().alias("key"))
    joined = rows.join(found, "key", "left").select("row", "found")
    shape = StructType([joined.schema["row"]])
    return joined.mapInArrow(clean_rows, shape).select("row.*")
