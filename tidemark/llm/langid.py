"""Language identification by multilingual mixtures.

A model holds, for each language, the log probability of hashed byte trigrams inside words (Unicode lower case; a
word is a run of a-z and characters beyond ASCII). A document's words are a mixture: expectation-maximisation estimates the
languages' proportions from the words' likelihoods, and the set of languages is the one of the largest
``log-likelihood - penalty * ln(words) * (languages - 1)`` among the best single language and the sets of the 2, 3, ... most present languages of the
mixture of all. Larger sets are tried as long as they can win: the log-likelihood is concave in the proportions, so its gradient bounds what any mixture can reach.

The model is counted over all given rows by a partial sum in each task and a sum by (language, trigram); what reaches the driver
is one table of ``TABLE`` 4-byte numbers for each language, however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FALSE, SLICE_BYTES, discard, row_struct, sliced, table, text_buffers, written

TABLE = 1 << 16
#: A model of so many languages is 256 MB in every task; labels of more kinds are refused, not cut.
MOST_LANGUAGES = 1024
#: Likelihoods (letters x languages, 4 bytes) that are in memory at a time: fewer texts at once for many languages, and a text beyond it in pieces.
MOST_LIKELIHOODS = 1 << 24
#: Languages that a task counts side by side before it hands its counts on.
COUNTED = 64
SMOOTH = 0.5
PENALTY = 2.0
#: Expectation-maximisation of a document ends when no proportion moves by more.
TOLERANCE = 1e-4
TINY = 1e-30
LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = LETTER[0x80:] = True


class Grams:
    """Trigram slots of a column: ``slot`` for each letter byte; ``head`` of each word in it; ``first`` word of each row (one more at the end)."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = text_buffers(pc.utf8_lower(column))
        inside = LETTER[data]
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before = np.concatenate([FALSE, inside[:-1]])[:n] & ~cut[:n]
        after = np.concatenate([inside[1:], FALSE])[:n] & ~cut[1:]
        code = data.astype(np.uint32) + 1
        left, right = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        left[1:], right[:-1] = code[:-1], code[1:]
        left[~before], right[~after] = 0, 0
        slot = (left * np.uint32(0x9E3779B1)) ^ (code * np.uint32(0x85EBCA77)) ^ (right * np.uint32(0xC2B2AE3D))
        slot ^= slot >> np.uint32(15)
        slot *= np.uint32(0x2C1B3C6D)
        self.slot = (slot >> np.uint32(16))[inside].astype(np.int64)
        fresh = inside & ~before
        start = np.flatnonzero(fresh)
        self.head = np.flatnonzero(fresh[inside])
        self.first = np.searchsorted(start, offsets)
        self.letters = np.diff(np.searchsorted(np.flatnonzero(inside), offsets))
        self.rows = len(offsets) - 1


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for name, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], ["lang", "slot", "n"])
        total.clear()

    for batch in sliced(batches):
        grams = Grams(batch.column("text"))
        codes, names = pd_factor(batch.column("lang"))
        both, n = np.unique(np.repeat(codes, grams.letters) * TABLE + grams.slot, return_counts=True)
        edges = np.searchsorted(both, np.arange(len(names) + 1) * TABLE)
        for k, name in enumerate(names):
            if name not in total:
                if len(total) >= COUNTED:
                    yield from told()
                total[name] = np.zeros(TABLE, np.int64)
            total[name][both[edges[k] : edges[k + 1]] - k * TABLE] += n[edges[k] : edges[k + 1]]
    yield from told()


def pd_factor(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()


class Model:
    def __init__(self, languages: list[str], log_p: np.ndarray) -> None:
        self.languages, self.log_p = languages, log_p  # log_p: TABLE x languages


def language_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each language's log probabilities of all slots, from its list of counted ones."""
    for batch in batches:
        packed = []
        for entries in batch.column("entries"):
            flat = entries.values
            dense = np.full(TABLE, SMOOTH)
            dense[np.asarray(flat.field("slot"))] += np.asarray(flat.field("n"))
            packed.append(np.log(dense / dense.sum()).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(packed, pa.binary())], ["lang", "log_p"])


def fit(labelled: DataFrame) -> Model | None:
    """From rows with text and lang; rows with a null in either are left out. None if nothing is left."""
    usable = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = written(usable.mapInArrow(gram_counts, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    if counts.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    entries = counts.groupBy("lang").agg(F.collect_list(F.struct("slot", "n")).alias("entries"))  # at most TABLE
    found = sorted((r["lang"], bytes(r["log_p"])) for r in entries.mapInArrow(language_tables, "lang string, log_p binary").collect())
    discard(counts)
    if not found:
        return None
    return Model([lang for lang, _ in found], np.ascontiguousarray(np.stack([np.frombuffer(b, np.float32) for _, b in found], axis=1)))


def by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the words' values for rows that all have words."""
    return np.add.reduceat(values, first, axis=0)


def of_rows(values: np.ndarray, count: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, counts and first words of the rows that ``keep`` marks."""
    left = count[keep]
    return values[np.repeat(keep, count)], left, np.cumsum(left) - left


def mixture(likelihood: np.ndarray, first: np.ndarray, count: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions by EM, log-likelihoods (less the words' maxima), and a bound that no mixture of the ``allowed`` languages (rows x languages) exceeds.

    Each round raises the log-likelihood by at least words * (greatest change)^2 / 2, so the rounds end.
    """
    share = (allowed / allowed.sum(1, keepdims=True)).astype(np.float64)
    live, words, n, at = np.arange(len(count)), likelihood, count, first
    while len(live):
        part = words * np.repeat(share[live], n, axis=0).astype(np.float32)
        part /= np.maximum(part.sum(1, keepdims=True), TINY)
        new = by_row(part.astype(np.float64), at) / n[:, None]
        moving = np.abs(new - share[live]).max(1) > TOLERANCE
        share[live] = new
        if not moving.all():
            live = live[moving]
            words, n, at = of_rows(words, n, moving)
    mixed = np.maximum((likelihood * np.repeat(share, count, axis=0)).sum(1), TINY)
    value = by_row(np.log(mixed), first)
    steepest = np.where(allowed > 0, by_row(likelihood / mixed[:, None], first), 0).max(1)
    return share, value, value + steepest - count


def language_sets(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Proportions (rows x languages) of the best set for each row; ``words``: log-likelihoods less each word's maximum."""
    width = words.shape[1]
    single = by_row(words.astype(np.float64), first)
    best, value = np.zeros((len(count), width)), single.max(1)
    best[np.arange(len(count)), single.argmax(1)] = 1
    penalty = PENALTY * np.log(np.maximum(count, 2))
    open_ = value < -penalty  # no mixture has a log-likelihood above 0
    if width < 2 or not open_.any():
        return best
    rows = np.flatnonzero(open_)
    likelihood, n, at = of_rows(np.exp(words), count, open_)
    spread, top, bound = mixture(likelihood, at, n, np.ones((len(rows), width), np.float32))
    order = np.argsort(-spread, axis=1, kind="stable")
    for k in range(2, width + 1):
        able = bound - penalty[rows] * (k - 1) > value[rows]
        if not able.any():
            break
        rows, order, spread, top, bound = rows[able], order[able], spread[able], top[able], bound[able]
        likelihood, n, at = of_rows(likelihood, n, able)
        own, reached = spread, top
        if k < width:
            allowed = np.zeros((len(rows), width), np.float32)
            np.put_along_axis(allowed, order[:, :k], 1, 1)
            own, reached, _ = mixture(likelihood, at, n, allowed)
        reached = reached - penalty[rows] * (k - 1)
        win = reached > value[rows]
        best[rows[win]], value[rows[win]] = own[win], reached[win]
    return best


class LongText:
    """The words of one text whose likelihoods do not fit at once: computed piece by piece, anew in each pass."""

    def __init__(self, model: Model, slot: np.ndarray, head: np.ndarray) -> None:
        self.log_p, self.slot, self.count = model.log_p, slot, len(head)
        room = max(1, MOST_LIKELIHOODS // max(1, model.log_p.shape[1]))
        ends, cuts = np.append(head[1:], len(slot)), [0]
        while cuts[-1] < len(head):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, head[cuts[-1]] + room, "right"))))
        self.pieces = [(head[lo:hi], int(ends[hi - 1])) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        self.room = room

    def words(self) -> Iterator[np.ndarray]:
        """Log-likelihoods of words, less each word's maximum; a word longer than a piece is summed up part by part."""
        for head, end in self.pieces:
            first = int(head[0])
            if len(head) == 1 and end - first > self.room:
                out = np.sum([self.log_p[self.slot[at : min(at + self.room, end)]].sum(axis=0, dtype=np.float64) for at in range(first, end, self.room)], axis=0)[None].astype(np.float32)
            else:
                out = np.add.reduceat(self.log_p[self.slot[first:end]], head - first, axis=0)
            yield out - out.max(1, keepdims=True)

    def mixture(self, allowed: np.ndarray) -> tuple[np.ndarray, float, float]:
        """As ``mixture``, for this text."""
        share, moving = allowed / allowed.sum(), True
        while moving:
            new = np.zeros(len(share))
            for w in self.words():
                part = np.exp(w) * share.astype(np.float32)
                part /= np.maximum(part.sum(1, keepdims=True), TINY)
                new += part.sum(axis=0, dtype=np.float64)
            new /= self.count
            share, moving = new, np.abs(new - share).max() > TOLERANCE
        value, slope = 0.0, np.zeros(len(share))
        for w in self.words():
            likelihood = np.exp(w)
            mixed = np.maximum((likelihood * share).sum(1), TINY)
            value += np.log(mixed).sum()
            slope += (likelihood / mixed[:, None]).sum(0)
        return share, value, value + np.where(allowed > 0, slope, 0).max() - self.count

    def best_set(self) -> np.ndarray:
        """As ``language_sets``, for this text."""
        single = np.sum([w.sum(axis=0, dtype=np.float64) for w in self.words()], axis=0)
        width, value = len(single), single.max()
        best, penalty = np.eye(width)[single.argmax()], PENALTY * np.log(max(self.count, 2))
        if width < 2 or value >= -penalty:
            return best
        spread, top, bound = self.mixture(np.ones(width))
        order = np.argsort(-spread, kind="stable")
        for k in range(2, width + 1):
            if bound - penalty * (k - 1) <= value:
                break
            own, reached = spread, top
            if k < width:
                allowed = np.zeros(width)
                allowed[order[:k]] = 1
                own, reached, _ = self.mixture(allowed)
            if reached - penalty * (k - 1) > value:
                best, value = own, reached - penalty * (k - 1)
        return best


def predict_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        langs, width = np.array(m.languages, object), len(m.languages)
        for batch in sliced(batches, limit=max(1, min(SLICE_BYTES, MOST_LIKELIHOODS // width))):
            column = batch.column("text")
            grams = Grams(column)
            count = np.diff(grams.first)
            full = np.flatnonzero(count)
            share = np.zeros((grams.rows, width))
            if len(grams.slot) * width > MOST_LIKELIHOODS:  # then it is one text
                share[full] = LongText(m, grams.slot, grams.head).best_set()
            elif len(full):
                words = np.add.reduceat(m.log_p[grams.slot], grams.head, axis=0)
                words -= words.max(1, keepdims=True)
                best = language_sets(words, grams.first[:-1][full], count[full])
                share[full] = best
            lang = langs[share.argmax(1)].astype(object)
            score = share.max(1)
            bare = np.flatnonzero(grams.letters == 0).tolist()
            odd = [i for i in np.flatnonzero((grams.letters > 0) & (ascii_letters(column) == 0)) if not any(c.isalpha() for c in column[int(i)].as_py())]
            lang[bare + odd], score[bare + odd] = "und", 0.0
            mix = [";".join(f"{langs[j]}:{row[j]:.4f}" for j in np.flatnonzero(row)) if name != "und" else None for row, name in zip(share, lang, strict=True)]
            keep = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(mix, pa.string())], [*names, "lang_pred", "score", "mixture"])

    return run


def ascii_letters(column: pa.Array) -> np.ndarray:
    data, offsets = text_buffers(column)
    some = np.concatenate([[0], np.cumsum(((data | 32) >= 0x61) & ((data | 32) <= 0x7A))])
    return some[offsets[1:]] - some[offsets[:-1]]


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred, score (the winner's share of the words) and mixture (``lang:share;...``).

    Null text or text without a letter: ``und``, 0, null; so is every text if there is no model. A letter outside every learned word gets
    the smoothed likelihoods and so a learned language. Repeated rows get equal predictions.
    """
    if model is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("mixture"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, "text").mapInArrow(predict_rows(sent), f"{shape}, lang_pred string, score double, mixture string")


def held_out(doc_id):
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, mixture of each row. The model learns from ``labelled`` (``docs`` if not given) without held-out rows
    (crc32 of doc_id as text mod 4 is 2); a null doc_id is not held out and not learned from."""
    source = docs if labelled is None else labelled
    model = fit(source.where(~held_out(F.col("doc_id"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return predict(rows, model, ["doc_id", "held_out"])


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose text is ``und``."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select(row_struct(docs).alias("row"), "text")
    return predict(rows, model, ["row"]).where("lang_pred <> 'und'").select("row.*")


def op5_language_mixture(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
