"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded from its bytes and words (character classes, word lengths,
repetition, hashed words) and mapped to a hidden layer; gated attention (tanh times sigmoid) weighs the passages, and the weighted sum is scored.
All weights are learned together from document labels, on a bounded sample of ``SAMPLE`` labelled rows (the smallest hashes), in one task;
every document is scored whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BYTE_CODE, Words, mix, sliced, table, text_buffers

PASSAGE = 80
SAMPLE = 6000
HASHED = 64
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 60, 256, 0.01, 1e-4
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:", b"!?", b"#$%&*", b"|", b"@", b"()[]{}<>", b"\"'", b"-_=+/\\~^`"]
CLASS_OF = np.full(256, len(CLASSES), np.int64)
for _k, _chars in enumerate(CLASSES):
    CLASS_OF[list(_chars)] = _k
STYLE = len(CLASSES) + 1 + 7
WIDTH = STYLE + HASHED


class Passages:
    """Passages of each row and their features; a row without words is one passage of all its bytes."""

    def __init__(self, column: pa.Array) -> None:
        words = Words(column)
        raw, offsets = text_buffers(column)
        count = np.maximum(1, -(-words.count // PASSAGE))
        self.first = np.cumsum(count) - count
        self.count, n = count, int(count.sum())
        row = np.repeat(np.arange(words.rows), count)
        nth = np.arange(n) - self.first[row]
        w0 = words.first[:-1][row] + nth * PASSAGE
        b0 = np.where(nth == 0, offsets[:-1][row], words.start[np.minimum(w0, max(len(words.start) - 1, 0))] if len(words.start) else 0)
        of_byte = np.repeat(np.arange(n), np.diff(np.append(b0, len(raw))))
        size = np.maximum(np.bincount(of_byte, minlength=n), 1)
        kinds = np.bincount(of_byte * (len(CLASSES) + 1) + CLASS_OF[raw], minlength=n * (len(CLASSES) + 1)).reshape(n, -1)
        out = np.zeros((n, WIDTH))
        out[:, : len(CLASSES) + 1] = np.sqrt(kinds / size[:, None])
        k = len(CLASSES) + 1
        if len(words.hash):
            of_word = np.searchsorted(w0, np.arange(len(words.hash)), "right") - 1
            length = words.end - words.start
            many = np.maximum(np.bincount(of_word, minlength=n), 1)
            mean = np.bincount(of_word, length, n) / many
            out[:, k], out[:, k + 1] = mean / 10, np.sqrt(np.maximum(np.bincount(of_word, length * length, n) / many - mean**2, 0)) / 10
            owner = words.row_of()
            pair = words.hash.copy()
            pair[:-1] = mix(pair[:-1] * BYTE_CODE[7] + words.hash[1:])
            for j, value in enumerate((words.hash, pair)):
                key = mix(value + (owner.astype(np.uint64) + np.uint64(1)) * BYTE_CODE[11])
                _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
                out[:, k + 2 + j] = np.bincount(of_word, times[inverse] > 1, n) / many
                out[:, k + 4 + j] = np.log1p(np.bincount(of_word, times[inverse], n) / many) / 5
            out[:, k + 6] = np.log1p(words.count)[row] / 10
            slot = (words.hash % np.uint64(HASHED)).astype(np.int64)
            sign = np.where(words.hash >> np.uint64(63), 1.0, -1.0)
            out[:, STYLE:] = np.bincount(of_word * HASHED + slot, sign, n * HASHED).reshape(n, HASHED) / np.sqrt(many)[:, None] / 2
        self.features = out


def forward(p: dict, x: np.ndarray, first: np.ndarray, count: np.ndarray) -> dict:
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (t * s) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), count))
    a = e / np.repeat(np.add.reduceat(e, first), count)
    z = np.add.reduceat(h * a[:, None], first, axis=0)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}


def gradients(p: dict, x: np.ndarray, first: np.ndarray, count: np.ndarray, y: np.ndarray) -> dict:
    f = forward(p, x, first, count)
    g = (f["score"] - y) / len(y)
    dz = g[:, None] * p["c"]
    dz_each = np.repeat(dz, count, axis=0)
    dh = dz_each * f["a"][:, None]
    da = (dz_each * f["h"]).sum(1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(da * f["a"], first), count))
    gate = de[:, None] * p["w"]
    dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
    dh += dt @ p["V"].T + ds @ p["U"].T
    dh *= 1 - f["h"] ** 2
    return {"W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ g, "d": g.sum(keepdims=True)}


def train(features: np.ndarray, count: np.ndarray, label: np.ndarray, seed: int = 3) -> dict:
    """Adam on the mean log loss with weight decay; bags are shuffled with a fixed seed."""
    rng = np.random.default_rng(seed)
    mean, scale = features.mean(0), features.std(0) + 1e-3
    shapes = {"W": (WIDTH, HIDDEN), "b": HIDDEN, "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": GATE, "c": HIDDEN, "d": 1}
    p = {k: rng.normal(0, 0.2, v) if k not in "bd" else np.zeros(v) for k, v in shapes.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    x, start = (features - mean) / scale, np.cumsum(count) - count
    for epoch in range(EPOCHS):
        order = rng.permutation(len(count))
        for lo in range(0, len(order), BATCH):
            bags = order[lo : lo + BATCH]
            n = count[bags]
            first = np.cumsum(n) - n
            at = np.repeat(start[bags] - first, n) + np.arange(n.sum())
            step += 1
            for k, g in gradients(p, x[at], first, n, label[bags]).items():
                g = g + DECAY * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (1 - epoch / EPOCHS) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        bags = Passages(batch.column("text"))
        flat = bags.features.astype(np.float32)
        ends = np.append(bags.first, len(flat))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())], ["doc_id", "quality", "bag"])


def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The whole sample in one task: its size is a parameter, not the corpus's."""
    rows = pd.concat([b for b in batches if len(b)] or [pd.DataFrame({"doc_id": [], "quality": [], "bag": []})]).sort_values(["doc_id", "quality"], kind="stable")
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows["bag"]]
    label = rows["quality"].to_numpy(np.float64)
    if len(bags) and label.min() != label.max():
        yield pd.DataFrame({"model": [pickle.dumps(train(np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags]), label))]})


def held_out(doc_id):
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """Learn from at most ``sample`` labelled rows that are not held out; None without rows of both labels."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    bags = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").mapInArrow(encoded_rows, "doc_id long, quality int, bag binary")
    found = bags.repartition(1).mapInPandas(trained, "model binary").collect()  # one row of fixed size
    return pickle.loads(bytes(found[0]["model"])) if found else None


def score_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value
        for batch in sliced(batches):
            bags = Passages(batch.column("text"))
            score = forward(p, (bags.features - p["mean"]) / p["scale"], bags.first, bags.count)["score"] if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out (crc32 of doc_id as text mod 4 is 2), score (0 to 1, higher is better), predicted (score >= threshold) of each row.

    Null and empty texts are one empty passage and get its score. Without labels of both kinds every score is 0.5. A null doc_id is not held out;
    repeated rows get equal scores; an empty table gives an empty result.
    """
    model = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    if model is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        scored = rows.mapInArrow(score_rows(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_quality_mil(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
