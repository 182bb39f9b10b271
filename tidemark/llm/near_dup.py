"""Near-duplicate detection with BagMinHash signatures (weighted Jaccard of shingle multisets).

A document is the multiset of its runs of five words (one run of all its words, if it has fewer). For each
distinct shingle a Poisson process over (time, weight, slot) is seeded by the shingle alone; its weight axis
is cut into the dyadic intervals (0,1], (1,2], (2,4], ... and each point's place inside an interval comes from
further hash bits, so that a document with count ``w`` sees just the points below ``w``. The earliest point of
each slot is the signature: two documents share it with probability equal to their weighted Jaccard
similarity. The intervals are the right-hand children along the left edge of the binary tree over the weights, and a point's place inside one picks the
leaf below it. Points come in order of time and a process ends as soon as it is later than the latest slot.

Slots are banded; what shares a band is compared by whole multisets (sum of minima over sum of maxima of the counts; shingles are equal if their
64-bit hashes are):

1. in one round (or more), each member with one pivot of the bucket that is in another component: first the node that shares most
   bands with others (the middle of a family), then changing ones; components grow between the rounds,
2. members outside a bucket's largest component with the other components' members, unless sizes or the triangle inequality of
   the Jaccard distances to the pivots already exclude a similarity at the threshold, or an odd sketch of the multisets does: each
   element flips one bit, so two sketches differ in no more bits than the multisets do in elements. The bound is exact; the sketch
   grows with the text, so that it stays sharp.

Step 2 handles what step 1 leaves, so nothing is capped. Equal word sequences are one node from
the start (128-bit digests). Texts without a word are similar to nothing. Components of verified links are the classes.

A row is known by doc_id and the MD5 of its text, so rows that share a doc_id are judged each by its own text. Rows of a bucket, a family or a node
that are more than a task should hold are dealt over pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import HOT_SHARE, Words, crowded, discard, join_hot, join_pieces, mix, row_digest, row_struct, shingles, sliced, written

SKETCH_BITS = 8192
#: Pairs with their texts, and members of a bucket, that one task compares.
PAIRS_A_PIECE, MEMBERS_A_PIECE = 1000, 2000
G1, G2, G3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class NearDupConfig:
    """24 bands of 5 slots miss a pair of similarity 0.8 with probability 7e-5."""

    width: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 5
    rounds: int = 1

    @property
    def slots(self) -> int:
        return self.bands * self.rows

    @property
    def most_apart(self) -> float:
        """Size of the symmetric difference over the sum of both sizes, at the threshold."""
        return (1 - self.threshold) / (1 + self.threshold)


def counted(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) and their counts."""
    value, row = shingles(words, width)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    head = np.ones(len(value), bool)
    head[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    return value[at], row[at], np.diff(np.append(at, len(value)))


def bag_minhash(value: np.ndarray, row: np.ndarray, count: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """Signatures, ``rows`` x ``slots``; 0 where a row has no shingle."""
    best = np.full(rows * slots, np.inf)
    winner = np.zeros(rows * slots, np.uint64)
    limit = np.full(rows, np.inf)
    parts = []
    level, need = 0, np.ones(len(value), bool)
    while need.any():  # interval (2^(level-1), 2^level]
        low = 0 if level == 0 else 1 << (level - 1)
        at = np.flatnonzero(need)
        parts.append((mix(value[at] + np.uint64(int(G1) * (level + 1) % 2**64)), row[at], count[at] - low, np.full(len(at), max(low, 1))))
        need = count > (1 << level)
        level += 1
    if not parts:
        return winner.reshape(rows, slots)
    seed, owner, inside, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    time, drawn = np.zeros(len(seed)), 0
    while len(seed):
        block = 1 if drawn < 2 else int(np.clip(30_000 // len(seed), 1, 64))
        place = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64)
        x = mix(seed[:, None] + place[None, :] * G2)
        step = -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[:, None]
        step[:, 0] += time
        step = np.cumsum(step, axis=1)
        time = step[:, -1]
        use = step < limit[owner][:, None]
        wide = (width > 1)[:, None] & use
        if wide.any():
            r, c = np.nonzero(wide)
            cell = (mix(x[r, c] + G3) >> np.uint64(32)).astype(np.int64) * width[r] >> 32
            use[r, c] = cell < inside[r]
        r, c = np.nonzero(use)
        if len(r):
            t, p = step[r, c], x[r, c]
            slot = owner[r] * slots + ((mix(p + G1) >> np.uint64(32)).astype(np.int64) * slots >> 32)
            better = t < best[slot]
            t, p, slot = t[better], p[better], slot[better]
            order = np.argsort(-t, kind="stable")  # the earliest is written last
            best[slot[order]], winner[slot[order]] = t[order], p[order]
            touched = np.unique(slot // slots)
            limit[touched] = best.reshape(rows, slots)[touched].max(1)
        live = time < limit[owner]
        seed, owner, inside, width, time = seed[live], owner[live], inside[live], width[live], time[live]
        drawn += block
    return winner.reshape(rows, slots)


def odd_sketch(value: np.ndarray, row: np.ndarray, count: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of 64 bits and their number for each row: bit ``h`` is the parity of the elements (shingle, copy) that hash to it.

    A row has twice as many bits as elements, rounded up to a power of two, from 64 to ``SKETCH_BITS``; the halves of
    a sketch, combined by exclusive or, are the sketch of half the size.
    """
    total = np.bincount(row, count, rows)
    bits = np.exp2(np.ceil(np.log2(np.clip(2 * total, 64, SKETCH_BITS)))).astype(np.int64)
    at = np.repeat(np.arange(len(value)), count)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    place = mix(value[at] + (copy + 1).astype(np.uint64) * G2) & (bits[row[at]] - 1).astype(np.uint64)
    odd = np.bincount((np.cumsum(bits) - bits)[row[at]] + place.astype(np.int64), minlength=int(bits.sum())) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64), bits // 64


def signature_rows(config: NearDupConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, config.bands + 1, dtype=np.uint64))
        for batch in sliced(batches):
            words = Words(batch.column("text"))
            value, row, count = counted(words, config.width)
            total = np.bincount(row, count, words.rows).astype(np.int64)
            sig = bag_minhash(value, row, count, words.rows, config.slots).reshape(words.rows, config.bands, config.rows)
            band = np.zeros((words.rows, config.bands), np.uint64)
            for k in range(config.rows):
                band = mix(band * G1 + sig[:, :, k] + salt[None, :])
            flat = pa.array(band.reshape(-1).view(np.int64))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(words.rows + 1) * config.bands, pa.int32()), flat)
            bits, n_bits = odd_sketch(value, row, count, words.rows)
            sketch = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_bits)]), pa.int32()), pa.array(bits))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("tid"), pa.array(row_digest(words)), pa.array(total), bands, sketch], ["key", "tid", "node", "size", "bands", "sketch"])

    return run


def overlap_rows(config: NearDupConfig):
    """Exact similarity of each pair's texts, where they are still the texts of these nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in sliced(batches, "text_u"):
            for batch in sliced(iter([wide]), "text_v"):
                sides, nodes, sizes = [], [], []
                for side in ("u", "v"):
                    words = Words(batch.column(f"text_{side}"))
                    value, row, count = counted(words, config.width)
                    sides.append((mix(value + mix((row + 1).astype(np.uint64) * G1)), row, count))
                    sizes.append(np.bincount(row, count, words.rows))
                    nodes.append(pa.array(row_digest(words)))
                (a, rows_a, n_a), (b, _, n_b) = sides
                _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                shared = np.bincount(rows_a[i], np.minimum(n_a[i], n_b[j]), len(batch))
                whole = sizes[0] + sizes[1] - shared
                similarity = np.divide(shared, whole, out=np.zeros(len(batch)), where=whole > 0)
                out = pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(similarity)], ["u", "v", "similarity"])
                same = pa.compute.and_(pa.compute.equal(batch.column("u"), nodes[0]), pa.compute.equal(batch.column("v"), nodes[1]))
                yield out.filter(same)

    return run


def keyed(docs: DataFrame) -> list[Column]:
    """What a row is known by: key (doc_id), tid (MD5 of its text) and a hash of both."""
    key, tid = F.col("doc_id").cast("long"), F.md5(F.encode("text", "UTF-8"))
    return [key.alias("key"), tid.alias("tid"), F.xxhash64(key, tid).alias("spot")]


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, config: NearDupConfig) -> DataFrame:
    """Similarities of pairs of nodes (a written table); a node's text is that of its first row. Where texts travel, no key has more than some ``PAIRS_A_PIECE`` rows."""
    total = pairs.count()
    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct().join(nodes.select("node", F.col("rep.tid").alias("tid"), F.xxhash64("rep.key", "rep.tid").alias("spot")), "node")
    texts = written(docs.select(*keyed(docs), "text").drop("key").join(wanted, ["spot", "tid"]).dropDuplicates(["spot", "tid"]).select("node", "text"))
    both, sides = pairs.select("u", "v"), {}
    for side, other in (("u", "v"), ("v", "u")):  # pieces first, while rows are without texts
        held = written(pairs.groupBy(side).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > PAIRS_A_PIECE))
        few = held.count() <= 1 / HOT_SHARE
        pieces = F.ceil(F.coalesce("held", F.lit(1)) / PAIRS_A_PIECE).cast("int")
        both = (both.join(F.broadcast(held), side, "left") if few else join_hot(written(both), held, [side], "held", total, "left")).withColumn(f"piece_{side}", F.pmod(F.xxhash64(other), pieces)).drop("held")
        own = texts.toDF(side, f"text_{side}").join(F.broadcast(held) if few else held, side, "left")
        sides[side] = own.withColumn(f"piece_{side}", F.explode(F.sequence(F.lit(0).cast("long"), pieces.cast("long") - 1))).drop("held")
    both = both.join(sides["u"], ["u", "piece_u"]).join(sides["v"], ["v", "piece_v"])
    out = written(both.mapInArrow(overlap_rows(config), "u string, v string, similarity double"))
    discard(texts)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links lead to. Minima spread over links and pointers jump, until nothing changes; labels only fall, so that it ends."""
    both = written(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    total = both.count()
    label = written(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree")).select("node", F.least("node", "m").alias("component"), "degree"))
    while True:
        seen = join_hot(both, label.toDF("v", "seen", "degree"), ["v"], "degree", total).groupBy(F.col("u").alias("node")).agg(F.min("seen").alias("seen"))
        near = written(label.join(seen, "node").select("node", "degree", F.least("component", "seen").alias("via"), F.col("component").alias("was")))
        jump = near.groupBy("via").agg(F.count(F.lit(1)).alias("held")).join(label.select(F.col("node").alias("via"), F.col("component").alias("far")), "via")
        new = written(join_hot(near, jump, ["via"], "held", total, "left").select("node", F.least("via", F.coalesce("far", "via")).alias("component"), "degree", "was"))
        discard(near, label)
        label = new.select("node", "component", "degree")
        label.scratch = new.scratch
        if not new.where(F.col("component") != F.col("was")).limit(1).count():
            discard(both)
            out = new.select("node", "component")
            out.scratch = new.scratch
            return out


def unequal_bits(a: Column, b: Column) -> Column:
    """Bits in which two odd sketches differ; the longer is halved first (sizes within the threshold differ by one doubling at most)."""
    width = F.least(F.size(a), F.size(b))

    def fold(c: Column) -> Column:
        halves = F.zip_with(F.slice(c, F.lit(1), width), F.slice(c, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(c) > width, halves).otherwise(c)

    differing = F.zip_with(fold(a), fold(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda total, x: total + x)


def judged(docs: DataFrame, config: NearDupConfig) -> DataFrame:
    """One row per row of ``docs``: key, tid, n_shingles, class_size, n_links, first (the class's first row: no_id, key, tid)."""
    shape = "key long, tid string, node string, size long, bands array<bigint>, sketch array<bigint>"
    signed = written(docs.select(*keyed(docs), "text").drop("spot").mapInArrow(signature_rows(config), shape))
    itself = F.struct(F.col("key").isNull().alias("no_id"), "key", "tid")
    nodes = written(signed.where("size > 0").groupBy("node").agg(F.min(itself).alias("rep"), F.min("size").alias("size"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    members = written(nodes.select("node", "size", F.explode("bands").alias("band")))
    total = members.count()
    held = written(members.groupBy("band").agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    shared = written(join_hot(members, held, ["band"], "held", total))
    discard(members)
    # The node that shares most bands with others is near the middle of its family: it is compared first.
    rank = shared.groupBy("node").agg(F.sum("held").alias("central"))
    placed = shared.join(rank, "node").withColumn("component", F.col("node"))
    links = label = None
    used = [held, shared]
    for k in range(config.rounds):
        placed = written(placed)
        order = F.struct("central", "node") if k == 0 else F.struct(F.xxhash64("node", F.lit(k)).alias("central"), "node")
        pivots = placed.groupBy("band").agg(F.max(F.struct(order.alias("o"), "size", "component")).alias("p"), F.min("component").alias("a"), F.max("component").alias("b"), F.max("held").alias("held")).where("a <> b")
        pivots = written(pivots.select("band", "held", F.col("p.o.node").alias("pivot"), F.col("p.size").alias("pivot_size"), F.col("p.component").alias("pivot_component")))
        near = join_hot(placed.drop("held"), pivots, ["band"], "held", total)
        fits = F.least("size", "pivot_size") >= config.threshold * F.greatest("size", "pivot_size")
        asked = written(near.where((F.col("component") != F.col("pivot_component")) & fits).select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct())
        star = verified(asked, docs, nodes, config)
        found = star.where(F.col("similarity") >= config.threshold)
        links = found if links is None else links.unionByName(found)
        label = components(links)
        away = near.join(star.select(F.col("u").alias("node"), F.col("v").alias("pivot"), (1 - F.col("similarity")).alias("away")), ["node", "pivot"], "left")
        away = away.select("band", "node", F.when(F.col("node") == F.col("pivot"), 0.0).otherwise(F.col("away")).alias(f"away{k}"))
        used += [placed, pivots, asked, star, label]
        placed = placed.drop("component").join(label, "node", "left").withColumn("component", F.coalesce("component", "node")).join(away, ["band", "node"], "left")
    placed = written(placed)

    # What still shares a bucket with another component: all such pairs, unless sizes or the distances to the pivots exclude them.
    most = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"), F.max("held").alias("held")).groupBy("band").agg(F.max(F.struct("n", "component")).alias("m"), F.max("held").alias("held"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("band", "held", F.col("m.component").alias("home"))
    # Sizes within the threshold are at most one class apart.
    scale = F.floor(F.log("size") / max(-math.log(config.threshold) * 1.001, 1e-3)).cast("int")
    mixed = written(join_hot(placed.drop("held"), most, ["band"], "held", total).join(nodes.select("node", "sketch"), "node").withColumn("scale", scale))
    slack = 1 - config.threshold + 1e-9
    apart = [f"away{k}" for k in range(config.rounds)]
    rest = mixed.where("component <> home").select("band", F.col("node").alias("u"), F.col("size").alias("size_u"), F.col("component").alias("component_u"), F.col("sketch").alias("sketch_u"), *[F.col(c).alias(f"{c}_u") for c in apart], F.explode(F.array(F.col("scale") - 1, F.col("scale"), F.col("scale") + 1)).alias("scale"))
    near = (F.col("component") != F.col("component_u")) & (F.least("size", "size_u") >= config.threshold * F.greatest("size", "size_u"))
    for c in apart:
        near = near & F.coalesce((F.abs(F.col(c) - F.col(f"{c}_u")) <= slack) & (F.col(c) > 0) & (F.col(f"{c}_u") > 0), F.lit(True))
    near = near & (unequal_bits(F.col("sketch"), F.col("sketch_u")) <= (F.col("size") + F.col("size_u")) * config.most_apart + 1e-6)
    crowd = crowded(mixed, ["band", "scale"], total, MEMBERS_A_PIECE)
    met = join_pieces(mixed.select("band", "scale", "node", "size", "component", "sketch", *apart), rest, ["band", "scale"], crowd, F.xxhash64("node"))
    second = written(met.where(near).select(F.least("u", "node").alias("u"), F.greatest("u", "node").alias("v")).distinct())
    used += [placed, mixed, second]
    if second.limit(1).count():
        more = verified(second, docs, nodes, config)
        used.append(more)
        more = more.where(F.col("similarity") >= config.threshold)
        links = links.unionByName(more)
        if more.limit(1).count():
            label = components(links)
            used.append(label)

    links = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    degree = links.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    whole = written(nodes.select("node", "rep", "n").join(label, "node", "left").withColumn("component", F.coalesce("component", "node")).join(degree, "node", "left"))
    size = whole.groupBy("component").agg(F.sum("n").alias("class_size"), F.min("rep").alias("first"), F.count(F.lit(1)).alias("members"))
    facts = written(join_hot(whole, size, ["component"], "members", total).select("node", "n", "class_size", "first", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    discard(nodes, whole, *used)
    ids = signed.select("key", "tid", "node", F.col("size").alias("n_shingles"))
    out = join_hot(ids.where("n_shingles > 0"), facts, ["node"], "n", total)
    alone = ids.where("n_shingles = 0").select("*", F.lit(1).cast("long").alias("class_size"), itself.alias("first"), F.lit(0).cast("long").alias("n_links"))
    return out.drop("n").unionByName(alone).select("key", "tid", "n_shingles", "class_size", "n_links", "first", itself.eqNullSafe(F.col("first")).alias("kept"))


def near_dup_classes(docs: DataFrame, config: NearDupConfig = NearDupConfig()) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of the class), class_size, n_links, n_shingles, kept.

    ``kept`` marks the class's first row: the smallest doc_id (a null one comes last) and, where several texts of the class have it, the smallest MD5 of a text;
    rows that agree in both are repeated rows and are all marked. n_links counts the verified links of the row's text to other texts. A text without words (null,
    empty, punctuation) is its own class and is kept; a null doc_id takes part and has a null class_id only if its whole class has none.
    """
    out = judged(docs, config)
    return out.select(F.col("key").alias("doc_id"), F.col("first.key").alias("class_id"), "class_size", "n_links", "n_shingles", "kept")


def drop_near_duplicates(docs: DataFrame, config: NearDupConfig = NearDupConfig()) -> DataFrame:
    """One row of ``docs`` for each class, its first row (see ``near_dup_classes``; of repeated rows any one), and all rows without words. A null class is like any other."""
    verdict = written(judged(docs, config).where("n_shingles > 0").groupBy("key", "tid").agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n")).select(F.xxhash64("key", "tid").alias("spot"), "tid", "kept", "n"))
    carried = docs.select(*keyed(docs), row_struct(docs).alias("row")).drop("key")
    gone = verdict.where("not kept or n > 1").select("spot", "tid")
    out = carried.join(gone, ["spot", "tid"], "left_anti").select("row")
    repeated = verdict.where("kept and n > 1").select("spot", "tid")
    if repeated.limit(1).count():
        out = out.unionByName(carried.join(repeated, ["spot", "tid"]).dropDuplicates(["spot", "tid"]).select("row"))
    return out.select("row.*")
