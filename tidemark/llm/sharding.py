"""Sharding by balanced label propagation. DataFrame functions only.

Documents with equal texts are linked through their text's digest (the hub), so no pairs exist. A document's first
shard and its bundle come from a hash of its doc_id; a bundle is the documents of one hub that move together, at
most ``BUNDLES`` for a hub however large. In each round a bundle wants the shard that holds most of its hub. Wishes from
shard a to shard b are summed by b and cell (gain class and hash), and cells are granted, largest gain first, up to what
wishes to leave b plus b's free room: moves keep the sizes. What moves is joined back, and the next round starts.

The law ``rows`` is then exact: all rows are ranked by (label, linked in the middle, hub) and the ranking is cut into equal
shards, at most one row apart. Cuts fall on unlinked rows unless a hub is larger than what a shard has left. Ranks come
from counts of small cells and a row number inside each, never from one window over all rows or over a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, join_hot, written

BUNDLES = 64
#: Rows that one task ranks: larger hubs are dealt over as many pieces as they need.
PIECE = 10_000
#: Cells of a destination: gain classes times hash classes. Their table has at most shards * 64 * HASHES rows.
HASHES = 64


def propagate(bundles: DataFrame, shards: int, rounds: int, room: float) -> DataFrame:
    """(hub, bundle, n, label) after ``rounds`` of balanced label propagation; ``room``: free rows of a shard that all moves into it may use."""
    for k in range(rounds):
        votes = bundles.groupBy("hub", "label").agg(F.sum("n").alias("votes"))
        tie = F.xxhash64("hub", "label", F.lit(k))
        best = votes.groupBy("hub").agg(F.max(F.struct("votes", tie.alias("tie"), "label")).alias("best")).select("hub", F.col("best.label").alias("want"), F.col("best.votes").alias("there"))
        here = votes.withColumnRenamed("votes", "here")
        wishes = bundles.join(best, "hub").where("want <> label").join(here, ["hub", "label"])
        gain = F.greatest(F.col("there") - F.col("here") + F.col("n"), F.lit(0))
        cell = F.struct((-F.floor(F.log2(1.0 + gain))).cast("int").alias("g"), F.pmod(F.xxhash64("hub", "bundle", F.lit(k)), F.lit(HASHES)).cast("int").alias("h"))
        wishes = written(wishes.withColumn("cell", cell).select("hub", "bundle", "n", F.col("label").alias("a"), F.col("want").alias("b"), "cell.g", "cell.h"))
        asked = wishes.groupBy("b", "g", "h").agg(F.sum("n").alias("n"))
        leaving = wishes.groupBy(F.col("a").alias("b")).agg(F.sum("n").alias("leaving"))
        sums = Window.partitionBy("b").orderBy("g", "h")  # over a shard's cells, which are few
        granted = asked.withColumn("so_far", F.sum("n").over(sums)).join(leaving, "b", "left").where(F.col("so_far") <= F.coalesce("leaving", F.lit(0)) + F.lit(room)).select("b", "g", "h")
        moves = wishes.join(granted, ["b", "g", "h"], "left_semi").select("hub", "bundle", F.col("b").alias("moved"))
        after = written(bundles.join(moves, ["hub", "bundle"], "left").select("hub", "bundle", "n", F.coalesce("moved", "label").alias("label")))
        discard(wishes, bundles)
        bundles = after
    return bundles


def balanced_shards(docs: DataFrame, shards: int = 16, rounds: int = 3, slack: float = 0.02, seed: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law ``rows``, shard, slot, grown_shard (null), linked, first_shard.

    Size is the UTF-8 bytes plus 1 (null: 1); text_crc32 of null is null. Equal texts are linked, a null text to none. Repeated
    rows count one by one. Rows that agree in doc_id and text may swap slots; rows without doc_id are told apart by their place in the stored table. An empty
    table gives an empty result; extra columns are ignored. Labels of rows are exchangeable inside a bundle. Under this law a row's shard depends on all
    rows: cells and pieces for ranking are counted from the table's and the hubs' sizes.
    """
    known = F.col("text").isNotNull()
    stored = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(known, F.octet_length("text") + 1).otherwise(1).cast("long").alias("size"), F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"), F.when(known, F.md5(F.encode("text", "UTF-8"))).alias("hub")))
    rows = stored.withColumn("ident", F.coalesce("doc_id", F.xxhash64("_metadata.file_name", "_metadata.row_index")))
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64(F.lit(seed), "ident"), F.lit(BUNDLES)).cast("int"))
    total = stored.count()
    hubs = rows.where("hub is not null").groupBy("hub").agg(F.count(F.lit(1)).alias("hub_n")).where("hub_n > 1")
    counts = rows.where("hub is not null").groupBy("hub", "bundle").agg(F.count(F.lit(1)).alias("n"))
    start = written(counts.join(hubs, "hub").select("hub", "bundle", "n", "hub_n", F.pmod("bundle", F.lit(shards)).alias("label")))
    final = propagate(start.drop("hub_n"), shards, rounds, slack * total / shards)
    placed = final.join(start.select("hub", "bundle", "hub_n"), ["hub", "bundle"])
    labels = written(placed)

    def shown(part: DataFrame) -> DataFrame:
        return part.select("doc_id", "ident", "size", "text_crc32", "hub", "bundle", "label", F.coalesce("hub_n", F.lit(1)).alias("hub_n"))

    linked = join_hot(rows.where("hub is not null"), labels, ["hub", "bundle"], "n", total, "left")
    free = rows.where("hub is null").withColumn("label", F.lit(None).cast("int")).withColumn("hub_n", F.lit(1).cast("long"))
    both = shown(linked).unionByName(shown(free)).withColumn("first_shard", F.pmod("bundle", F.lit(shards)))
    label = F.coalesce("label", "first_shard")
    side = F.when(F.col("hub_n") > 1, 1).otherwise(F.when(F.pmod(F.xxhash64("ident", F.lit(seed + 1)), F.lit(2)) == 0, 0).otherwise(2))
    spot = F.xxhash64(F.coalesce("hub", F.lit("")), F.when(F.col("hub_n") > 1, F.lit(0)).otherwise(F.col("ident")))
    cells = max(16, int(total / shards / (2 * PIECE)))  # some 20,000 rows in a cell
    piece = F.when(F.col("hub_n") > PIECE, F.pmod(F.xxhash64("ident", F.lit(seed + 2)), F.ceil(F.col("hub_n") / PIECE))).otherwise(0)
    both = both.select("*", F.struct(label.alias("label"), side.alias("side"), F.pmod(spot, F.lit(cells)).cast("int").alias("cell"), piece.cast("int").alias("piece")).alias("at"), spot.alias("spot"))
    both = written(both.select("doc_id", "size", "text_crc32", "hub_n", "first_shard", "spot", "bundle", "at.label", "at.side", "at.cell", "at.piece"))
    discard(start, labels, stored)
    keys = ["label", "side", "cell", "piece"]
    heights = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("height"))
    # The cells hold some thousands of rows each: a window over a label's cells is small beside its rows.
    by_label = heights.groupBy("label").agg(F.sum("height").alias("label_n"))
    ahead = by_label.select("label", (F.sum("label_n").over(Window.orderBy("label")) - F.col("label_n")).alias("label_start"))  # one row for each shard
    before = Window.partitionBy("label").orderBy("side", "cell", "piece")
    starts = heights.join(ahead, "label").select(*keys, "height", (F.col("label_start") + F.sum("height").over(before) - F.col("height")).alias("start"))
    inside = Window.partitionBy(*keys).orderBy("spot", "bundle", "doc_id", "text_crc32")
    ranked = both.withColumn("nth", F.row_number().over(inside) - 1).join(starts, keys).withColumn("rank", F.col("start") + F.col("nth"))
    base, extra = total // shards, total % shards  # the first ``extra`` shards have one row more
    edge = extra * (base + 1)
    shard = F.when(F.col("rank") < edge, F.floor(F.col("rank") / (base + 1))).otherwise(extra + F.floor((F.col("rank") - edge) / max(base, 1)))
    ranked = ranked.withColumn("shard", shard.cast("int"))
    first = F.col("shard") * base + F.least(F.col("shard"), F.lit(extra))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), (F.col("hub_n") > 1).alias("linked"), "first_shard")
