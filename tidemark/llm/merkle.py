"""A Merkle manifest of a dataset and proofs of its rows by descent. DataFrame functions only.

Rows are leaves of one ternary tree for each source, and the sources' roots are the leaves of a top tree. Every inner node is a record from its
digest to its children's digests; that is all a descent knows. Requests for leaves go down from the root together: at each height the nodes that they
reach are looked up by digest, the digit of the rank at that height selects a child, and the children not selected go into the path. The path, reversed, is the proof.

A source's rows are ranked over sorted ranges, never in one window; records and frontiers are written every few levels, so a lost executor costs those at most. Records
are stored once however often a digest occurs; nodes that repeat (runs of identical rows) are dealt over pieces when they are looked up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crowded, discard, join_pieces, table, written

FAN = 3
#: Levels built by one exchange, and between two written frontiers.
STEP = 4
#: More levels than any table can have: 3 ** 40 is beyond the range of a row number.
MOST_LEVELS = 40
PARTS = ["doc_id", "source", "lang", "n_chars", "text"]
NO_PATH = "array<struct<l:binary,r:binary>>"


def framed(c: Column) -> Column:
    """``-`` for null, else the value after its UTF-8 byte count."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(text: Column) -> Column:
    """The digest of a row of documents with ``text`` in the place of its own."""
    return F.unhex(F.sha2(F.concat(*[framed(text if c == "text" else F.col(f"`{c}`")) for c in PARTS]), 256))


def as_hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def parent_digest(children: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws("", F.transform(children, as_hex)), 256))


def tree_height(n: Column) -> Column:
    """The least h with FAN ** h >= n."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k).cast("long") for k in range(MOST_LEVELS)]), lambda p: p < n))


def ranked(rows: DataFrame, by: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows, sorted by range and written, with their place ``at``; and for each part of ``by`` in a range: part, first place and rows ``before`` it.

    The rank inside ``by`` is ``at - first + before``. Windows run over the ranges, of which there are as many as shuffle partitions.
    """
    t = written(rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("at", F.monotonically_increasing_id()))
    held = t.groupBy(*by, F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return t, held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _runs(under: Column) -> Column:
    """``under`` in runs of FAN, the last one shorter."""
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(under) / FAN).cast("int") - 1), lambda i: F.slice(under, i * FAN + 1, FAN))


def _records(nodes: Column, runs: Column, level: int, first: Column) -> Column:
    return F.transform(F.arrays_zip(nodes.alias("digest"), runs.alias("children")), lambda x, i: F.struct(F.lit(level).alias("level"), (first + i).alias("rank"), x["digest"].alias("digest"), x["children"].alias("children")))


def build_pass(below: DataFrame, base: int) -> DataFrame:
    """Records (tree, height, level, rank, digest, children) of the ``STEP`` levels above level ``base``, of the trees that reach so high: one exchange, as 3 ** STEP nodes in a row share their ancestors."""
    group = F.floor(F.col("rank") / FAN**STEP).cast("long").alias("group")
    g = below.where(F.col("height") > base).groupBy("tree", "height", group).agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("k"), "digest"))).alias("all")).withColumn("d0", F.col("all.digest"))
    for j in range(1, STEP + 1):
        g = g.withColumn(f"r{j}", _runs(F.col(f"d{j - 1}"))).withColumn(f"d{j}", F.transform(f"r{j}", parent_digest))
    records = [_records(F.col(f"d{j}"), F.col(f"r{j}"), base + j, F.col("group") * FAN ** (STEP - j)) for j in range(1, STEP + 1)]
    return g.select("tree", "height", F.inline(F.concat(*records))).where("level <= height")


@dataclass
class Records:
    """The records of one pass: ``rows`` by place, and ``split``: digests that so many places share that a look-up deals them over pieces (None: there are none)."""

    rows: DataFrame
    split: DataFrame | None


def build_tree(leaves: DataFrame, height: int) -> list[Records]:
    """The records of levels 1 to ``height``, ``STEP`` levels each, of the trees whose ``leaves`` are (tree, height, rank, digest)."""
    passes: list[Records] = []
    below = leaves
    for base in range(0, height, STEP):
        rows = written(build_pass(below, base))
        shared = written(crowded(rows, ["level", "digest"], rows.count()))
        passes.append(Records(rows, shared if shared.count() else None))
        below = rows.where(F.col("level") == base + STEP).select("tree", "height", "rank", "digest")
    return passes


def looked_up(frontier: DataFrame, passes: list[Records], h: int) -> DataFrame:
    """The frontier's nodes, all of height ``h``, with the children that their digests name. A digest is one record however many places have it."""
    at = passes[(h - 1) // STEP]
    store = at.rows.where(F.col("level") == h).groupBy("digest").agg(F.max("children").alias("children"))
    if at.split is None:
        return frontier.join(store, "digest")
    return join_pieces(frontier, store, ["digest"], at.split.where(F.col("level") == h).drop("level"), F.xxhash64("tree", "rank"))


def unselected(children: Column, digit: Column) -> Column:
    """The digests left and right of the selected child, each side in one piece."""
    left = F.slice(children, F.lit(1), digit)
    right = F.slice(children, digit + 2, F.lit(FAN))
    return F.struct(F.unhex(F.concat_ws("", F.transform(left, F.hex))).alias("l"), F.unhex(F.concat_ws("", F.transform(right, F.hex))).alias("r"))


def descend(frontier: DataFrame, passes: list[Records], h: int) -> DataFrame:
    """From (tree, height, rank, digest, path, ...) one height down: a row for each child, with the others in its path."""
    rest = [c for c in frontier.columns if c not in ("rank", "digest", "path")]
    kids = looked_up(frontier, passes, h).select(*rest, "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
    return kids.select(*rest, (F.col("rank") * FAN + F.col("digit")).alias("rank"), F.col("child").alias("digest"), F.concat("path", F.array(unselected(F.col("children"), F.col("digit")))).alias("path"))


@dataclass
class Manifest:
    """``root`` (hex), ``leaves`` (tree, height, rank, digest, and the carried columns), ``sources`` (tree, source, named, n, height), the records of the sources' trees and of the top tree, and their heights."""

    root: str
    leaves: DataFrame
    sources: DataFrame
    levels: list[Records]
    top: list[Records]
    height: int
    top_height: int


def build_manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> Manifest | None:
    """The manifest of ``docs``; None for an empty table.

    A row's leaf is made of doc_id, source, lang, n_chars and text, null or not. Sources go in bytewise order, the null source first; leaves of a source go by doc_id (null
    first), rows that share a doc_id by leaf digest. Identical rows are leaves of their own. ``carry`` are columns over ``docs`` that leaves keep (named unlike those above); other columns are ignored.
    """
    own = written(docs.select(F.col("source").isNotNull().alias("named"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(F.col("text")).alias("digest"), *[c.alias(n) for n, c in (carry or {}).items()]))
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    rows, parts = ranked(own.withColumn("place", place), ["named", "source"], ["doc_id", "digest", "place"])
    parts = written(parts)
    sizes, ranges = ranked(parts.groupBy("named", "source").agg(F.sum("n").alias("n")), [], ["named", "source"])
    starts = ranges.select("part", "first", "before")
    numbered = sizes.withColumn("part", F.shiftright("at", 33)).join(starts, "part").select("named", "source", "n", (F.col("at") - F.col("first") + F.col("before")).alias("tree"), tree_height(F.col("n")).alias("height"))
    sources = written(numbered)
    count, height = sources.agg(F.count(F.lit(1)), F.max("height")).first()
    if not count:
        return None
    spots = parts.join(sources, ["named", "source"]).select("named", "source", "part", "first", "before", "tree", "height")
    placed = rows.withColumn("part", F.shiftright("at", 33)).join(spots, ["named", "source", "part"])
    leaves = written(placed.select("tree", "height", (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "doc_id", "digest", *(carry or {})))
    discard(own, rows, parts, sizes)
    levels = build_tree(leaves.select("tree", "height", "rank", "digest"), height)
    subroots = leaves.where("height = 0").select("tree", "digest")
    for x in levels:
        subroots = subroots.unionByName(x.rows.where("level = height").select("tree", "digest"))
    high = next(h for h in range(MOST_LEVELS) if FAN**h >= count)
    top_leaves = written(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(high).alias("height"), F.col("tree").alias("rank"), "digest"))
    top = build_tree(top_leaves, high)
    root = (top[-1].rows.where("level = height") if top else top_leaves).select(as_hex(F.col("digest"))).first()[0]
    return Manifest(root, leaves, sources, levels, top, height, high)


def prove(spark: SparkSession, m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """One row for each requested leaf: the columns of ``m.leaves``, ``subroot`` and ``path`` (from the leaf to the root, siblings left and right at each height).

    ``requests`` is (tree, rank), repeated or not; without it all leaves are requested. A request for a rank that no leaf has gives no row.
    """
    asked = None if requests is None else written(requests.select(F.col("tree").cast("long").alias("tree"), F.col("rank").cast("long").alias("rank")).distinct())

    def wanted(frontier: DataFrame, h: int) -> DataFrame:
        """The nodes of height ``h`` above a requested leaf."""
        if asked is None:
            return frontier
        return frontier.join(asked.select("tree", F.floor(F.col("rank") / FAN**h).cast("long").alias("rank")).distinct(), ["tree", "rank"], "left_semi")

    at = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("rank"), F.unhex(F.lit(m.root)).alias("digest"), F.array().cast(NO_PATH).alias("path"))
    for h in range(m.top_height, 0, -1):
        at = descend(at, m.top, h)
        at = written(at) if h % STEP == 0 else at
    tops = at.select(F.col("rank").alias("tree"), F.col("digest").alias("subroot"), "path").join(m.sources.select("tree", "height"), "tree")
    tops = written(tops.select("tree", "height", F.lit(0).cast("long").alias("rank"), F.col("subroot").alias("digest"), "path", "subroot"))
    found: DataFrame | None = None
    for h in range(m.height, 0, -1):
        here = wanted(tops.where(F.col("height") == h), h).drop("height")
        here = here if found is None else here.unionByName(found)
        if h > 1:
            found = wanted(descend(here, m.levels, h), h - 1)
            found = written(found) if (h - 1) % STEP == 0 else found
        else:
            found = looked_up(here, m.levels, 1).select("tree", "rank", "subroot", "path", "children")
    leaves = m.leaves if asked is None else m.leaves.join(asked, ["tree", "rank"], "left_semi")
    own = [c for c in m.leaves.columns]
    lone = leaves.where("height = 0").join(tops.select("tree", "subroot", "path"), "tree").select(*own, "subroot", F.reverse("path").alias("path"))
    if found is None:
        return lone
    digit = F.pmod("rank", F.lit(FAN)).cast("int")
    parents = found.withColumnRenamed("rank", "above")
    deep = leaves.where("height > 0").withColumn("above", F.floor(F.col("rank") / FAN).cast("long")).join(parents, ["tree", "above"])
    deep = deep.where(F.element_at("children", digit + 1) == F.col("digest"))
    return lone.unionByName(deep.select(*own, "subroot", F.reverse(F.concat("path", F.array(unselected(F.col("children"), digit)))).alias("path")))


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf's digest and the siblings on its path lead to."""
    return F.aggregate(path, as_hex(leaf), lambda acc, s: F.sha2(F.concat(as_hex(s["l"]), acc, as_hex(s["r"])), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(as_hex(s["l"]), as_hex(s["r"])))), 256)


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verified_manifest(spark: SparkSession, docs: DataFrame, tampered: Column) -> DataFrame:
    """One row per row of ``docs``: its leaf, its source's root, the root, its proof's digest, and the root that the row with the text ``tampered`` leads to.

    An empty table gives an empty result. Nulls and repeated rows as in ``build_manifest``.
    """
    m = build_manifest(docs, {"tried": leaf_digest(tampered)})
    if m is None:
        return spark.createDataFrame([], RESULT)
    folded = fold(F.col("tried"), F.col("path"))
    shown = prove(spark, m).select("doc_id", as_hex(F.col("digest")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), F.lit(m.root).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering deletes the line ends of the texts whose doc_id has an even CRC-32; a null doc_id's text stays."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return verified_manifest(spark, table(spark, sf_dir, "documents"), tampered)


_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split({0}, ''), lambda ch: [ord(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384::bigint * (c & 1)) end), 4294967295::bigint)"


def crc_sql(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text: eight shifts for each byte."""
    return _CRC.format(text)


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ["doc_id", "source", "lang", "n_chars", text]) + ")"


OP11_SQL = f"""
with recursive d as (
  select doc_id, source, {_leaf_sql("text")} as leaf,
    case when {crc_sql("doc_id::varchar")} % 2 = 0 then {_leaf_sql("replace(text, chr(10), '')")} else {_leaf_sql("text")} end as tried from documents),
l as (select *, (row_number() over (partition by source order by doc_id nulls first, leaf) - 1)::bigint as k, count(*) over (partition by source)::bigint as n, (dense_rank() over (order by source nulls first) - 1)::bigint as s from d),
up as (
  select s, 0 as h, k, n, leaf as digest from l
  union all
  select s, h + 1, k // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by k)) from up where n > 1 group by s, h, k // 3, n),
sub as (select s, digest as subroot from up where n = 1),
top as (
  select 0 as h, s as k, (select count(*) from sub)::bigint as n, subroot as digest from sub
  union all
  select h + 1, k // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by k)) from top where n > 1 group by h, k // 3, n),
runs as (select s, h, k // 3 as p, list(digest order by k) as c from up where n > 1 group by s, h, k // 3),
top_runs as (select h, k // 3 as p, list(digest order by k) as c from top where n > 1 group by h, k // 3),
sides as (
  select l.s, l.k, r.h, array_to_string(c[1:(l.k // (3 ** r.h)::bigint) % 3], '') as a, array_to_string(c[(l.k // (3 ** r.h)::bigint) % 3 + 2:], '') as b from l join runs r on r.s = l.s and r.p = l.k // (3 ** (r.h + 1))::bigint
  union all
  select l.s, l.k, 1000 + r.h, array_to_string(c[1:(l.s // (3 ** r.h)::bigint) % 3], ''), array_to_string(c[(l.s // (3 ** r.h)::bigint) % 3 + 2:], '') from l join top_runs r on r.p = l.s // (3 ** (r.h + 1))::bigint),
proofs as (select s, k, string_agg(a || b, '' order by h) as proof, list(a || '|' || b order by h) as steps from sides group by s, k),
done as (
  select doc_id, leaf, subroot, (select digest from top where n = 1) as root, sha256(coalesce(proof, '')) as proof_sha256,
    list_reduce(list_prepend(tried, coalesce(steps, [])), lambda acc, x: sha256(split_part(x, '|', 1) || acc || split_part(x, '|', 2))) as folded_root
  from l join sub using (s) left join proofs using (s, k))
select *, folded_root = root as verified from done
"""
