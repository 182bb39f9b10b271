"""Exact deduplication against a persistent digest index, bucketed and sorted by digest.

The index is a folder with one row for each digest ever kept, which any later session opens again by its path. A batch is reduced to one row per
digest, sort-merge anti-joined with the index (whose side needs no shuffle where the session's shuffle partitions equal its buckets: it is bucketed by the join key), and what is new is
appended in the same buckets. What stays is then read from the index. DataFrame functions only.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, join_hot, lower_ascii, scratch_root, written

BATCHES = 3


def digested(docs: DataFrame) -> DataFrame:
    """doc_id and digest of the normalised text (A-Z lowered, null as empty)."""
    normal = F.encode(lower_ascii(F.coalesce("text", F.lit(""))), "UTF-8")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normal, 256).alias("digest"))


class DigestIndex:
    """Digests seen so far: ``digest`` (SHA-256, hex), ``keep_id`` (doc_id that stays), ``batch`` (that brought it), under ``path`` (without one, in a new folder among the shared ones).

    A new index gets as many buckets as the session has shuffle partitions, unless ``buckets`` says otherwise: an index that is to
    hold much more than its first batch should be given more. The number is kept beside the rows, and an index that exists keeps its own.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None) -> None:
        self.spark, self.path = spark, (path or f"{scratch_root(spark)}/digest-index-{uuid.uuid4().hex}").rstrip("/")
        self.name = f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"
        kept = f"{self.path}/_buckets"
        where = spark._jvm.org.apache.hadoop.fs.Path(kept)
        if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
            n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(n).alias("buckets")).coalesce(1).write.parquet(kept)
        self.buckets = spark.read.parquet(kept).first()["buckets"]
        location = self.path.replace("'", "\\'")
        spark.sql(f"create table if not exists {self.name} (digest string, keep_id bigint, batch string) using parquet clustered by (digest) sorted by (digest) into {self.buckets} buckets location '{location}'")
        spark.catalog.refreshTable(self.name)

    def _append(self, rows: DataFrame) -> None:
        """Dealt by bucket first, so that a batch adds one file to each."""
        rows.repartition(self.buckets, "digest").write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget the table and delete its folder."""
        self.spark.sql(f"drop table if exists {self.name}")
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Append the rows of ``groups`` (digest, last_id) whose digest the index lacks. Adding a batch again appends nothing."""
        new = groups.hint("merge").join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        fresh = written(new.select("digest", F.col("last_id").alias("keep_id"), F.lit(batch).alias("batch")))
        self._append(fresh)
        discard(fresh)

    def ingest(self, docs: DataFrame, batch: str) -> DataFrame:
        """Decide on each row of ``docs`` and append new digests; ``batch`` names these rows.

        Texts are equal if identical after lower-casing A-Z; null counts as empty. Of the batch's rows with a text
        that no other batch brought, the largest doc_id stays; a text of another batch is dropped wholly, with the
        keep_id stored there. group_size counts the batch. A null doc_id is smaller than any; repeated rows of the
        keep_id are all marked kept. An empty batch changes nothing. The same batch again gets the same answers. Other columns of ``docs`` are ignored.
        """
        return self.decide(written(digested(docs).withColumn("step", F.lit(0))), [batch])

    def decide(self, rows: DataFrame, batches: list[str]) -> DataFrame:
        """Add ``rows`` (doc_id, digest, step) step by step as ``batches`` and tell what the index then says of each row."""
        groups = written(rows.groupBy("digest", "step").agg(F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n")))
        for k, batch in enumerate(batches):
            self.add(groups.where(F.col("step") == k), batch)
        whole = groups.groupBy("digest").agg(F.sum("n").alias("group_size"))
        facts = written(whole.hint("merge").join(self.table().hint("merge"), "digest").select("digest", "keep_id", "group_size", F.col("batch").isin(batches).alias("new")))
        discard(groups)
        kept = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        return join_hot(rows.drop("step"), facts, ["digest"], "group_size", rows.count()).select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None, batches: int = BATCHES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The rows go into ``index`` (or one made for this call and dropped at its end) in ``batches`` by descending doc_id, so that the first batch with a text holds its largest
    doc_id and later ones are dropped by the anti-join; null doc_ids come last. Ties and repeated rows as in ``DigestIndex.ingest``.
    """
    spark, own, run = docs.sparkSession, index is None, uuid.uuid4().hex[:8]
    index = index or DigestIndex(spark)
    rows = written(digested(docs))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / batches for k in range(batches - 1, 0, -1)] or [0.5])).first()[0] or []
    step = F.lit(0)
    for cut in cuts[: batches - 1]:
        step = step + F.coalesce((F.col("doc_id") <= cut).cast("int"), F.lit(1))
    out = index.decide(rows.withColumn("step", step), [f"{run}-{k}" for k in range(batches)])
    if own:
        index.drop()
    return out
