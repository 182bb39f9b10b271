"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

A source of ``size`` (bytes or rows) with target weight ``w`` in an output of ``budget`` gets the mean repetition
rate ``w * budget / size``. Each document draws a uniform number from a hash of seed and doc_id and inverts the
Poisson distribution with it; a rate above 64 is split into equal parts that draw on their own (their sum is the
same distribution). Documents are exploded by their counts and dealt out by a hash of seed, doc_id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_struct

#: Beyond this number of sources the rates are joined by a shuffle with salted keys instead of a broadcast.
MOST_BROADCAST = 50_000
PART = 64.0
SALTS = 64


def uniform(*parts: Column) -> Column:
    """In [0, 1), from the first 52 bits of an MD5."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, budget: float | None = None, measure: str = "bytes") -> DataFrame:
    """(source, size, rate). Without ``weights`` a source's weight is its size to the power ``temperature``; sources that
    ``weights`` lacks get rate 0. ``budget`` is the size of all documents if not given. A null source is one source."""
    amount = F.octet_length(F.coalesce("text", F.lit(""))) + 1 if measure == "bytes" else F.lit(1)
    sizes = docs.groupBy("source").agg(F.sum(amount.cast("long")).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]) if weights else None
        sizes = sizes.withColumn("weight", F.coalesce(F.element_at(given, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0))
    whole = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("size").alias("all_size"))
    total = F.lit(float(budget)) if budget is not None else F.col("all_size").cast("double")
    share = F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight")).otherwise(F.lit(0.0))
    return sizes.join(F.broadcast(whole)).select("source", "size", (share * total / F.col("size")).alias("rate"))  # one row


def poisson_table(rates: DataFrame) -> DataFrame:
    """Adds ``parts`` and ``below``: P(count <= k) of one part for k = 0, 1, ... as far as it is below 1 in doubles."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    mean = F.col("rate") / F.col("parts")
    steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("below"))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["below"], F.array(F.element_at(acc["below"], -1) + p)).alias("below"))

    return rates.withColumn("parts", parts).withColumn("below", F.aggregate(steps, start, add, lambda acc: acc["below"]))


def replicated(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, budget: float | None = None, measure: str = "bytes", seed: int = 17) -> DataFrame:
    """(row, n_copies, copy, mix_key): each row of ``docs``, as one value, ``n_copies`` times, dealt out and sorted by ``mix_key``."""
    rates = poisson_table(source_rates(docs.select("source", "text"), weights, temperature, budget, measure)).select(F.coalesce("source", F.lit("\x00")).alias("source_key"), "parts", "below")
    keyed = docs.select(row_struct(docs).alias("row"), F.coalesce("source", F.lit("\x00")).alias("source_key"), F.col("doc_id").alias("id"))
    if rates.select("source_key").limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        joined = keyed.join(F.broadcast(rates), "source_key")
    else:
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        joined = keyed.withColumn("salt", salt).join(rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["source_key", "salt"])

    def drawn(k: Column) -> Column:
        return F.size(F.filter("below", lambda p: uniform(F.lit(seed), F.col("id"), k) >= p))

    one = F.size(F.filter("below", lambda p: F.col("u") >= p))
    count = F.when(F.col("parts") == 1, one).otherwise(F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda acc, k: acc + drawn(k)))
    counted = joined.withColumn("u", uniform(F.lit(seed), F.col("id"), F.lit(1))).select("row", "id", count.alias("n_copies"))
    copies = counted.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("copy").cast("string")))
    return copies.select("row", "n_copies", "copy", key.alias("mix_key")).repartition(F.col("mix_key")).sortWithinPartitions("mix_key")


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, budget: float | None = None, measure: str = "bytes", seed: int = 17) -> DataFrame:
    """All columns of ``docs``, each document ``n_copies`` times, with ``copy`` (from 1) and ``mix_key`` (order of the mixture).

    Rows with the same doc_id draw the same count; a null doc_id draws as the text ``null``. Texts may be null or
    empty. An empty table stays empty. Columns named copy, n_copies or mix_key are replaced; all others stay as they are.
    """
    added = ["n_copies", "copy", "mix_key"]
    return replicated(docs.drop(*added), weights, temperature, budget, measure, seed).select("row.*", *added)


def mixed(docs: DataFrame, **target) -> DataFrame:
    """The copies with the columns of ``docs`` alone, whatever their names."""
    return replicated(docs, **target).select("row.*")


MIX_SQL = """
with sizes as (select source, sum(strlen(coalesce(text, '')) + 1) as size from documents group by source),
weighed as (select source, size, pow(size::double, 0.5) as weight from sizes),
rates as (select source, weight / (select sum(weight) from weighed) * (select sum(size) from weighed)::double / size as rate from weighed),
ks as (select unnest(range(0, 121)) as k),
terms as (select source, k, case when k = 0 then exp(-rate) else exp(-rate + k * ln(rate) - lgamma(k + 1)) end as p from rates, ks),
below as (select source, k, sum(p) over (partition by source order by k) as cdf from terms),
draws as (select d.*, ('0x' || substr(md5('17:' || coalesce(doc_id::varchar, 'null') || ':1'), 1, 13))::bigint::double / 4503599627370496.0 as u from documents d),
counts as (select d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) filter (where d.u >= b.cdf) as n_copies
  from draws d join below b on d.source is not distinct from b.source group by all)
select doc_id, text, lang, source, n_chars, n_copies::integer as n_copies, c::integer as "copy", md5('17:' || coalesce(doc_id::varchar, 'null') || ':' || c::varchar) as mix_key
from counts, unnest(range(1, n_copies + 1)) as t(c)
"""
