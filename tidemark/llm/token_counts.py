"""Token counts without token ids: pieces are counted once per distinct pre-token and joined to documents' pre-token frequencies.

1. Each task counts its documents' pre-tokens; sums by pre-token give the corpus's vocabulary.
2. The tokenizer splits each distinct pre-token once.
3. Documents join their frequencies with the piece counts. The most frequent pre-tokens (``HEAD`` rows at most) are sent to the tasks and
   summed there; all other frequencies meet the vocabulary in a shuffle join, so the vocabulary may be of any size.

Where a tokenizer's file says that it drops white space, no piece reaches over a space, so the pre-token that is counted is a run of other characters (with A-Z
lower-cased if the tokenizer does so); its pieces are the sum over what the tokenizer's own pre-tokenizer makes of it. Other tokenizers' pre-tokens
are taken from their pre-tokenizer directly.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sliced, table, written

HEAD = 300_000
#: White space that every library takes for such; other kinds stay inside a pre-token.
BREAK = re.compile("[ \n\t\r]+")
FLUSH = 400_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Fixed value: the split pattern of the word tokenizer's file; none of its alternatives takes white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
DROPS_SPACE = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}


def steps_of(part) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer as its file lists them."""
    if part is None:
        return []
    state = json.loads(part.__getstate__())
    return state.get("normalizers") or state.get("pretokenizers") or [state]


def splits_at_space(normal: list[dict], split: list[dict]) -> bool:
    """Whether the listed steps can be taken run by run between white space: each normalizing step works on characters and their marks, the first split
    drops white space, and what follows works inside a piece."""
    by_character = all(s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ") for s in normal)
    first, rest = (split[0], split[1:]) if split else ({"type": None}, [])
    words = first["type"] in DROPS_SPACE or (first["type"] == "Split" and first["pattern"] == {"Regex": WORD_PATTERN} and first["behavior"] == "Removed" and first["invert"])
    return by_character and words and all(s["type"] == "ByteLevel" and not s["use_regex"] and not s["add_prefix_space"] for s in rest)


class PreTokenizer:
    """Pre-tokens of a text by the tokenizer file's own normalizer and pre-tokenizer; special tokens in the text count by themselves."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter, self.model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError("added tokens that depend on what stands beside them, or on normalized text, are not counted here")
        special = [t.content for t in added]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.marks = tuple({s[:2] for s in special})
        normal, split = steps_of(self.normalizer), steps_of(self.splitter)
        self.by_space = splits_at_space(normal, split)
        self.lowers = self.by_space and any(s["type"] == "Lowercase" for s in normal)

    def fine(self, text: str) -> list[str]:
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        return [p for p, _ in self.splitter.pre_tokenize_str(normal)]

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special tokens."""
        parts, n = [text], 0
        if self.special is not None and any(m in text for m in self.marks):
            parts = self.special.split(text)
            n = len(parts) - 1
        out: list[str] = []
        for part in parts:
            if not part:
                continue
            if not self.by_space:
                out += self.fine(part)
                continue
            if self.lowers:
                part = part.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
            out += part.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return out, n

    def pieces(self, pre_token: str) -> int:
        if self.by_space:
            return sum(len(self.model.tokenize(p)) for p in self.fine(pre_token)) if pre_token else 0
        return len(self.model.tokenize(pre_token))


def counted_batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pre_token", "n"])


def vocabulary_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, counts = PreTokenizer(path), Counter()
        for batch in sliced(batches):
            for text in batch.column("text").to_pylist():
                counts.update(pre.split(text)[0] if text else ())
            if len(counts) > FLUSH:
                yield counted_batch(counts)
                counts = Counter()
        yield counted_batch(counts)

    return run


def piece_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokenizer(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pre.pieces(p) for p in batch.column("pre_token").to_pylist()], pa.int32())], ["pre_token", "n", "pieces"])

    return run


def document_rows(path: str, head):
    """For each document one row of its id, bytes and what the head covers, with a null pre_token, and one for each other distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, known = PreTokenizer(path), head.value
        uid = TaskContext.get().partitionId() << 40
        for batch in sliced(batches):
            uids, ids, sizes, names, counts = [], [], [], [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found, covered = pre.split(text) if text else ([], 0)
                rest: dict[str, int] = {}
                for p, times in Counter(found).items():
                    n = known.get(p)
                    if n is None:
                        rest[p] = times
                    else:
                        covered += n * times
                uid += 1
                names += [None, *rest]
                counts += [covered, *rest.values()]
                uids += [uid] * (len(rest) + 1)
                ids += [key, *[None] * len(rest)]
                sizes += [len(text.encode("utf-8", "surrogatepass")) if text else 0, *[None] * len(rest)]
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["uid", "doc_id", "n_bytes", "pre_token", "n"])

    return run


def frequent(vocabulary: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows: the largest frequencies down to the bound of an eighth of a power of two."""
    level = F.floor(F.log2("n") * 8)
    least, seen = None, 0
    for r in vocabulary.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # some hundred levels
        seen += r["count"]
        if seen > most:
            break
        least = r["level"]
    return vocabulary.where(level >= least) if least is not None else vocabulary.limit(0)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    Counts are those of the library's ``encode(text, add_special_tokens=False)``. Null and empty texts have 0. Repeated rows are counted each; a null
    doc_id stays null. An empty table gives an empty result; extra columns are ignored.
    """
    path = path or tokenizer_path()
    spark = docs.sparkSession
    counts = docs.select("text").mapInArrow(vocabulary_rows(path), "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    vocabulary = written(counts.mapInArrow(piece_rows(path), "pre_token string, n long, pieces int"))
    top = frequent(vocabulary, head).select("pre_token", "pieces").toPandas()
    known = spark.sparkContext.broadcast(dict(zip(top["pre_token"].tolist(), top["pieces"].tolist(), strict=True)))
    # Written, so that a task that runs again changes no uid that others have seen.
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(document_rows(path, known), "uid long, doc_id long, n_bytes long, pre_token string, n long"))
    whole = rows.where("pre_token is null").select("uid", "doc_id", "n_bytes", "n")
    joined = rows.where("pre_token is not null").select("uid", "pre_token", "n").join(vocabulary.select("pre_token", "pieces"), "pre_token")
    parts = joined.select("uid", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n"))
    out = whole.unionByName(parts).groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
