"""Ids that are null or shared, clashing columns, hostile texts, and brute-force versions of what SQL cannot express."""

import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import CAPTURE, DOCS, as_docs, brute_hits, rows, shingle_bag

PROSE = " ".join(f"word{i}" for i in range(40))
OTHER = " ".join(f"other{i}" for i in range(40))


@pytest.fixture(scope="session")
def clashing():
    """Adds columns that operators use or return themselves, each with a value of its own row."""
    names = ["size", "weight", "u", "source_key", "rate", "parts", "below", "salt", "copy", "n_copies", "mix_key", "row", "key", "tid", "spot", "kept", "found", "close", "lang_pred", "score", "mixture", "id", "label", "hub", "shard", "slot", "n"]

    def add(df):
        return df.select("*", *[F.concat_ws("/", F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])

    return add


# ---- 1 -------------------------------------------------------------------------------------------
def test_revisits_with_a_wrong_clock_and_odd_urls(spark):
    from tidemark.llm.warc import resolve_revisits

    rng, data = random.Random(8), []
    urls = ["http://hot.org/", "", "http://l.org/" + "x" * 50_000]
    for i in range(400):
        response = rng.random() < 0.4
        url = urls[0] if rng.random() < 0.6 else rng.choice(urls)
        data.append((None if i % 50 == 0 else i, url, 10**15 if i == 7 else rng.randrange(500), "response" if response else "revisit", 200 if response else 304, f'"{rng.randrange(2)}"', None, None, str(i)))
    low = -1
    best = lambda r: max(((x[2], low if x[0] is None else x[0]) for x in data if x[3] == "response" and x[1] == r[1] and (x[2], low if x[0] is None else x[0]) < (r[2], low if r[0] is None else r[0])), default=None)
    got = Counter((r["record_id"], r["ts"], r["response_ts"], r["response_id"]) for r in resolve_revisits(spark.createDataFrame(data, CAPTURE)).collect())
    want = Counter((r[0], r[2], b[0] if b else None, None if not b or b[1] == low else b[1]) for r in data if r[3] == "revisit" for b in [best(r)])
    assert got == want


# ---- 2 -------------------------------------------------------------------------------------------
def test_near_duplicates_by_row(spark, clashing):
    from tidemark.llm.near_dup import drop_near_duplicates, near_dup_classes

    def kept(data):
        docs = clashing(spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(data)], DOCS))
        out = drop_near_duplicates(docs)
        assert out.columns == docs.columns
        return sorted((r["n_chars"] for r in out.collect())), {r["doc_id"]: r["class_id"] for r in near_dup_classes(docs).collect()}

    near = PROSE + " more"
    assert kept([(1, PROSE), (5, PROSE), (5, OTHER)])[0] == [0, 2]  # rows of one id go by their own text
    stay, classes = kept([(1, PROSE), (2, near), (None, PROSE)])
    assert stay == [0] and classes == {1: 1, 2: 1, None: 1}
    stay, classes = kept([(None, PROSE), (None, near), (None, OTHER), (None, "..."), (None, None), (3, None)])
    assert len(stay) == 5 and {2, 3, 4, 5} < set(stay) and classes[None] is None
    stay, _ = kept([(4, PROSE), (4, PROSE), (4, near), (9, OTHER), (9, OTHER)])  # of repeated rows any one
    assert len(stay) == 2 and len({s in (3, 4) for s in stay}) == 2


def test_crowded_buckets_are_dealt_over_pieces(spark, monkeypatch):
    from test_operators import brute_classes
    from tidemark.llm import common, near_dup

    monkeypatch.setattr(near_dup, "PAIRS_A_PIECE", 3)
    monkeypatch.setattr(near_dup, "MEMBERS_A_PIECE", 2)
    monkeypatch.setattr(common, "LEAST_HOT", 4)
    rng, texts = random.Random(9), []
    for k in range(3):  # families whose members differ in a few words, around the threshold
        base = [f"f{k}w{i}" for i in range(60)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(60)] = f"x{rng.randrange(9)}"
            texts.append(" ".join(copy))
    assert {r["doc_id"]: r["class_id"] for r in near_dup.near_dup_classes(as_docs(spark, texts)).collect()} == brute_classes(texts)


def test_near_duplicate_recall_against_all_rows(spark):
    """Queries: ids divisible by 5; each row that is similar by the whole multisets has to be in the query's class."""
    from tidemark.llm.near_dup import near_dup_classes

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bags = {r["doc_id"]: shingle_bag(r["text"]) for r in docs.collect()}
    classes = {r["doc_id"]: r["class_id"] for r in near_dup_classes(docs).collect()}
    found = missed = 0
    for q in (i for i in bags if i % 5 == 0 and bags[i]):
        for i, bag in bags.items():
            if i != q and bag and sum((bag & bags[q]).values()) >= 0.8 * sum((bag | bags[q]).values()):
                found, missed = found + (classes[i] == classes[q]), missed + (classes[i] != classes[q])
    assert found > 10 and found / (found + missed) >= 0.9


# ---- 3 -------------------------------------------------------------------------------------------
def test_mixture_keeps_the_callers_columns(spark, odd_docs, no_docs, clashing):
    from tidemark.llm.mixing import mixed, poisson_mix

    docs = clashing(odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    out = mixed(docs, budget=1e6)
    assert out.columns == docs.columns
    as_rows = lambda df: {tuple(r) for r in df.collect()}
    assert as_rows(out) == as_rows(docs)
    added = {"copy", "n_copies", "mix_key"}
    whole = poisson_mix(docs, budget=1e6)
    rest = [c for c in docs.columns if c not in added]
    assert set(whole.columns) == set(docs.columns) and as_rows(whole.select(*rest)) == as_rows(docs.select(*rest))
    assert mixed(no_docs).count() == 0


# ---- 4 -------------------------------------------------------------------------------------------
def test_contamination_by_row(spark, clashing):
    from tidemark.llm.decontam import contamination, drop_contaminated

    leak = " ".join(f"leak{i}" for i in range(12))
    data = [(1, leak), (1, PROSE), (None, f"{PROSE} {leak}"), (None, PROSE), (None, None), (2, leak), (2, leak), (3, "")]
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(data)], DOCS))
    bench = spark.createDataFrame([(5, leak), (None, leak), (6, leak + " more")], "item_id long, text string")
    out = drop_contaminated(docs, bench)
    assert out.columns == docs.columns and sorted(r["n_chars"] for r in out.collect()) == [1, 3, 4, 7]
    got = rows(contamination(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "n_near_items")
    assert got == sorted([(1, 12, 12, 2, 2), (1, 40, 0, 0, 0), (None, 52, 12, 2, 2), (None, 40, 0, 0, 0), (None, 0, 0, 0, 0), (2, 12, 12, 2, 2), (2, 12, 12, 2, 2), (3, 0, 0, 0, 0)], key=repr)
    assert drop_contaminated(docs, bench.limit(0)).count() == 8


def test_contamination_with_few_terms_a_pass(spark, monkeypatch):
    from tidemark.llm import decontam

    monkeypatch.setattr(decontam, "BLOCK", 7)  # over ten passes
    monkeypatch.setattr(decontam, "POSTINGS_A_PIECE", 3)
    rng = random.Random(12)
    vocab = [f"v{i}" for i in range(90)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 10, 14])))) for i in range(15)]
    texts = [" ".join(rng.choice(vocab) for _ in range(50)) + " " + (items[rng.randrange(15)][1] if i % 2 else "") for i in range(30)]
    out = decontam.contamination(as_docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in out} == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def test_proximity_against_brute_force(spark):
    from tidemark.llm.decontam import contamination

    rng = random.Random(10)
    vocab = [f"v{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 4, 5, 10, 12, 10, 2, 1])] + [(8, "twice twice"), (9, "v1 absent")]
    texts = []
    for _ in range(40):
        part = items[rng.randrange(6)][1].split()[:10]
        rng.shuffle(part)
        for _ in range(rng.randrange(8)):
            part.insert(rng.randrange(len(part)), rng.choice(vocab))
        texts.append(" ".join([rng.choice(vocab) for _ in range(rng.randrange(9))] + part + [rng.choice(vocab) for _ in range(rng.randrange(9))]))
    texts += ["twice", "twice a twice", "twice " + "a " * 14 + "twice", "twice " + "a " * 13 + "twice", ""]

    def close(text):
        w = text.split()
        spans = [Counter(w[k : k + 15]) for k in range(max(1, len(w) - 14))]
        return sum(any(not Counter(v[k : k + 10]) - s for k in range(max(1, len(v) - 9)) for s in spans) for v in (t.split() for _, t in items))

    out = {r["doc_id"]: r["n_near_items"] for r in contamination(as_docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert out == {i: close(t) for i, t in enumerate(texts)}
    assert [out[40 + k] for k in range(4)] == [0, 1, 0, 1]


# ---- 5 -------------------------------------------------------------------------------------------
def test_a_mixture_of_five_languages(spark):
    from tidemark.llm.langid import identify

    rng = random.Random(13)
    words = {f"l{k}": [f"{a}{b}{k * 'z'}{a}" for a in "abcdefghij"[k::5] for b in "klmnopq"] for k in range(5)}
    data = [(i, " ".join(rng.choice(words[f"l{i % 5}"]) for _ in range(40)), f"l{i % 5}", "s", 1) for i in range(400)]
    mixed = " ".join(rng.choice(words[f"l{k}"]) for k in range(5) for _ in range(200 + 50 * k))
    data.append((1000, mixed, None, "s", 1))
    data.append((1001, " ".join(rng.choice(words["l2"]) for _ in range(60_000)), None, "s", 1))
    out = {r["doc_id"]: r for r in identify(spark.createDataFrame(data, DOCS)).collect()}
    share = {k: float(v) for k, v in (x.split(":") for x in out[1000]["mixture"].split(";"))}
    assert set(share) == set(words) and all(abs(share[f"l{k}"] - (200 + 50 * k) / 1500) < 0.02 for k in range(5)) and out[1000]["lang_pred"] == "l4"
    assert out[1001]["lang_pred"] == "l2" and out[1001]["score"] == 1.0


def test_language_sets_against_a_plain_search():
    from tidemark.llm.langid import PENALTY, language_sets

    rng = np.random.default_rng(4)
    counts = np.array([1, 2, 5, 30, 30, 80, 80, 200, 200, 300])
    logs = []
    for k, n in enumerate(counts):
        kinds = rng.integers(0, 1 + k % 4, n) if k % 2 else np.zeros(n, int)
        logs.append(rng.normal(-6, 2, (n, 4)) + 5 * (kinds[:, None] == np.arange(4)))
    words = np.concatenate(logs)
    words = (words - words.max(1, keepdims=True)).astype(np.float32)
    got = language_sets(words, np.cumsum(counts) - counts, counts)

    def em(p, allowed):
        s = np.where(allowed, 1 / allowed.sum(), 0.0)
        for _ in range(4000):
            part = p * s
            s = (part / part.sum(1, keepdims=True)).mean(0)
        return s, np.log((p * s).sum(1)).sum()

    at = 0
    for k, n in enumerate(counts):
        own = words[at : at + n].astype(np.float64)
        at += n
        p, penalty = np.exp(own), PENALTY * math.log(max(n, 2))
        options = [(own.sum(0).max(), np.eye(4)[own.sum(0).argmax()])]
        order = np.argsort(-em(p, np.ones(4, bool))[0])
        for size in (2, 3, 4):
            s, value = em(p, np.isin(np.arange(4), order[:size]))
            options.append((value - penalty * (size - 1), s))
        best = max(options, key=lambda o: o[0])[1]
        assert np.abs(got[k] - best).max() < 0.01, (k, got[k], best)


# ---- 6 -------------------------------------------------------------------------------------------
def test_chat_records_with_other_fields(spark):
    from tidemark.llm.chat import format_records, read_back, read_back_digests

    want = [("user", "q"), ("assistant", "a")]
    records = [
        {"id": 7, "source": {"url": "x"}, "messages": [{"role": "user", "content": "q", "t": 1}, {"role": "assistant", "content": "a"}]}, {"prompt": "q", "response": "a", "tags": []}, {"instruction": "q", "input": None, "output": "a", "score": 0.5},
        {"messages": []}, {"prompt": "q", "response": None}, {"system": "s", "prompt": "q", "completion": "a"}, {"foo": "bar"}, {}, {"messages": None}, {"prompt": "x" * 300_000, "response": "###"}, {"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]},
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(records)] + [(None, "[1]"), (None, json.dumps(records[1]))], "conv_id long, record string")
    out = {r["conv_id"]: r["formatted"] for r in format_records(df).where("conv_id is not null").collect()}
    assert all(read_back(out[i]) == want for i in (0, 1, 2)) and out[3] == "" and read_back(out[4]) == [("user", "q"), ("assistant", "")]
    assert read_back(out[5]) == [("system", "s"), *want] and [out[i] for i in (6, 7, 8)] == [None] * 3
    assert read_back(out[9]) == [("user", "x" * 300_000), ("assistant", "###")] and read_back(out[10]) == [("user", ""), ("assistant", "a")]
    digests = read_back_digests(format_records(df)).collect()
    assert len(digests) == 13 and sum(r["n_turns"] is None for r in digests) == 4 and {r["conv_id"]: r["n_turns"] for r in digests}[3] == 0


def test_chat_query_uses_several_layouts(spark):
    from tidemark.llm.chat import op6_chat_format, records_of_turns

    out = op6_chat_format(spark, "/root/testdata/sf0.01")
    assert out.select("fingerprint").distinct().count() >= 6 and out.where("turns_sha256 is null").count() == 0
    lone = records_of_turns(spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "a"), (3, 0, "human", "b")], "conv_id long, turn long, role string, text string"))
    assert [json.loads(r["record"]) for r in lone.orderBy("conv_id").collect()] == [{"turns": [{"role": "user", "text": "a"}]}] * 2 + [{"turns": [{"role": "human", "text": "b"}]}]


# ---- 7 -------------------------------------------------------------------------------------------
def test_shards_without_ids_and_with_a_large_group(spark, monkeypatch):
    from tidemark.llm import sharding

    monkeypatch.setattr(sharding, "PIECE", 20)
    docs = spark.createDataFrame([(None if i % 3 == 0 else i, "hot" if i % 2 else f"t{i // 4}", "en", "s", 1) for i in range(900)] + [(None, None, None, None, None)] * 100, DOCS)
    out = sharding.balanced_shards(docs).collect()
    sizes = Counter(r["shard"] for r in out)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert len(out) == 1000 and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_cut_fewer_links(spark):
    """Links between rows of equal text whose ends are in different shards, counted before and after."""
    from tidemark.llm.sharding import balanced_shards

    rng = random.Random(14)
    texts = [t for g in range(120) for t in [f"group {g}"] * rng.choice([2, 3, 5, 9])] + [f"alone {i}" for i in range(600)]
    rng.shuffle(texts)
    out = {r["doc_id"]: r for r in balanced_shards(as_docs(spark, texts)).collect()}
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t].append(i)
    cut = lambda c: sum(out[a][c] != out[b][c] for g in groups.values() for a in g for b in g if a < b)
    assert cut("shard") < 0.15 * cut("first_shard")
    sizes = Counter(r["shard"] for r in out.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1


# ---- 8 -------------------------------------------------------------------------------------------
def test_later_batches_are_dropped_by_the_index(spark, no_docs):
    from tidemark.llm.exact_dedup import DigestIndex, exact_duplicates

    texts = [random.Random(i % 37).choice("abcdefgh") + str(i % 37) for i in range(200)]
    index = DigestIndex(spark, buckets=3)
    out = {r["doc_id"]: r for r in exact_duplicates(as_docs(spark, texts), index, batches=4).collect()}
    last, size = {t: i for i, t in enumerate(texts)}, Counter(texts)
    assert all((out[i]["keep_id"], out[i]["kept"], out[i]["group_size"]) == (last[t], last[t] == i, size[t]) for i, t in enumerate(texts))
    assert index.table().groupBy("batch").count().count() == 1  # the first batch, of the largest ids, brought every text; three more met it
    later = {r["doc_id"]: r for r in index.ingest(spark.createDataFrame([(500, texts[0].upper(), "", "", 0), (501, "new", "", "", 0)], DOCS), "later").collect()}
    assert (later[500]["kept"], later[500]["keep_id"], later[501]["kept"]) == (False, last[texts[0]], True)
    again = {r["doc_id"]: r for r in index.ingest(spark.createDataFrame([(500, texts[0].upper(), "", "", 0), (501, "new", "", "", 0)], DOCS), "later").collect()}
    assert later == again and index.table().count() == 38 and DigestIndex(spark, index.path).buckets == 3
    assert exact_duplicates(no_docs).count() == 0
    nulls = exact_duplicates(spark.createDataFrame([(None, "x", "", "", 0), (3, "x", "", "", 0), (None, "y", "", "", 0), (None, "y", "", "", 0), (None, None, "", "", 0)], DOCS)).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["kept"], r["group_size"]) for r in nulls) == [("3", "3", True, 2), ("None", "3", False, 2), ("None", "None", True, 1), ("None", "None", True, 2), ("None", "None", True, 2)]


# ---- 9 -------------------------------------------------------------------------------------------
def test_token_counts_of_hostile_texts(spark):
    from tokenizers import Tokenizer

    from tidemark.llm.token_counts import token_counts, tokenizer_path

    t = Tokenizer.from_file(tokenizer_path())
    texts = ["hello world \x001 \x002", "\x001", "\x00 \x00", "\x00" * 50, " ".join(f"\x00{i}" for i in range(60)), "None null", "a b c", "\x0b\x0c\x85x", "ΑΣ ΑΣΑ", "é ́", "K å Å"]
    for head in (300_000, 1):
        out = {r["doc_id"]: r["n_tokens"] for r in token_counts(as_docs(spark, texts), head=head).collect()}
        assert out == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))  # keeps white space: the direct path
    out = {r["doc_id"]: r["n_tokens"] for r in token_counts(as_docs(spark, [*texts, "  two  spaces\n\n x"]), tokenizer_path("byte_bpe_50k.json")).collect()}
    assert out == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate([*texts, "  two  spaces\n\n x"])}


# ---- 10 ------------------------------------------------------------------------------------------
def test_attention_of_each_bag_alone():
    from tidemark.llm.quality import GATE, HIDDEN, WIDTH, forward

    rng = np.random.default_rng(2)
    p = {"W": rng.normal(0, 0.2, (WIDTH, HIDDEN)), "b": rng.normal(0, 0.2, HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.5, GATE), "c": rng.normal(0, 0.5, HIDDEN), "d": np.full(1, 0.1)}
    count = np.array([1, 4, 2, 7])
    x = rng.normal(size=(count.sum(), WIDTH))
    got, at = forward(p, x, np.cumsum(count) - count, count)["score"], 0
    for k, n in enumerate(count):
        hidden = [np.tanh(x[i] @ p["W"] + p["b"]) for i in range(at, at + n)]
        weigh = [math.exp(sum(p["w"][g] * math.tanh(h @ p["V"][:, g]) / (1 + math.exp(-(h @ p["U"][:, g]))) for g in range(GATE))) for h in hidden]
        z = sum(a * h for a, h in zip(weigh, hidden, strict=True)) / sum(weigh)
        assert abs(got[k] - 1 / (1 + math.exp(-(z @ p["c"] + 0.1)))) < 1e-9
        at += n


# ---- pipeline --------------------------------------------------------------------------------------
def test_pipeline_stages_on_odd_rows(spark, odd_docs, no_docs, clashing, tmp_path):
    import corpus_pipeline

    leak = " ".join(f"leak{i}" for i in range(12))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    more = spark.createDataFrame([(20, leak + " end", "en", "a", 1), (None, leak, "en", "a", 1), (21, PROSE, "en", None, 1), (21, OTHER, "en", "a", 1), (None, PROSE, "en", "a", 1), (None, re.sub("word", "third", PROSE), None, None, None)], DOCS)
    docs = clashing(odd_docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(more))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == before.columns and {tuple(r) for r in docs.collect()} <= {tuple(r) for r in before.collect()}, name
        texts = Counter(r["text"] for r in docs.collect())
        if name == "near_dedup":
            assert texts[PROSE] == 1 and texts[OTHER] == 1 and texts["one two"] == 1 and docs.where(F.col("text") == PROSE).first()["doc_id"] == 21
        if name == "decontaminate":
            assert not any("leak1 " in t for t in texts) and texts[PROSE] == 1 and texts[re.sub("word", "third", PROSE)] == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).count() == 0
