import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def as_docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)


# ---- 1 -------------------------------------------------------------------------------------------
CAPTURE = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, headers map<string,string>, payload_digest string"


def test_revisits(spark):
    from tidemark.llm.warc import canonical_url, resolve_revisits

    h = {"etag": '"a"', "content-type": "text/html", "date": "1"}
    caps = spark.createDataFrame(
        [
            (1, "http://www.X.org/p/?utm_source=q&b=2&a=1#f", 10, "response", 200, '"a"', None, h, "d1"), (2, "https://x.org/p?a=1&b=2", 20, "response", 200, '"b"', "mon", h, "d2"), (3, "http://x.org/p?b=2&a=1", 30, "revisit", 304, 'W/"b"', None, {"date": "9", "content-length": "0"}, None),
            (4, "x.org/p?a=1&b=2", 15, "revisit", 304, '"zzz"', None, None, None), (5, "http://x.org/p?a=1&b=2", 5, "revisit", 304, '"a"', None, {}, None), (6, "http://x.org/p?a=1&b=2", 40, "revisit", 304, None, "tue", {}, None), (7, "http://x.org/p?a=1&b=2", 41, "revisit", 304, None, None, {}, None),
            (8, None, 50, "revisit", 304, '"a"', None, {}, None), (9, "http://x.org/p?a=1&b=2", None, "revisit", 304, '"a"', None, {}, None), (10, "http://x.org/p?a=1&b=2", 35, "response", 503, '"c"', None, {}, "d3"), (3, "http://x.org/p?b=2&a=1", 30, "revisit", 304, 'W/"b"', None, {"date": "9", "content-length": "0"}, None),
        ],
        CAPTURE,
    ).withColumn("full", F.lit(1))
    out = resolve_revisits(caps).collect()
    by = {r["record_id"]: r for r in out}
    assert len(out) == 8 and {k: r["outcome"] for k, r in by.items()} == {3: "resolved", 4: "mismatch", 5: "orphan", 6: "mismatch", 7: "unchecked", 8: "orphan", 9: "orphan"}
    assert by[3]["response_id"] == 2 and by[4]["response_id"] == 1 and by[3]["merged"] == {"etag": '"a"', "content-type": "text/html", "date": "9"} and by[3]["payload_digest"] == "d2"
    assert resolve_revisits(caps.limit(0)).count() == 0
    url = spark.createDataFrame([("HTTP://Www.A.com:80/x/?ref=1&z=2",), ("https://a.com",), (None,)], "u string").select(canonical_url(F.col("u")).alias("u"))
    assert rows(url, "u") == sorted([("a.com/x?z=2",), ("a.com",), (None,)], key=repr)


def test_revisits_against_brute_force(spark):
    from tidemark.llm.warc import resolve_revisits

    rng = random.Random(1)
    data = []
    for i in range(600):
        response = rng.random() < 0.4
        url = "http://hot.org/" if rng.random() < 0.5 else f"http://h.org/{rng.randrange(20)}"
        data.append((i, url, rng.randrange(3000), "response" if response else "revisit", 200 if response else 304, f'"{rng.randrange(3)}"', None, {}, str(i)))
    got = {r["record_id"]: (r["outcome"], r["response_id"]) for r in resolve_revisits(spark.createDataFrame(data, CAPTURE)).collect()}
    for r in (x for x in data if x[3] == "revisit"):
        best = max(((x[2], x[0], x[5]) for x in data if x[3] == "response" and x[1] == r[1] and (x[2], x[0]) < (r[2], r[0])), default=None)
        assert got[r[0]] == (("orphan", None) if best is None else ("resolved" if best[2] == r[5] else "mismatch", best[1]))


# ---- 2 -------------------------------------------------------------------------------------------
def shingle_bag(text, width=5):
    import re

    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter()


def brute_classes(texts, threshold=0.8):
    bags = [shingle_bag(t) for t in texts]
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            whole = sum((bags[i] | bags[j]).values())
            if bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) / whole >= threshold:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(texts))}


def test_near_duplicates_against_brute_force(spark):
    from tidemark.llm.near_dup import drop_near_duplicates, near_dup_classes

    rng = random.Random(5)
    vocab = [f"word{i}" for i in range(400)]
    common = [rng.choice(vocab) for _ in range(40)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randrange(3, 160))]
        if rng.random() < 0.4:
            base += common  # a passage that unrelated documents share
        texts.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            base = copy if rng.random() < 0.5 else base  # chains of edits
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    texts += ["la la la la la la " * 30, "la la la la la la " * 29, "a b", "a b", "A  b.", "", None, "..."]
    out = near_dup_classes(as_docs(spark, texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == brute_classes(texts)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in out)
    sizes = Counter(r["class_id"] for r in out)
    assert all(r["class_size"] == sizes[r["class_id"]] for r in out)
    kept = drop_near_duplicates(as_docs(spark, texts))
    assert {r["doc_id"] for r in kept.collect()} == set(sizes)


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    from tidemark.llm.near_dup import near_dup_classes

    out = near_dup_classes(odd_docs).collect()
    assert len(out) == 12
    by = {r["doc_id"]: r for r in out}
    assert by[2]["class_id"] == 1 and by[3]["class_id"] == 1 and by[9]["class_id"] == 7 and by[4]["kept"] and by[5]["kept"] and by[6]["kept"] and by[7]["class_size"] == 3
    assert near_dup_classes(no_docs).count() == 0


def test_odd_sketches_bound_the_difference(spark):
    from tidemark.llm.near_dup import odd_sketch, unequal_bits

    rng, bags = random.Random(7), []
    for n in (0, 1, 3, 40, 300, 5000):
        bag = Counter(rng.randrange(1, 2**60) for _ in range(n)) + Counter({5: n // 3})
        near = bag + Counter(rng.randrange(1, 2**60) for _ in range(n // 8))
        bags += [bag, near]
    flat = [(v, i, c) for i, bag in enumerate(bags) for v, c in bag.items()]
    value, row, count = (np.array(x) for x in zip(*flat, strict=True))
    words, size = odd_sketch(value.astype(np.uint64), row, count, len(bags))
    parts = [p.tolist() for p in np.split(words, np.cumsum(size)[:-1])]
    pairs = spark.createDataFrame([(i, parts[i], parts[i + 1]) for i in range(0, len(bags), 2)], "i int, a array<bigint>, b array<bigint>")
    for i, bits in pairs.select("i", unequal_bits(F.col("a"), F.col("b"))).collect():
        apart = ((bags[i] - bags[i + 1]) + (bags[i + 1] - bags[i])).total()
        assert bits <= apart and (bits > 0) == (apart > 0) and bits >= apart / 2


def test_bag_minhash_is_unbiased():
    from tidemark.llm.common import mix
    from tidemark.llm.near_dup import bag_minhash

    rng = np.random.default_rng(0)
    base = rng.integers(1, 2**62, 60).astype(np.uint64)
    a = rng.integers(1, 9, 60)
    b = np.where(rng.random(60) < 0.7, a, rng.integers(0, 9, 60))
    values, owner, counts = [], [], []
    for k in range(300):
        for side, c in enumerate((a, b)):
            some = c > 0
            values.append(mix(base + np.uint64(k * 977 + 1))[some])
            owner.append(np.full(some.sum(), 2 * k + side))
            counts.append(c[some])
    sig = bag_minhash(np.concatenate(values), np.concatenate(owner), np.concatenate(counts), 600, 120)
    assert abs((sig[0::2] == sig[1::2]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.01


# ---- 3 -------------------------------------------------------------------------------------------
def test_poisson_mix_hits_the_target(spark):
    from tidemark.llm.mixing import poisson_mix

    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x" * 9).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"), F.lit(9).cast("long").alias("n_chars"))
    out = poisson_mix(docs, {"hot": 1.0, "b": 3.0}, measure="rows")
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["hot"] - 5000) < 250 and abs(n["b"] - 15000) < 450 and "c" not in n
    again = poisson_mix(docs.repartition(7), {"hot": 1.0, "b": 3.0}, measure="rows")
    assert rows(out, "doc_id", "copy") == rows(again, "doc_id", "copy")
    big = poisson_mix(docs.where("doc_id < 300"), {"hot": 1.0}, measure="rows", budget=20_000.0)  # rate 200, in parts
    counts = np.array([r["count"] for r in big.groupBy("doc_id").count().collect()])
    assert len(counts) == 100 and abs(counts.mean() - 200) < 6 and 100 < counts.var() < 320


def test_poisson_mix_odd_rows(odd_docs, no_docs):
    from tidemark.llm import mixing

    assert mixing.poisson_mix(no_docs).count() == 0
    out = mixing.poisson_mix(odd_docs, budget=1e6)
    assert {"copy", "n_copies", "mix_key", "label"} <= set(out.columns)
    assert {r["doc_id"] for r in out.collect()} == {1, 2, 3, 4, 5, 6, 7, 9, 10, 11, None}
    whole = rows(out, "doc_id", "copy")
    before, mixing.MOST_BROADCAST = mixing.MOST_BROADCAST, 0
    try:
        assert rows(mixing.poisson_mix(odd_docs, budget=1e6), "doc_id", "copy") == whole
    finally:
        mixing.MOST_BROADCAST = before


# ---- 4 -------------------------------------------------------------------------------------------
def brute_hits(text, items, width=10):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(width, len(v))
        for k in range(len(v) - n + 1 if v else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(item)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def test_contamination_against_brute_force(spark, odd_docs, no_docs):
    from tidemark.llm.decontam import contamination, drop_contaminated

    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 9, 10, 11, 25])))) for i in range(12)] + [(12, "same same same"), (13, None), (14, ""), (15, "v1"), (100, " ".join(["rep"] * 14))]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += [t[: len(t) // 2] + " " + items[rng.randrange(12)][1].upper() + ". " + t for t in texts[:20]] + ["same same same same", " ".join(["rep"] * 20), None, "", "!!"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {r["doc_id"]: r for r in contamination(as_docs(spark, texts), bench).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == brute_hits(t, items), i
        assert r["contaminated"] == (r["n_hit"] > 0)
    clean = {r["doc_id"] for r in drop_contaminated(as_docs(spark, texts), bench).collect()}
    assert clean == {i for i in out if not out[i]["contaminated"]}
    assert contamination(no_docs, bench).count() == 0 and contamination(odd_docs, bench.limit(0)).where("contaminated").count() == 0
    odd = contamination(odd_docs, spark.createDataFrame([(1, "one two"), (2, "words here without any")], "item_id long, text string")).where("contaminated").collect()
    assert sorted((r["doc_id"] or 0) for r in odd) == [0, 7, 7, 9]


# ---- 5 -------------------------------------------------------------------------------------------
def test_language_mixture(spark, no_docs):
    from tidemark.llm.langid import identify, keep_identified

    rng = random.Random(3)
    words = {"en": ["the", "thing", "over", "with", "that", "there"], "de": ["schön", "über", "nicht", "keine", "straße", "doch"], "fr": ["être", "où", "ça", "leur", "mais", "avec"]}
    data, kinds = [], {}
    for i in range(600):
        kind = rng.choice(list(words))
        data.append((i, " ".join(rng.choice(words[kind]) for _ in range(30)), kind, "s", 1))
        kinds[i] = kind
    half = " ".join(rng.choice(words["en"]) for _ in range(60)) + " " + " ".join(rng.choice(words["de"]) for _ in range(40))
    data += [(1000, half, None, "s", 1), (1001, None, "en", "s", 1), (1002, "12 + 3…", "en", "s", 1), (None, "the thing", None, "s", 1), (1003, "", "fr", "s", 1)]
    docs = spark.createDataFrame(data, DOCS).withColumn("score", F.lit(1)).withColumn("mixture", F.lit(2))
    out = {r["doc_id"]: r for r in identify(docs).collect()}
    assert all(out[i]["lang_pred"] == k for i, k in kinds.items()) and out[1000]["lang_pred"] == "en"
    share = dict(x.split(":") for x in out[1000]["mixture"].split(";"))
    assert set(share) == {"en", "de"} and abs(float(share["en"]) - 0.6) < 0.05
    assert [out[i]["lang_pred"] for i in (1001, 1002, 1003)] == ["und"] * 3 and out[1002]["score"] == 0.0
    assert sum(r["held_out"] for r in out.values()) == docs.where("pmod(crc32(encode(cast(doc_id as string), 'UTF-8')), 4) = 2").count()
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert identify(no_docs).count() == 0
    assert {r["lang_pred"] for r in identify(docs, no_docs).collect()} == {"und"}


# ---- 6 -------------------------------------------------------------------------------------------
def test_chat_round_trip():
    from tidemark.llm.chat import CHALLENGE, ESCAPED, read_back, render

    rng = random.Random(4)
    parts = ["\\", "###", "### ", "\n", "</turn>", "\n</turn>\n", ":", ":\n", "a", "é", "😀", "### user:\n", "\\###", ""]
    for _ in range(500):
        turns = [("".join(rng.choice(parts) for _ in range(rng.randrange(4))) if rng.random() < 0.3 else rng.choice(["user", "assistant"]), "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for _ in range(rng.randrange(5))]
        text, spans = render(turns)
        assert read_back(text) == turns
        assert [ESCAPED.sub(r"\1", text[a : a + n]) for a, n in spans] == [t for r, t in turns if r == "assistant"]
    assert read_back(render([("user", CHALLENGE), ("assistant", CHALLENGE)])[0]) == [("user", CHALLENGE), ("assistant", CHALLENGE)]


def test_chat_layouts(spark):
    import json

    from tidemark.llm.chat import format_records, read_back, read_back_digests, records_of_turns

    want = [("user", "q"), ("assistant", "a")]
    layouts = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, {"prompt": "q", "response": "a"}, {"completion": "a", "prompt": "q"}, {"instruction": "q", "output": "a"}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"prompt": "q", "response": "a", "system": None},
    ]
    records = [(i, json.dumps(x)) for i, x in enumerate(layouts)] + [(90, json.dumps({"instruction": "q", "input": "i", "output": "a"})), (91, '{"other": 1}'), (92, "no json"), (93, None)]
    out = {r["conv_id"]: r for r in format_records(spark.createDataFrame(records, "conv_id long, record string").withColumn("formatted", F.lit(1))).collect()}
    assert all(read_back(out[i]["formatted"]) == want for i in range(len(layouts)))
    assert read_back(out[90]["formatted"]) == [("user", "q\n\ni"), ("assistant", "a")] and [out[i]["formatted"] for i in (91, 92, 93)] == [None] * 3 and out[91]["fingerprint"]
    turns = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, None, "x"), (2, 0, "user", "same"), (2, 0, "user", "same"), (None, 0, "user", "n")], "conv_id long, turn long, role string, text string").withColumn("record", F.lit(0))
    got = {r["conv_id"]: r for r in read_back_digests(format_records(records_of_turns(turns))).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"\nx\nassistant\n\n").hexdigest() and got[1]["loss_chars"] == 0 and got[2]["n_turns"] == 2 and None in got
    assert read_back_digests(format_records(records_of_turns(turns.limit(0)))).count() == 0


# ---- 7 -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 5, 16, 333])
def test_shards_are_even(spark, n):
    from tidemark.llm.sharding import balanced_shards

    texts = [f"t{i // 3}" if i % 2 else "hot" for i in range(n)]
    if n > 20:
        texts[3], texts[4] = None, ""
    out = balanced_shards(as_docs(spark, texts)).collect()
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert len(out) == n and sorted(r["doc_id"] for r in out) == list(range(n))
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(16))
    sizes = [len(by.get(k, [])) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 for r in out)


def test_label_propagation_joins_groups(spark, odd_docs):
    from tidemark.llm.sharding import balanced_shards

    texts = [f"group {i // 4}" for i in range(2000)] + [f"alone {i}" for i in range(2000)]
    out = balanced_shards(as_docs(spark, texts)).collect()
    now, first = defaultdict(set), defaultdict(set)
    for r in out:
        if r["linked"]:
            now[r["doc_id"] // 4].add(r["shard"])
            first[r["doc_id"] // 4].add(r["first_shard"])
    split = lambda d: sum(len(s) > 1 for s in d.values())
    assert len(now) == 500 and split(first) > 400 and split(now) < 100
    odd = balanced_shards(odd_docs).collect()
    assert len(odd) == 12 and {r["text_crc32"] for r in odd if r["doc_id"] == 4} == {None}


# ---- 8 -------------------------------------------------------------------------------------------
def test_digest_index(spark, odd_docs, no_docs):
    from tidemark.llm.exact_dedup import DigestIndex, exact_duplicates

    texts = ["Same", "same", "sAME", "other", None, "", "é", "É"]
    out = {r["doc_id"]: r for r in exact_duplicates(as_docs(spark, texts)).collect()}
    assert [out[i]["keep_id"] for i in range(8)] == [2, 2, 2, 3, 5, 5, 6, 7] and [out[i]["group_size"] for i in range(8)] == [3, 3, 3, 1, 2, 2, 1, 1]
    assert out[0]["text_sha256"] == hashlib.sha256(b"same").hexdigest() and sorted(i for i in out if out[i]["kept"]) == [2, 3, 5, 6, 7]
    index = DigestIndex(spark, buckets=4)
    index.ingest(as_docs(spark, ["x", "y"]), "1")
    second = {r["doc_id"]: r for r in index.ingest(spark.createDataFrame([(7, "Y", "", "", 0), (8, "z", "", "", 0), (9, "Z", "", "", 0)], DOCS), "2").collect()}
    assert (second[7]["keep_id"], second[7]["kept"]) == (1, False) and (second[8]["keep_id"], second[8]["kept"], second[9]["kept"]) == (9, False, True)
    assert DigestIndex(spark, index.path).table().count() == 3
    assert index.ingest(no_docs, "3").count() == 0 and index.table().count() == 3
    odd = exact_duplicates(odd_docs).collect()
    assert len(odd) == 12 and sum(r["kept"] for r in odd if r["doc_id"] in (7, 9)) == 1 and [r["kept"] for r in odd if r["doc_id"] is None] == [True]


# ---- 9 -------------------------------------------------------------------------------------------
def test_token_counts_match_the_library(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    from tidemark.llm.token_counts import token_counts, tokenizer_path

    t = Tokenizer.from_file(tokenizer_path())
    texts = ["It's 12 o'clock!", "a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "  \n\t ", "", None, "É é ﬁ İ", "😀👍🏽 ¯\\_(ツ)_/¯", "don't we'll THEY'VE", "x" * 5000, "日本語 テスト", "naïve " * 3000]
    for head in (300_000, 2):
        out = {r["doc_id"]: r for r in token_counts(as_docs(spark, texts), head=head).collect()}
        assert {i: out[i]["n_tokens"] for i in out} == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}
        assert all(out[i]["n_bytes"] == len((x or "").encode()) and out[i]["over_limit"] == (out[i]["n_tokens"] > 2048) for i, x in enumerate(texts))
    assert token_counts(no_docs).count() == 0
    odd = token_counts(odd_docs).collect()
    assert len(odd) == 12 and sum(r["doc_id"] == 7 for r in odd) == 2


# ---- 10 ------------------------------------------------------------------------------------------
def test_quality(spark, odd_docs, no_docs):
    from tidemark.llm.quality import quality_scores

    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["plain", "words", "in", "order", "and", "more", "of", "them"]) for _ in range(rng.randrange(40, 400))) + "."
    junk = lambda: " ".join(rng.choice(["BUY!!", "NOW$$$", "click###", "win|", "@x"]) for _ in range(rng.randrange(40, 400)))
    data = [(i, good() + " " + junk() if i % 2 else good() + " " + good(), "en", "s", 1) for i in range(500)]
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, 0) for i in range(500)] + [(9999, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality_scores(spark.createDataFrame(data, DOCS).withColumn("bag", F.lit(1)), labels).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == 500 and sum((r["score"] >= 0.7) == (r["doc_id"] % 2 == 0) for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    odd = quality_scores(odd_docs.unionByName(spark.createDataFrame(data, DOCS), allowMissingColumns=True), labels).collect()
    assert len(odd) == 512 and all(r["score"] is not None for r in odd)
    assert quality_scores(no_docs, labels).count() == 0 and {r["score"] for r in quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}


def test_attention_gradients():
    from tidemark.llm.quality import GATE, HIDDEN, WIDTH, forward, gradients

    rng = np.random.default_rng(1)
    p = {"W": rng.normal(0, 0.2, (WIDTH, HIDDEN)), "b": rng.normal(0, 0.2, HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.5, GATE), "c": rng.normal(0, 0.5, HIDDEN), "d": np.zeros(1)}
    count = np.array([1, 3, 5])
    first, x, y = np.cumsum(count) - count, rng.normal(size=(9, WIDTH)), np.array([1.0, 0.0, 1.0])

    def loss(q):
        s = forward(q, x, first, count)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    g = gradients(p, x, first, count, y)
    for k in p:
        at = (0,) * p[k].ndim
        up, down = {**p, k: p[k].copy()}, {**p, k: p[k].copy()}
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[k][at]) < 1e-6


# ---- pipeline --------------------------------------------------------------------------------------
def test_pipeline(spark):
    import corpus_pipeline
    from tidemark.llm.mixing import poisson_mix

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        texts = {r["doc_id"]: r["text"] for r in before.collect()}
        after = spark.createDataFrame(stage(spark, before, sf).collect() or [], stage(spark, before, sf).schema)
        ids = Counter(r["doc_id"] for r in after.collect())
        if name == "language_id":
            assert set(ids) == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
        elif name == "near_dedup":
            order = sorted(texts)
            classes = brute_classes([texts[i] for i in order])
            assert set(ids) == {order[i] for i, c in classes.items() if i == c}
        elif name == "decontaminate":
            assert set(ids) == {i for i, t in texts.items() if brute_hits(t, list(bench.items()))[1] == 0}
        elif name == "mix_sources":
            assert ids == Counter(r["doc_id"] for r in poisson_mix(before).collect())
        else:
            assert sum(ids.values()) == before.count()
        if name != "shard":
            assert after.columns == columns
        before = after
