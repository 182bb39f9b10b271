"""Manifests, exact search, repaired conversations; records and indexes that once ended a job."""

import hashlib
import json
import random
import re
import subprocess
import sys
import tempfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- 11 ------------------------------------------------------------------------------------------
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    """(root, the siblings of each node, left and right, from below)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for k, i in enumerate(at):
            run, d = runs[i // 3], i % 3
            paths[k].append((run[:d], run[d + 1 :]))
        nodes, at = [h(*r) for r in runs], [i // 3 for i in at]
    return nodes[0], paths


def plain_manifest(docs):
    """Rows (doc_id, leaf, subroot, root, proof, path) by loops; docs are tuples in the order of DOCS."""
    leaves = {}
    for d in docs:
        leaves.setdefault(d[3], []).append((d[0], h(*[framed(v) for v in (d[0], d[3], d[2], d[4], d[1])]), d))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        leaves[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = plain_tree([x[1] for x in leaves[s]])
    root, up = plain_tree([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (doc_id, leaf, d) in enumerate(leaves[s]):
            path = trees[s][1][i] + up[k]
            out.append((doc_id, leaf, trees[s][0], root, h(*[x for a, b in path for x in a + b]), path, d))
    return out


def fold(leaf, path):
    for a, b in path:
        leaf = h(*a, leaf, *b)
    return leaf


@pytest.mark.parametrize("hot", [1000, 2])
def test_manifest_equals_loops(spark, odd_docs, no_docs, monkeypatch, hot):
    """Sources of 1 to 200 rows, a null source, repeated rows, a shared doc_id; with repeated records dealt over pieces and without."""
    from tidemark.llm import common, merkle

    monkeypatch.setattr(merkle, "crowded", lambda rows, keys, total, piece=hot: common.crowded(rows, keys, total, piece))
    monkeypatch.setattr(common, "LEAST_HOT", hot)
    rng = random.Random(3)
    docs = [(i, f"text {i}\nline" if i % 3 else None, "en" if i % 5 else None, rng.choice(["a", "a", "a", "b", "é", None]), i) for i in range(300)]
    docs += [(1000 + i, f"x{i}", "en", f"s{i:02}", None) for i in range(12)] + [(5000, "same\n", "en", "dup", 4)] * 40 + [(6000, "one", "en", "dup", 3), (6000, "two", "en", "dup", 3), (None, "\n", None, "dup", None)]
    rng.shuffle(docs)
    even = F.col("doc_id") % 2 == 0
    frame = spark.createDataFrame(docs, DOCS).withColumn("tree", F.lit("own")).withColumn("path", F.lit("own"))
    got = merkle.verified_manifest(spark, frame.repartition(7), F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    want = []
    for doc_id, leaf, sub, root, proof, path, d in plain_manifest(docs):
        text = d[1].replace("\n", "") if d[1] is not None and doc_id is not None and doc_id % 2 == 0 else d[1]
        tried = h(*[framed(v) for v in (d[0], d[3], d[2], d[4], text)])
        want.append((doc_id, leaf, sub, root, proof, fold(tried, path), fold(tried, path) == root))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert merkle.verified_manifest(spark, no_docs, F.col("text")).collect() == []
    odd = merkle.verified_manifest(spark, odd_docs, F.col("text")).collect()
    assert len(odd) == 12 and all(r["verified"] for r in odd)


def test_requests_for_some_leaves(spark):
    from tidemark.llm import merkle

    docs = [(i, f"t{i}", "en", "a" if i < 40 else "b" if i < 41 else "c", i) for i in range(60)]
    m = merkle.build_manifest(spark.createDataFrame(docs, DOCS))
    asked = spark.createDataFrame([(0, 39), (0, 0), (0, 0), (1, 0), (2, 7), (2, 99), (9, 0)], "tree long, rank long")
    out = merkle.prove(spark, m, asked).select("doc_id", merkle.fold(F.col("digest"), F.col("path")).alias("root"), F.size("path").alias("n")).collect()
    assert sorted(r["doc_id"] for r in out) == [0, 39, 40, 48] and {r["root"] for r in out} == {m.root} and {r["doc_id"]: r["n"] for r in out} == {0: 5, 39: 5, 40: 1, 48: 4}


# ---- 12 ------------------------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<double>"


def plain_top(rows, k=5):
    whole = [(i, v, [int(np.floor(x * 256)) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, q, a in whole:
        if q is None or q % 50:
            continue
        score = {j: max(min(sum(x * y for x, y in zip(a, b, strict=True)), 2**63 - 1), -(2**63)) for j, _, b in whole if len(b) == len(a)}
        hits = sorted((-score[j], v is None, v or 0, j) for j, v, b in whole if j != i and len(b) == len(a))[:k]
        out += [(q, n + 1, None if null else v, -s) for n, (s, null, v, _) in enumerate(hits)]
    return out


@pytest.mark.parametrize("block", [4096, 16])
def test_search_equals_all_scores(spark, monkeypatch, block):
    """Ties, repeats, nulls, odd components, lengths from 0 to 20, scores beyond doubles and longs; in one block and in many."""
    from tidemark.llm import exact_search

    monkeypatch.setattr(exact_search, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 20)]) for i in range(230)] + [(300 + i, [0.5] * 20) for i in range(40)] + [(50, [0.5] * 20), (None, [0.5] * 20), (None, [9.0] * 20)]
    rows += [(400, None), (450, [None] * 20), (500, [float("nan")] * 20), (550, [float("inf")] * 20), (600, []), (601, []), (650, [1.0, 2.0, 3.0]), (651, [3.0, 2.0, 1.0]), (700, [7.0])]
    rows += [(750, [1e12 + 3, 1.0]), (751, [1e12 + 1, 1.0]), (752, [1e12 + 2, 1.0]), (753, [1e30, 1.0]), (754, [-1e30, 1.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("x", F.lit("own")).withColumn("block", F.lit("own")).withColumn("cell", F.lit("own"))
    got = exact_search.top_products(df.repartition(5), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_top(rows), key=repr)
    assert exact_search.top_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold_and_rise():
    from tidemark.llm.exact_search import RESOLUTIONS, Block, highest, statistics

    rng = np.random.default_rng(6)
    q, c = (np.floor(256 * np.cumsum(rng.normal(0, 0.1, (40, 64)), axis=1)) for _ in range(2))
    bounds = [highest(statistics(q, n), statistics(c, n)) for n in RESOLUTIONS]
    assert all((b >= q @ c.T - 1e-6).all() for b in bounds) and bounds[0].mean() > bounds[1].mean() > bounds[2].mean()
    lower = ((q**2).sum(1)[:, None] + (c**2).sum(1) - 2 * bounds[2]) / ((q[:, None] - c[None]) ** 2).sum(-1)
    assert lower.max() <= 1 + 1e-9
    floor = np.sort(q @ c.T, axis=1)[:, -5]
    found, exact = Block(np.arange(40), np.arange(40), np.ones(40, bool), c).best(np.arange(100, 140), q, floor, 5)
    assert [s.tolist() for _, s in found] == [sorted(r, reverse=True)[:5] for r in (q @ c.T).tolist()] and exact < 1600  # survivors only


# ---- 13 ------------------------------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """The cheapest, ASCII-least edits by trying all; rows are (role, text, fault)."""
    best = None

    def go(i, cost, audit, out, inserted):
        nonlocal best
        shown = "".join(r[:1] for r, _ in out)
        if best and cost > best[0] or not re.match(r"s?(ua)*u?$", shown):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", shown) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, list(out))
        if inserted < 2:
            for r in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*out, (r, "")], inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", out, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for r in ("user", "assistant"):
                    go(i + 1, cost + 3 + more, audit + "R", [*out, (r, text)], 0)

    go(0, 0, "", [], 0)
    return best


def plain_summary(conv, rows):
    """rows: (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit, out = plain_repair([(r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, h("\n".join(f"{r}:{t}" for r, t in out)))


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def test_repairs_equal_all_ways(spark):
    """Null and shared turns, odd roles, repeated rows, null ids, a conversation without rows, an empty table."""
    from tidemark.llm.repair import repair_summaries, repaired_turns

    rng = random.Random(9)
    rows = []
    for c in [*range(120), None]:
        for i in range(rng.randrange(1, 6)):
            row = (c, rng.choice([None, i, i, i + 3]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(["Yes.", "No", "", " \t", None, "Why?", f"t{i}!"]))
            rows += [row] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame(rows, TURNS).withColumn("kind", F.lit("own")).withColumn("digest", F.lit("own")).withColumn("step", F.lit("own"))
    want = []
    for c in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for k, t, r, x in rows if k == c]
        want.append(plain_summary(c, sorted(own, key=lambda v: (v[0] is not None, v[0] or 0, digest(v[1], v[2])))))
    want.append((777, 0, 0, 0, 0, 0, 0, "", h("")))
    edits = repaired_turns(df.repartition(5), df.select("conv_id").union(spark.createDataFrame([(777,)], "conv_id long")))
    assert sorted(map(tuple, repair_summaries(edits).collect()), key=repr) == sorted(want, key=repr)
    shown = edits.where("step > 0 and edit <> 'D'").orderBy("conv_id", "step").collect()
    by = {}
    for r in shown:
        by.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: h("\n".join(v)) for c, v in by.items()} == {w[0]: w[-1] for w in want if w[-1] != h("")}
    assert repair_summaries(repaired_turns(df.limit(0))).collect() == []


@pytest.mark.parametrize("open_nodes", [32, 1])
def test_settled_edits_are_the_cheapest(monkeypatch, open_nodes):
    from tidemark.llm import repair

    monkeypatch.setattr(repair, "OPEN", open_nodes)
    rng = random.Random(4)
    for _ in range(300):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), f"t{i}", rng.choice([None, None, "truncated", "blank", "duplicate"])) for i in range(rng.randrange(6))]
        d = repair.Decoder()
        got = [n for r in rows for n in d.push(r)] + list(d.close())
        want = plain_repair([r[1:] for r in rows])
        assert (sum(n.cost for n in got), "".join(n.edit for n in got), [(n.role, n.row[2] if n.row else "") for n in got if n.edit != "D"]) == want


def test_long_conversations_hold_few_nodes():
    """A hundred thousand rows: what is settled leaves the tree."""
    from tidemark.llm.repair import Decoder

    rng, d, out = random.Random(7), Decoder(), 0
    for i in range(100_000):
        out += sum(1 for _ in d.push((i, rng.choice(["user", "assistant", "system"]), "x", rng.choice([None, None, None, "truncated", "blank"]))))
    assert d.most_open < 200 and out > 99_000


def test_damage(spark):
    from zlib import crc32

    from tidemark.llm.repair import damaged

    rows = [(c, t, "assistant", "A. b! c?") for c in range(12) for t in range(12)] + [(None, 1, None, None), (3, None, "user", "x.")]
    got = sorted(map(tuple, damaged(spark.createDataFrame(rows, TURNS)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        spot = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        want += [] if spot == 0 else [(c, t, "user" if spot == 4 else role, "" if spot == 1 else re.sub("[.!?]", "", text) if spot == 2 else text)] * (2 if spot == 3 else 1)
    assert got == sorted(want, key=repr)


# ---- 6 and 8: what once ended a job --------------------------------------------------------------
def test_odd_records_are_rows_without_a_format(spark):
    from tidemark.llm.chat import format_records

    bad = ['{"messages":[{"role":"user","content":"a"},null]}', '{"messages":[{"role":"user","content":"a"},"x"]}', '{"messages[]":1}', '{"messages[]":{"role":"u","content":"c"}}', '{"a":' * 3000 + "1" + "}" * 3000, "[" * 100_000, '{"a":' + "[" * 500 + "]" * 500 + "}", '{"messages":{"role":"a","content":"b"}}', '{"messages":[[]]}', r'{"\ud800":1}', None, "3", "{}"]
    good = {r'{"messages":[{"role":"user","content":"x\ud800y"}]}': "x�y", r'{"messages":[{"role":"user","content":"😀"}]}': "\U0001f600", '{"messages.x":1,"messages":[{"role":"user","content":"q"}]}': "q"}
    df = spark.createDataFrame(list(enumerate([*bad, *good])), "conv_id long, record string")
    out = [r["formatted"] for r in format_records(df).orderBy("conv_id").collect()]
    assert out[: len(bad)] == [None] * len(bad) and out[len(bad) :] == [f"### user:\n{t}\n</turn>\n" for t in good.values()]


OTHER_SESSION = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "5").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {warehouse!r}).config("spark.checkpoint.dir", {shared!r}).getOrCreate()
from tidemark.llm.exact_dedup import DigestIndex
index = DigestIndex(spark, {path!r})
out = index.ingest(spark.createDataFrame([(7, "Y", "", "", 0), (8, "z", "", "", 0)], {docs!r}), "second").collect()
print("GOT", index.buckets, sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in out), index.table().count())
"""


def test_index_outlives_its_session(spark):
    """Another process opens the index by its path, decides on it and adds to it; this session then sees that."""
    from tidemark.llm.exact_dedup import DigestIndex

    path = f"{tempfile.mkdtemp(prefix='spark-')}/index"
    DigestIndex(spark, path, buckets=3).ingest(spark.createDataFrame([(0, "x", "", "", 0), (1, "y", "", "", 0)], DOCS), "first")
    code = OTHER_SESSION.format(root=str(Path(__file__).resolve().parents[2]), path=path, docs=DOCS, warehouse=spark.conf.get("spark.sql.warehouse.dir"), shared=tempfile.mkdtemp(prefix="spark-"))
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert f"GOT 3 {[(7, 1, False), (8, 8, True)]} 3" in said.stdout, said.stderr[-2000:]
    index = DigestIndex(spark, path)
    assert index.buckets == 3 and index.table().count() == 3
    spark.sql(f"drop table {index.name}")  # a catalogue that forgot it
    again = DigestIndex(spark, path).ingest(spark.createDataFrame([(9, "Z", "", "", 0)], DOCS), "third").collect()
    assert [(r["keep_id"], r["kept"]) for r in again] == [(8, False)]
    index.drop()
    assert not Path(path).exists()


def test_sql_of_the_new_queries(spark):
    import duckdb

    from tidemark.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {name} as select * from '/root/testdata/sf0.001/{name}.parquet'")
    for name in ("op11_merkle_manifest", "op12_exact_topk", "op13_conversation_repair"):
        got, want = QUERIES[name](spark, "/root/testdata/sf0.001"), con.execute(ORACLES[name])
        cols = sorted(got.columns)
        assert cols == sorted(d[0] for d in want.description)
        rows = [dict(zip([d[0] for d in want.description], r, strict=True)) for r in want.fetchall()]
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted((tuple(r[c] for c in cols) for r in rows), key=repr) and rows
    assert json.dumps(sorted(QUERIES))


# ---- 5 and 2: memory -----------------------------------------------------------------------------
def test_long_texts_in_pieces_get_the_same_mixture(monkeypatch):
    """Texts of several languages, one word longer than a piece; whole and in pieces of some words."""
    import pyarrow as pa

    from tidemark.llm import langid

    rng = np.random.default_rng(3)
    words = {lang: ["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(60)] for lang, letters in zip("wxyz", ("abcdef", "efghij", "ijklmn", "mnopqr"), strict=True)}
    sample = pa.RecordBatch.from_arrays([pa.array([" ".join(w) for w in words.values()]), pa.array(list(words))], ["text", "lang"])
    counts = {lang: np.full(langid.TABLE, langid.SMOOTH) for lang in words}
    for b in langid.gram_counts(iter([sample])):
        for lang, slot, n in zip(*[b.column(c).to_pylist() for c in ("lang", "slot", "n")], strict=True):
            counts[lang][slot] += n
    model = langid.Model(list(words), np.stack([np.log(c / c.sum()).astype(np.float32) for c in counts.values()], axis=1))
    texts = [" ".join(rng.choice(words[lang], 40)) for lang in words] + [" ".join([*rng.choice(words["w"], 50), *rng.choice(words["z"], 70)]), " ".join([*rng.choice(words["w"], 60), *rng.choice(words["x"], 60), *rng.choice(words["y"], 60)]), "abc" * 900 + " " + " ".join(words["y"]), "", None, "12"]
    holder = type("Sent", (), {"value": model})

    def told():
        out = [r for b in langid.predict_rows(holder)(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])])) for r in b.to_pylist()]
        return [(r["lang_pred"], round(r["score"], 3), r["mixture"] and len(r["mixture"].split(";"))) for r in out]

    whole = told()
    monkeypatch.setattr(langid, "MOST_LIKELIHOODS", 200)
    assert told() == whole and [w[2] for w in whole[4:6]] == [2, 3]
    monkeypatch.setattr(langid, "COUNTED", 2)
    again = {}
    for b in langid.gram_counts(iter([sample, sample])):
        for lang, slot, n in zip(*[b.column(c).to_pylist() for c in ("lang", "slot", "n")], strict=True):
            again[lang, slot] = again.get((lang, slot), 0) + n
    assert again == {(lang, int(k)): int(2 * (counts[lang][k] - langid.SMOOTH)) for lang in words for k in np.flatnonzero(counts[lang] > langid.SMOOTH)}


def test_a_node_with_many_pairs_is_dealt_over_pieces(spark, monkeypatch):
    """Near copies of one text, with pieces of two pairs: the same classes and links."""
    from tidemark.llm import near_dup

    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        t = list(base)
        t[rng.randrange(5)] = f"x{i}"
        texts.append(" ".join(t))
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts + ["other words entirely in this one here"])], DOCS)
    want = sorted(map(tuple, near_dup.near_dup_classes(df).collect()))
    monkeypatch.setattr(near_dup, "PAIRS_A_PIECE", 2)
    for share in (near_dup.HOT_SHARE, 1.0):  # a small table of pieces, and one too large to be broadcast
        monkeypatch.setattr(near_dup, "HOT_SHARE", share)
        assert sorted(map(tuple, near_dup.near_dup_classes(df).collect())) == want and want[0][2] == 60
