"""Clusters, fits, attributions and scores against plain computations."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import density, ml, trees

T0 = dt.datetime(2024, 1, 1)


# ---- density clusters ------------------------------------------------------------------------------
def plain_clusters(x, least):
    """From the definition, top down: rows apart at a distance fall into components; quadratic."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d + np.diag([np.inf] * n), axis=1)[:, least - 1]
    reach = np.maximum(d, np.maximum(core[:, None], core[None]))

    def components(rows, w):
        left, out = set(rows), []
        while left:
            queue = [left.pop()]
            c = list(queue)
            while queue:
                i = queue.pop()
                near = [j for j in left if reach[i, j] < w]
                left.difference_update(near)
                queue += near
                c += near
            out.append(sorted(c))
        return out

    def widest(rows):
        rows = np.array(rows)
        best, inside, most = reach[rows[0], rows].copy(), np.zeros(len(rows), bool), 0
        inside[0] = True
        for _ in range(len(rows) - 1):
            b = np.where(inside, np.inf, best)
            j = b.argmin()
            most, inside[j], best = max(most, b[j]), True, np.minimum(best, reach[rows[j], rows])
        return most

    def cluster(rows, birth, whole=False):
        now, stable = list(rows), 0.0
        while True:
            w = widest(now)
            at, parts = 1 / max(w, 1e-12), components(now, w)
            big = [p for p in parts if len(p) >= least]
            stable += sum(len(p) for p in parts if len(p) < least) * (at - birth)
            if len(big) != 1:
                break
            now = big[0]
        if not big:
            return (stable, []) if whole else (stable, [sorted(rows)])
        stable += sum(len(p) * (at - birth) for p in big)
        below = [cluster(p, at) for p in big]
        total = sum(s for s, _ in below)
        return (stable, [sorted(rows)]) if total <= stable and not whole else (total, [c for _, cs in below for c in cs])

    label = np.full(n, -1)
    for k, c in enumerate(sorted(cluster(list(range(n)), 0.0, True)[1])):
        label[c] = k
    return label


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(4)
    t = rng.random(180) * np.pi
    moons = np.concatenate([np.c_[np.cos(t), np.sin(t)], np.c_[1 - np.cos(t), 0.5 - np.sin(t)]]) + rng.normal(0, 0.06, (360, 2))
    tied = np.round(np.concatenate([rng.normal(0, 1, (190, 2)), rng.normal((7, 2), 1, (190, 2)), rng.uniform(-4, 12, (90, 2))]), 1)
    return {0: moons, 1: np.concatenate([tied, np.tile(tied[:1], (30, 1))])}


@pytest.mark.parametrize("cell", [1024, 70])
def test_clusters_equal_a_quadratic_version(spark, shapes, monkeypatch, cell):
    """Two moons, and 500 rows on a grid with many ties and repeats; in one cell and in several."""
    monkeypatch.setattr(density, "CELL", cell)
    rows = [(g, i, p.tolist()) for g, x in shapes.items() for i, p in enumerate(x)] + [(2, i, [0.0, 0.0]) for i in range(5)]
    got = density.density_clusters(spark.createDataFrame(rows, "grp long, id long, x array<double>"), 20).toPandas().sort_values("id")
    assert len(got) == len(rows) and (got[got.grp == 2].cluster == -1).all()
    for g, x in shapes.items():
        assert (got[got.grp == g].cluster.to_numpy() == plain_clusters(x, 20)).all()
    assert set(got[got.grp == 0].cluster) - {-1} == {0, 1}


def test_regimes_keep_their_labels(spark):
    rng = np.random.default_rng(8)
    groups = np.concatenate([rng.normal((0, 0), 0.3, (80, 2)), rng.normal((6, 6), 0.3, (80, 2)), [[3.0, 3.0]]])
    rows = [("x", "A", T0 + dt.timedelta(minutes=i), "RANGING", 5, float(a), float(b)) for i, (a, b) in enumerate(groups)]
    rows += [("x", "B", T0 + dt.timedelta(minutes=i), "THIN_BOOK", 7, 1.0, None) for i in range(20)] + [("x", "C", T0, None, 3, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, ts timestamp, regime string, cluster int, f double, g double")
    out = ml.cluster_regimes(df, ["f", "g"])
    got = {(r["symbol"], r["ts"]): r["cluster"] for r in out.collect()}
    of = [got[("A", T0 + dt.timedelta(minutes=i))] for i in range(161)]
    assert set(of) <= {-1, 0, 1} and of[160] == -1 and max(of[:80].count(c) for c in (0, 1)) > 70 and max(of[80:160].count(c) for c in (0, 1)) > 70
    assert {c for (s, _), c in got.items() if s == "B"} == {7} and got[("C", T0)] == 3 and len(got) == len(rows)
    stats = {r["regime"]: r for r in ml.cluster_stats(out).collect()}
    assert set(stats) == {"RANGING"} and stats["RANGING"]["n_clusters"] == 2 and stats["RANGING"]["noise_pct"] == pytest.approx(100 * of.count(-1) / 161, abs=0.06)
    fresh = ml.cluster_regimes(df.drop("cluster").where("symbol = 'B'"), ["f", "g"])
    assert {r["cluster"] for r in fresh.collect()} == {-1}
    assert ml.cluster_regimes(df.limit(0), ["f"]).count() == 0 and ml.cluster_regimes(df, []).where("symbol = 'A' and cluster = 5").count() == 161


# ---- trees -----------------------------------------------------------------------------------------
def sample(n=160, f=4, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, f)), 1)
    y = np.where(x[:, 0] + x[:, 1] * x[:, 2] > 0.6, 2, np.where(x[:, 1] > 0.5, 0, 1))
    return x, y, np.where(y == 1, 1.0, 2.0)


def plain_boost(x, y, w, rounds, depth, rate=0.05, ridge=1.0):
    """Softmax boosting by loops over nodes, features and cuts, without sampling."""
    one, margin = np.eye(3)[y], np.zeros((len(x), 3))

    def tree(rows, g, h, level):
        here = -g[rows].sum() / (h[rows].sum() + ridge)
        best = (1e-9, None)
        if level < depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if h[a].sum() < 1 or h[b].sum() < 1:
                        continue
                    gain = sum(g[r].sum() ** 2 / (h[r].sum() + ridge) for r in (a, b)) - g[rows].sum() ** 2 / (h[rows].sum() + ridge)
                    if gain > best[0] + 1e-12:
                        best = (gain, (a, b))
        out = np.zeros(len(x))
        if best[1] is None:
            out[rows] = here
            return out
        return sum(tree(r, g, h, level + 1) for r in best[1])

    for _ in range(rounds):
        p = trees.softmax(margin)
        margin = margin + rate * np.stack([tree(np.arange(len(x)), (p[:, c] - one[:, c]) * w, np.maximum(2 * p[:, c] * (1 - p[:, c]) * w, 1e-16), 0) for c in range(3)], axis=1)
    return trees.log_loss(trees.softmax(margin), y)


def test_boosting_equals_plain_loops():
    x, y, w = sample()
    m = trees.boost(x, y, w, 4, depth=3, share=1.0)
    assert trees.log_loss(trees.probabilities(m, x), y) == pytest.approx(plain_boost(x, y, w, 4, 3), abs=1e-9)


def test_boosting_stops_early_and_keeps_the_best_round():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(120, 3)), rng.integers(0, 3, 120)  # nothing to learn: the held rows' loss soon rises
    held = (rng.normal(size=(60, 3)), rng.integers(0, 3, 60))
    m = trees.boost(x, y, np.ones(120), 500, held, patience=10)
    k = len(m["root"]) // 3
    whole = trees.boost(x, y, np.ones(120), k + 10)

    def first(j):
        return {**whole, "root": whole["root"][: 3 * j]}

    losses = [trees.log_loss(trees.probabilities(first(j), held[0]), held[1]) for j in range(1, k + 11)]
    assert k < 200 and int(np.argmin(losses)) + 1 == k


def test_forest_splits_by_gini():
    x, y, w = sample(80, 3)
    x = x[:, :2]
    b, edges = trees.binned(x, trees.bin_edges(x)), trees.bin_edges(x)
    t = trees.grow(b, edges, -np.eye(3)[y] * w[:, None], w[:, None], 1, 0.0, 1e-12, lambda s: np.tile(np.arange(2), (s, 1)))

    def impurity(rows):
        p = np.array([w[rows][y[rows] == c].sum() for c in range(3)])
        return p.sum() * (1 - ((p / p.sum()) ** 2).sum()) if len(rows) else 0.0

    cuts = {(f, c): impurity(np.flatnonzero(x[:, f] <= c)) + impurity(np.flatnonzero(x[:, f] > c)) for f in range(2) for c in np.unique(x[:, f])[:-1]}
    assert cuts[(int(t["feature"][0]), float(t["threshold"][0]))] == pytest.approx(min(cuts.values()))
    left = x[:, t["feature"][0]] <= t["threshold"][0]
    assert t["value"][1] == pytest.approx([w[left & (y == c)].sum() / w[left].sum() for c in range(3)])
    p = trees.probabilities(trees.forest(x, y, w, trees=5, depth=3), x)
    assert p.sum(axis=1) == pytest.approx(np.ones(80))


def test_regression_is_at_its_minimum():
    x, y, w = sample()
    m = trees.logistic(x, y, w)
    p, z = trees.probabilities(m, x), (x - m["mean"]) / m["scale"]
    grad = ((p - np.eye(3)[y]) * w[:, None]).T @ z + m["beta"][:, :-1]
    assert np.abs(grad).max() < 1e-3 and np.abs(((p - np.eye(3)[y]) * w[:, None]).sum(axis=0)).max() < 1e-3


def test_attributions_equal_the_enumeration_of_subsets():
    x, y, w = sample(100, 4)
    m = trees.boost(x, y, w, 2, depth=3)
    phi, base = trees.attributions(m, x[:12])
    assert phi.sum(axis=1) + base == pytest.approx(trees.leaf_sums(m, x[:12]))

    def value(row, known, n):
        f = int(m["feature"][n])
        if f < 0:
            return m["value"][n]
        kids = (int(m["left"][n]), int(m["right"][n]))
        if f in known:
            return value(row, known, kids[0] if row[f] <= m["threshold"][n] else kids[1])
        return sum(m["cover"][k] / m["cover"][n] * value(row, known, k) for k in kids)

    for i in range(12):
        for f in range(4):
            want = np.zeros(3)
            others = [j for j in range(4) if j != f]
            for size in range(4):
                for known in itertools.combinations(others, size):
                    weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                    want += weight * sum(value(x[i], {*known, f}, r) - value(x[i], set(known), r) for r in m["root"])
            assert phi[i, f] == pytest.approx(want)


# ---- slots and scores ------------------------------------------------------------------------------
SLOTS = "exchange string, symbol string, ts timestamp, regime string, cluster int, f double, g double, hurst_60 double, microprice_mid_delta double, target string"


@pytest.fixture(scope="module")
def slots():
    rng = np.random.default_rng(12)
    kinds = ["REVERT", "FLAT", "TREND"]
    rows = [("x", "A", T0 + dt.timedelta(minutes=i), "RANGING", 0, float(3 * k + rng.normal(0, 0.3)), float(rng.normal()), 0.3, 1.5, kinds[k]) for i, k in enumerate(rng.integers(0, 3, 240))]
    rows += [("x", "E", T0 + dt.timedelta(minutes=i), "HIGH_VOL", 1, float(i % 2), 0.0, None, None, "TREND") for i in range(210)]  # one class only
    rows += [("x", "B", T0, "TRENDING_UP", 0, 0.0, 0.0, 0.3, 2.5, "REVERT"), ("x", "C", T0, "THIN_BOOK", 5, 0.0, 0.0, 0.3, None, "REVERT"), ("x", "D", T0, "RANGING", 3, None, float("nan"), 0.7, 1.0, "REVERT"), ("x", "F", T0, "RANGING", -1, 6.0, 0.0, None, 1.0, None), ("x", "G", T0, None, 0, 6.0, 0.0, None, 1.0, "")]
    return rows


def test_slots_are_trained_and_scored(spark, slots, monkeypatch):
    """All three candidates are fitted over the folds, the best is refitted, and scores follow the gates and the regime's best model."""
    monkeypatch.setattr(ml, "CANDIDATES", ("forest", "logistic"))
    df = spark.createDataFrame(slots, SLOTS)
    registry = ml.train_slots(df, "target", ["f", "g"], folds=3)
    (row,) = registry.collect()
    assert (row["regime"], row["cluster"], row["n"]) == ("RANGING", 0, 240) and row["cv_score"] == max(row["scores"].values()) > 0.9 and set(row["scores"]) == {"forest", "logistic"}
    assert row["importances"]["f"] > row["importances"]["g"]
    shown = {r["feature"]: r for r in ml.importances(registry).collect()}
    assert shown["f"]["importance"] == pytest.approx(sum(shown["f"]["by_class"]))
    out = {(r["symbol"], r["ts"]): r for r in ml.score(df, registry).collect()}
    assert len(out) == len(slots)
    flat = [out[(s, T0)] for s in "BCDG"]  # trending, no model, a high exponent, no regime
    assert {(r["label"], r["confidence"], r["model_id"], r["model_cluster"]) for r in flat} == {("FLAT", 1.0, None, -1)} and [r["deviation"] for r in flat] == [2.5, 0.0, 1.0, 1.0]
    assert out[("F", T0)]["label"] == "TREND" and out[("F", T0)]["model_cluster"] == 0  # the regime's model, whatever the row's cluster
    assert np.mean([out[("A", r[2])]["label"] == r[9] for r in slots[:240]]) > 0.95
    empty = ml.train_slots(df.limit(0), "target", ["f", "g"])
    assert empty.count() == 0 and {r["label"] for r in ml.score(df, empty).collect()} == {"FLAT"}


def test_folds_and_candidates_are_whole():
    """The reference's sizes, and the scores of folds against a plain cut."""
    assert ml.CANDIDATES == ("boosted", "forest", "logistic") and (ml.ROUNDS, ml.FINAL_ROUNDS) == (500, 300) and ml.train_slots.__defaults__[:3] == (5, 5, 200)
    assert (trees.boost.__defaults__[1], trees.boost.__defaults__[3:]) == (50, (6, 0.05, 0.8, 1.0)) and trees.forest.__defaults__[:2] == (200, 8)
    nth = np.arange(60)
    train, test = ml.purged_parts(nth, 60, 2, 5, 5)
    assert list(nth[train]) == list(range(20)) and list(nth[test]) == list(range(25, 35))
    y = np.array([0, 0, 1, 1, 1, 1])
    assert ml.balanced(y) == pytest.approx([6 / 4] * 2 + [6 / 8] * 4)
    guess = np.array([0, 1, 1, 1, 2, 1])
    assert trees.weighted_f1(y, guess) == pytest.approx((2 * (2 / 3) + 4 * (6 / 8)) / 6)


def test_models_survive_being_stored():
    x, y, w = sample()
    for m in (trees.boost(x, y, w, 3), trees.forest(x, y, w, trees=4), trees.logistic(x, y, w)):
        assert (trees.probabilities(trees.unpacked(trees.packed(m)), x) == trees.probabilities(m, x)).all()


def test_ranks_over_ranges(spark):
    from tidemark.operators.places import in_ranks

    df = spark.createDataFrame([(None if i % 7 == 0 else f"k{i % 2}", (i * 37) % 50) for i in range(200)], "k string, v int").withColumn("n", F.lit("own"))
    out = in_ranks(df.repartition(5), ["k"], ["v"]).collect()
    for k in (None, "k0", "k1"):
        own = sorted((r for r in out if r["k"] == k), key=lambda r: r["nth_"])
        assert [r["nth_"] for r in own] == list(range(len(own))) and {r["n_"] for r in own} == {len(own)} and [r["v"] for r in own] == sorted(r["v"] for r in own)


def test_pairs_of_cells_meet_only_where_rows_can(monkeypatch):
    """Rows whose bound does not reach the other cell are left out before distances are taken (F3, F4, F16); what is found is what all distances give."""
    rng, least, taken, whole = np.random.default_rng(4), 5, [], density.distances
    x = rng.normal(0, 1, (300, 3))
    y = np.round(rng.normal(0, 1, (300, 3)) + [2.5, 0, 0], 1)
    y[:20] = x[:20]  # ties at distance 0
    own, d = np.sort(whole(x, x), axis=1)[:, least], whole(x, y)
    frame = lambda v, first: pd.DataFrame({"grp": 0, "cell": first, "id": np.arange(len(v)) + first, "x": list(v), "core": rng.uniform(0.1, 0.4, len(v)), "comp": (np.arange(len(v)) + first) // 3})
    here, there = frame(x, 0).assign(bound=own), frame(y, 1000)
    monkeypatch.setattr(density, "distances", lambda a, b: taken.append(len(a) * len(b)) or whole(a, b))
    got = density._nearest_there(least)((0, 0, 1), here, there).set_index("id")["near"].to_dict()
    for i in range(300):
        want = sorted(d[i][d[i] < own[i]])[:least]
        assert sorted(got.get(i, [])) == want
    weight = np.maximum(d, np.maximum(here["core"].to_numpy()[:, None], there["core"].to_numpy()[None, :]))
    bounds = here["comp"].map(pd.Series(rng.uniform(0.2, 0.8, 100)))
    out = density._ways_out((0, 0, 1), here.assign(bound=bounds), there).set_index("comp")
    for c in range(100):
        rows = np.flatnonzero(here["comp"] == c)
        best = min((weight[i, j], i, j + 1000) for i in rows for j in range(300))
        if best[0] <= bounds[rows[0]]:
            assert tuple(out.loc[c, ["w", "lo", "hi"]]) == best
    assert len(taken) == 2 and taken[0] < d.size and taken[1] < 0.75 * d.size
    nothing = density._ways_out((0, 0, 1), here.assign(bound=0.0), there)
    assert len(nothing) == 0 and list(nothing.columns) == ["grp", "comp", "w", "lo", "hi", "other"]


def test_fits_take_all_rows_of_a_slot(spark, monkeypatch):
    """m07_train_slots, F1: beyond 50,000 rows models were fitted on evenly spaced ones. Here every other row, which those left out, has labels that say the opposite."""
    n = 100_000
    i = np.arange(n)
    f = (i * 7919 % 997) / 997
    y = np.where((i * 7919 % 997 > 300) == (i % 2 == 1), 2, 0)
    y[i % 7 == 0] = 1
    monkeypatch.setattr(ml, "CANDIDATES", ("logistic",))
    target = "case when id % 7 = 0 then 'FLAT' when (id * 7919 % 997 > 300) = (id % 2 = 1) then 'TREND' else 'REVERT' end as target"
    df = spark.range(n).selectExpr("'x' as exchange", "'A' as symbol", "timestamp_seconds(id) as ts", "'RANGING' as regime", "0 as cluster", "(id * 7919 % 997) / 997D as f", target)
    (row,) = ml.train_slots(df, "target", ["f"], folds=2).collect()
    got, want = trees.unpacked(row["model"]), ml.fitted("logistic", f[:, None], y)
    assert row["n"] == n and got["mean"] == pytest.approx(f.mean()) and got["beta"] == pytest.approx(want["beta"], abs=1e-6)
    a, b = ml.purged_parts(i, n, 1, 2, 5)  # the second fold would end past the rows
    score = trees.weighted_f1(y[b], trees.probabilities(ml.fitted("logistic", f[a, None], y[a]), f[b, None]).argmax(axis=1))
    assert row["cv_score"] == pytest.approx(score, abs=1e-6)


def test_histograms_are_plain_sums():
    """Of nodes that share their features and of nodes with features of their own; a tree leaves rows of finished nodes behind."""
    rng = np.random.default_rng(2)
    b, slot, v = rng.integers(0, trees.BINS, (5, 300)).astype(np.uint8), rng.integers(0, 4, 300), rng.normal(size=(2, 300))
    for chosen in (np.broadcast_to([0, 3], (4, 2)), np.array([[0, 1], [2, 4], [3, 1], [4, 0]])):
        got = trees.histograms(b, slot, chosen, v)
        assert got.shape == (2, 4, 2, trees.BINS)
        for k, s, j in itertools.product(range(2), range(4), range(2)):
            want = np.zeros(trees.BINS)
            for i in np.flatnonzero(slot == s):
                want[b[chosen[s, j], i]] += v[k, i]
            assert (got[k, s, j] == want).all()
    x, y, w = sample(300, 4)
    m = trees.forest(x, y, w, trees=3, depth=6)
    for r in m["root"]:
        at = trees.leaf_of(m, x, r)
        assert (m["feature"][at] < 0).all() and (m["feature"][m["root"]] >= 0).all()
        for i in range(0, 300, 29):
            n = r
            while m["feature"][n] >= 0:
                n = m["left"][n] if x[i, m["feature"][n]] <= m["threshold"][n] else m["right"][n]
            assert at[i] == n
