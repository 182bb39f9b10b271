"""Density clustering: mutual reachability, its minimum spanning forest, and the most stable clusters of the condensed tree.

Rows of a group lie in kd cells of at most ``CELL`` rows. A row's core distance is that to its ``least``-th nearest other row; two rows are as far apart as the largest of their cores and their distance.
Core distances come from a row's own cell first and then from the cells whose box is near enough. Inside a cell the forest grows as long as its cheapest way out is proven no dearer than any way
to another cell; what is left is joined by rounds of the cheapest way out of each component, over pairs of cells that can hold one, until a group is one component. Joins bring cells together, numpy works
inside a pair of them. A group's tree is condensed by one worker from its edges, 24 bytes a row: rows themselves are not gathered.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.places import in_ranks
from tidemark.sources.io import scratch

CELL = 1024
#: Distances below this count as it: lambda = 1 / distance stays finite.
NEAREST = 1e-12


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(x: pd.Series) -> np.ndarray:
    return np.array(x.tolist(), np.float64).reshape(len(x), -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed coordinate by coordinate, so that both directions agree to the bit."""
    out = np.zeros((len(x), len(y)))
    for lo in range(0, len(x), 64):  # parts that stay in the cache
        part = out[lo : lo + 64]
        for a, b in zip(x[lo : lo + 64].T, y.T, strict=True):
            part += (a[:, None] - b[None, :]) ** 2
    return np.sqrt(out, out=out)


def box_distance(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """From each row to each box."""
    out = np.zeros((len(x), len(low)))
    for a, lo, hi in zip(x.T, low.T, high.T, strict=True):
        out += np.maximum(0, np.maximum(lo[None, :] - a[:, None], a[:, None] - hi[None, :])) ** 2
    return np.sqrt(out)


def near_enough(x: np.ndarray, y: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``x`` have the box of ``y`` within their bound, and which rows of ``y`` have the box of those within the largest of their bounds. Boxes are no farther than rows to the bit, so no pair within a bound is left out."""
    here = box_distance(x, y.min(axis=0)[None], y.max(axis=0)[None])[:, 0] <= bound
    if not here.any():
        return here, np.zeros(len(y), bool)
    own = x[here]
    return here, box_distance(y, own.min(axis=0)[None], own.max(axis=0)[None])[:, 0] <= bound[here].max()


def _nearest_here(least: int):
    """A cell's rows and the boxes of the group's other cells: (bound on the core distance from the cell alone, distance to the nearest other box)."""
    def run(key: tuple, rows: pd.DataFrame, boxes: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows.assign(bound=[], gap=[])
        x = _matrix(rows["x"])
        d = distances(x, x)
        np.fill_diagonal(d, np.inf)
        bound = np.partition(d, least - 1, axis=1)[:, least - 1] if len(x) > least else np.full(len(x), np.inf)
        gap = box_distance(x, _matrix(boxes["low"]), _matrix(boxes["high"])).min(axis=1) if len(boxes) else np.full(len(x), np.inf)
        return rows.assign(bound=bound, gap=gap)

    return run


def _nearest_there(least: int):
    """For rows of one cell, their nearest rows of another one: at most ``least`` distances below the row's bound."""
    def run(key: tuple, here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        x, y = _matrix(here["x"]), _matrix(there["x"])
        rows, columns = near_enough(x, y, here["bound"].to_numpy())
        here, d = here[rows], distances(x[rows], y[columns])
        d = np.partition(d, least - 1, axis=1)[:, :least] if d.shape[1] > least else d
        near = [row[row < b].tolist() for row, b in zip(d, here["bound"], strict=True)]
        return pd.DataFrame({"grp": here["grp"].to_numpy(), "id": here["id"].to_numpy(), "near": pd.Series(near, dtype=object)})

    return run


class Sets:
    """Disjoint sets; the smaller index is a set's name."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def names(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))], np.int64)


def cheapest(weight: np.ndarray, comp: np.ndarray, row: np.ndarray, column: np.ndarray) -> pd.DataFrame:
    """The cheapest way out of each component of ``row``: (comp, w, lo, hi, at, to): by weight, then by the smaller and the larger id; ``weight`` is infinite inside components."""
    if not weight.size:
        return pd.DataFrame({"comp": [], "w": [], "lo": [], "hi": [], "at": [], "to": []})
    to = weight.argmin(axis=1)
    w = weight[np.arange(len(weight)), to]
    out = pd.DataFrame({"comp": comp, "w": w, "lo": np.minimum(row, column[to]), "hi": np.maximum(row, column[to]), "at": np.arange(len(w)), "to": to})
    return out[np.isfinite(w)].sort_values(["comp", "w", "lo", "hi"], kind="stable").groupby("comp", sort=False).head(1)


def _grown_here(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The forest of one cell as far as no way to another cell can be cheaper. A row for each row (its component, named by its smallest id) and one for each edge (w not null)."""
    rows = rows.sort_values("id").reset_index(drop=True)
    x, core, ids = _matrix(rows["x"]), rows["core"].to_numpy(), rows["id"].to_numpy()
    weight = np.maximum(distances(x, x), np.maximum(core[:, None], core[None, :]))
    away, sets, edges = np.maximum(core, rows["gap"].to_numpy()), Sets(len(rows)), []
    while True:
        comp = sets.names()
        weight[comp[:, None] == comp[None, :]] = np.inf
        best = cheapest(weight, comp, ids, ids)
        out = pd.Series(away).groupby(comp).min()
        best = best[best["w"].to_numpy() <= out.loc[best["comp"]].to_numpy()]
        grown = [(float(w), int(ids[i]), int(ids[j])) for w, i, j in zip(best["w"], best["at"], best["to"], strict=True) if sets.join(int(i), int(j))]
        if not grown:
            break
        edges += grown
    names = ids[sets.names()]
    points = pd.DataFrame({"grp": key[0], "cell": key[1], "id": ids, "comp": names, "w": np.nan, "lo": 0, "hi": 0})
    found = pd.DataFrame([(key[0], key[1], 0, 0, w, min(a, b), max(a, b)) for w, a, b in edges], columns=points.columns)
    return pd.concat([points, found]) if edges else points


def _ways_out(key: tuple, here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
    """The cheapest way from each component in one cell to a row of another component in the other (or the same) cell; none dearer than the ``bound`` of the row's component."""
    here, there = here.sort_values("id"), there.sort_values("id")
    here = here[here["core"] <= here["bound"]]
    if len(here) and len(there):
        x, y = _matrix(here["x"]), _matrix(there["x"])
        rows, columns = near_enough(x, y, here["bound"].to_numpy())
        columns &= there["core"].to_numpy() <= here["bound"].to_numpy()[rows].max(initial=-np.inf)
        here, there, x, y = here[rows], there[columns], x[rows], y[columns]
    if not len(here) or not len(there):
        return pd.DataFrame({"grp": [], "comp": [], "w": [], "lo": [], "hi": [], "other": []}).astype({"grp": "int64", "comp": "int64", "w": "float64", "lo": "int64", "hi": "int64", "other": "int64"})
    weight = np.maximum(distances(x, y), np.maximum(here["core"].to_numpy()[:, None], there["core"].to_numpy()[None, :]))
    weight[here["comp"].to_numpy()[:, None] == there["comp"].to_numpy()[None, :]] = np.inf
    best = cheapest(weight, here["comp"].to_numpy(), here["id"].to_numpy(), there["id"].to_numpy())
    to = there["comp"].to_numpy()[best["to"].to_numpy(np.int64)] if len(best) else []
    return pd.DataFrame({"grp": key[0], "comp": best["comp"].to_numpy(np.int64), "w": best["w"].to_numpy(), "lo": best["lo"].to_numpy(np.int64), "hi": best["hi"].to_numpy(np.int64), "other": np.array(to, np.int64)})


POINT = "grp long, cell long, id long, x array<double>"
WAY = "grp long, comp long, w double, lo long, hi long, other long"


def in_cells(points: DataFrame) -> DataFrame:
    """Adds ``cell``: slabs of the first coordinate, each cut along the second, ``CELL`` rows at most."""
    t = in_ranks(points.withColumn("x0", F.get("x", F.lit(0))).withColumn("x1", F.coalesce(F.get("x", F.lit(1)), F.lit(0.0))), ["grp"], ["x0", "id"])
    slabs = F.ceil(F.sqrt(F.col("n_") / CELL))
    t = t.withColumn("slab", F.floor(F.col("nth_") * slabs / F.col("n_"))).drop("nth_", "n_")
    t = in_ranks(t, ["grp", "slab"], ["x1", "id"])
    return t.select("grp", (F.col("slab") * (1 << 32) + F.floor(F.col("nth_") / CELL)).cast("long").alias("cell"), "id", "x")


def _gap(a: str, b: str) -> Column:
    """The distance of two boxes."""
    apart = F.zip_with(F.zip_with(f"{a}low", f"{b}high", lambda x, y: x - y), F.zip_with(f"{b}low", f"{a}high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.sqrt(F.aggregate(apart, F.lit(0.0), lambda acc, v: acc + v * v))


def _pairs(boxes: DataFrame) -> DataFrame:
    """Each cell with each other cell of its group: (grp, cell, other, gap) and the other's box. Boxes only, dealt by the other cell."""
    cells = boxes.groupBy("grp").agg(F.collect_list("cell").alias("others"))
    here = boxes.select("grp", "cell", F.col("low").alias("a_low"), F.col("high").alias("a_high")).join(F.broadcast(cells), "grp").withColumn("other", F.explode("others")).drop("others").where("other <> cell")
    there = boxes.select("grp", F.col("cell").alias("other"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    return here.join(there, ["grp", "other"]).select("grp", "cell", "other", _gap("a_", "b_").alias("gap"), F.col("b_low").alias("low"), F.col("b_high").alias("high"))


def _brought(rows: DataFrame, pairs: DataFrame, columns: list[str]) -> tuple:
    """Both cells' rows of each pair, to be grouped by pair. Pairs are much work for their bytes, so partitions are not put together by size."""
    n, by = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["grp", "cell", "other"]
    here = rows.select(*columns).join(pairs.select(*by), ["grp", "cell"]).repartition(n, *by).groupBy(*by)
    there = rows.select(*[F.col(c).alias("other" if c == "cell" else c) for c in columns]).join(pairs.select(*by), ["grp", "other"]).repartition(n, *by).groupBy(*by)
    return here, there


def spanning_forest(points: DataFrame, least: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their core distance, edges) of the minimum spanning trees of mutual reachability: (grp, id, core) and (grp, w, lo, hi). Groups need more than ``least`` rows."""
    p = _stored(in_cells(points), "cells")
    boxes = _stored(p.groupBy("grp", "cell").agg(F.array(*[F.min(F.get("x", F.lit(i))) for i in range(width)]).alias("low"), F.array(*[F.max(F.get("x", F.lit(i))) for i in range(width)]).alias("high")), "boxes")
    pairs = _stored(_pairs(boxes), "pairs")
    several = pairs.limit(1).count() > 0
    begun = _stored(p.groupBy("grp", "cell").cogroup(pairs.groupBy("grp", "cell")).applyInPandas(_nearest_here(least), POINT + ", bound double, gap double"), "begun")
    if several:
        reach = begun.groupBy("grp", "cell").agg(F.max("bound").alias("reach"))
        near = pairs.join(reach, ["grp", "cell"]).where(F.col("gap") < F.col("reach"))
        here, there = _brought(begun, near, ["grp", "cell", "id", "x", "bound"])
        more = here.cogroup(there).applyInPandas(_nearest_there(least), "grp long, id long, near array<double>").groupBy("grp", "id").agg(F.flatten(F.collect_list("near")).alias("near"))
        own, o_there = _brought(begun, boxes.select("grp", "cell", F.col("cell").alias("other")), ["grp", "cell", "id", "x", "bound"])
        inside = own.cogroup(o_there).applyInPandas(_own_nearest(least), "grp long, id long, own array<double>")
        both = begun.join(inside, ["grp", "id"]).join(more, ["grp", "id"], "left")
        whole = F.array_sort(F.concat("own", F.coalesce("near", F.array().cast("array<double>"))))
        begun = _stored(both.select(*begun.columns, F.element_at(whole, least).alias("core")), "cores")
    else:
        begun = begun.withColumn("core", F.col("bound"))
    grown = _stored(begun.groupBy("grp", "cell").applyInPandas(_grown_here, "grp long, cell long, id long, comp long, w double, lo long, hi long"), "grown")
    edge = F.col("w").isNotNull()
    edges = [grown.where(edge).select("grp", "w", "lo", "hi")]
    rows = _stored(begun.select("grp", "cell", "id", "x", "core").join(grown.where(~edge).select("grp", "id", "comp"), ["grp", "id"]), "rows")
    while several and rows.groupBy("grp").agg(F.count_distinct("comp").alias("n")).where("n > 1").limit(1).count():
        rows, found = _round(rows, boxes, pairs)
        edges.append(found)
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return begun.select("grp", "id", "core"), out


def _own_nearest(least: int):
    def run(key: tuple, here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(here["x"])
        d = distances(x, x)
        np.fill_diagonal(d, np.inf)
        return pd.DataFrame({"grp": here["grp"].to_numpy(), "id": here["id"].to_numpy(), "own": [row[np.isfinite(row)].tolist() for row in np.sort(d, axis=1)[:, :least]]})

    return run


def _round(rows: DataFrame, boxes: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: every component takes its cheapest way out; components that meet take the smallest id as their name."""
    columns = ["grp", "cell", "id", "x", "core", "comp", "bound"]
    here, there = _brought(rows.withColumn("bound", F.lit(math.inf)), boxes.select("grp", "cell", F.col("cell").alias("other")), columns)
    inside = _stored(here.cogroup(there).applyInPandas(_ways_out, WAY), "inside")
    bound = inside.groupBy("grp", "comp").agg(F.min("w").alias("bound"))
    reach = rows.select("grp", "cell", "comp").distinct().join(bound, ["grp", "comp"], "left").groupBy("grp", "cell").agg(F.max(F.coalesce("bound", F.lit(math.inf))).alias("reach"))
    near = pairs.join(reach, ["grp", "cell"]).where(F.col("gap") <= F.col("reach"))
    here, there = _brought(rows.join(bound, ["grp", "comp"], "left").withColumn("bound", F.coalesce("bound", F.lit(math.inf))), near, columns)
    ways = inside.unionByName(here.cogroup(there).applyInPandas(_ways_out, WAY))
    best = _stored(ways.groupBy("grp", "comp").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e")).select("grp", "comp", "e.*"), "best")
    # Ways out only grow dearer along a chain, so chains end in two components that chose the same edge.
    mutual = best.alias("a").join(best.alias("b"), (F.col("a.grp") == F.col("b.grp")) & (F.col("a.other") == F.col("b.comp")) & (F.col("b.other") == F.col("a.comp")), "left")
    up = mutual.select("a.grp", "a.comp", F.when(F.col("b.comp").isNotNull() & (F.col("a.comp") < F.col("a.other")), F.col("a.comp")).otherwise(F.col("a.other")).alias("up"))
    up = _stored(up, "up")
    while True:
        higher = up.select("grp", F.col("comp").alias("up"), F.col("up").alias("top"))
        nxt = _stored(up.join(higher, ["grp", "up"]).select("grp", "comp", F.col("top").alias("up")), "up")
        changed = nxt.join(up, ["grp", "comp", "up"], "left_anti").limit(1).count()
        up = nxt
        if not changed:
            break
    named = up.groupBy("grp", "up").agg(F.min("comp").alias("name"))
    merged = rows.join(up, ["grp", "comp"], "left").join(named, ["grp", "up"], "left").select("grp", "cell", "id", "x", "core", F.coalesce("name", "comp").alias("comp"))
    return _stored(merged, "rows"), best.select("grp", "w", "lo", "hi").distinct()


def most_stable(ids: np.ndarray, w: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Labels of ``ids`` (sorted) from the edges of their spanning tree; -1 is noise.

    Edges of equal weight join at once, so labels do not hang on their order. A component of ``least`` rows is a cluster; where two or more meet, they are children of a new one; rows that come in smaller components
    leave the cluster at that distance. A cluster's stability sums, over its rows, 1 / distance at which they leave it less that at which it began. From the leaves up a cluster is chosen over its chosen
    descendants unless they are more stable together; the whole is never chosen. Clusters are numbered by their smallest id.
    """
    n = len(ids)
    a, b = np.searchsorted(ids, a), np.searchsorted(ids, b)
    lam = 1 / np.maximum(w, NEAREST)
    sets, members = Sets(n), {i: [i] for i in range(n)} if least > 1 else {}
    size, node = np.ones(n, np.int64), np.full(n, -1)
    home = np.full(n, -1)
    left: list[list[float]] = []  # of each cluster: lambdas at which rows leave it
    kids: list[list[int]] = []
    birth: list[float] = []
    held: list[int] = []
    order = np.argsort(w, kind="stable")
    at = 0
    while at < n - 1 and at < len(order):
        end = at
        while end < len(order) and w[order[end]] == w[order[at]]:
            end += 1
        now, step = lam[order[at]], order[at:end]
        roots = {sets.find(i) for e in step for i in (a[e], b[e])}
        for e in step:
            sets.join(int(a[e]), int(b[e]))
        met: dict[int, list[int]] = {}
        for r in roots:
            met.setdefault(sets.find(r), []).append(r)
        for top, parts in met.items():
            big, total = [node[r] for r in parts if node[r] >= 0], int(sum(size[r] for r in parts))
            small = [p for r in parts if node[r] < 0 for p in members.pop(r, [r])]
            if len(big) == 1:
                own = int(big[0])
            elif big or total >= least:
                own = len(kids)
                kids.append([int(c) for c in big])
                left.append([])
                birth.append(0.0)
                held.append(0)
                for c in big:
                    birth[c] = now
            else:
                own = -1
                members[top] = small
            if own >= 0:
                home[small] = own
                left[own] += [now] * len(small)
                held[own] = total
            size[top], node[top] = total, own
        at = end
    if not kids:
        return np.full(n, -1)
    stability = [sum(left[c]) - birth[c] * len(left[c]) + sum(held[k] * (birth[k] - birth[c]) for k in kids[c]) for c in range(len(kids))]
    chosen, gain = np.zeros(len(kids), bool), [0.0] * len(kids)
    for c in range(len(kids)):  # children come before their parents
        below = sum(gain[k] for k in kids[c])
        gain[c] = max(below, stability[c])
        chosen[c] = below <= stability[c]
    root = len(kids) - 1
    label, queue = np.full(len(kids), -1), [(root, -1)]
    while queue:
        c, got = queue.pop()
        if got < 0 and c != root and chosen[c]:
            got = c
        label[c] = got
        queue += [(k, got) for k in kids[c]]
    of = np.where(home >= 0, label[home], -1)
    names = {c: i for i, c in enumerate(dict.fromkeys(int(c) for c in of if c >= 0))}
    return np.array([names.get(int(c), -1) for c in of], np.int64)


def _labelled(least: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        e = rows[rows["w"].notna()]
        ids = np.unique(rows.loc[rows["w"].isna(), "lo"].to_numpy(np.int64))
        label = most_stable(ids, e["w"].to_numpy(), e["lo"].to_numpy(np.int64), e["hi"].to_numpy(np.int64), least)
        return pd.DataFrame({"grp": key[0], "id": ids, "cluster": label})

    return run


def density_clusters(points: DataFrame, least: int) -> DataFrame:
    """(grp, id, cluster) of each row of ``points`` (grp and id long, x): clusters from 0, noise -1. Ids are unique in a group, x has no nulls and one length. Groups of at most ``least`` rows are noise; an empty table gives an empty result."""
    sized = points.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    p = _stored(points.join(F.broadcast(sized), "grp"), "points")  # one row for each group
    few = p.where(F.col("n") <= least).select("grp", "id", F.lit(-1).cast("long").alias("cluster"))
    width = p.where(F.col("n") > least).agg(F.max(F.size("x"))).first()[0]
    if width is None:
        return few
    cores, edges = spanning_forest(p.where(F.col("n") > least).select("grp", "id", "x"), least, width)
    none = F.lit(None).cast("double")
    both = edges.select("grp", "w", "lo", "hi").unionByName(cores.select("grp", none.alias("w"), F.col("id").alias("lo"), F.lit(0).cast("long").alias("hi")))
    return few.unionByName(both.groupBy("grp").applyInPandas(_labelled(least), "grp long, id long, cluster long"))
