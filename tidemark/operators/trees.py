"""Numpy helpers of the grouped workers in ``ml``: histogram trees, softmax boosting with early stopping, forests, softmax regression, and exact attributions.

A model is a dict of arrays. Trees lie one after the other: ``feature`` (-1 in a leaf), ``threshold`` (left if x <= it), ``left``, ``right``, ``value`` (a column for each class),
``cover`` (weight of the training rows) and ``root`` (where each tree begins); what a row gets is the sum of its leaves' values.
"""

from __future__ import annotations

import io

import numpy as np

CLASSES = 3
BINS = 64
Model = dict[str, np.ndarray]


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Per feature the values between which bins lie: all distinct ones but the largest, or quantiles of them."""
    out = []
    for c in x.T:
        v = np.unique(c)
        out.append(v[:-1] if len(v) <= BINS else np.unique(np.quantile(c, np.arange(1, BINS) / BINS, method="lower")))
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Row's bin in each feature, a feature's bins side by side: a bin is at most k if x <= edge k."""
    return np.stack([np.searchsorted(e, c, "left").astype(np.uint8) for e, c in zip(edges, x.T, strict=True)]).T if x.shape[1] else np.zeros((len(x), 0), np.uint8)


def histograms(b: np.ndarray, slot: np.ndarray, chosen: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of each row of ``values`` by (row, slot, place in the slot's ``chosen`` features, bin); ``b`` has a row for each feature. One feature at a time, so that no array has a value for each row and feature."""
    slots, f = chosen.shape
    out, at, nth, same = np.empty((len(values), slots, f, BINS)), slot * BINS, np.arange(len(slot)), (chosen == chosen[:1]).all()
    for j in range(f):
        k = at + (b[chosen[0, j]] if same else b[chosen[slot, j], nth])
        for v, o in zip(values, out, strict=True):
            o[:, j] = np.bincount(k, v, slots * BINS).reshape(slots, BINS)
    return out


def grow(b: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float, columns) -> Model:
    """A tree grown level by level. ``g`` (rows x outputs) are gradients and ``h`` weights of the same shape or one column; a split gains the sum over outputs of G^2 / (H + ridge) on either side.

    ``columns(slots)`` lists the features that each node of a level may use. With g = -weight * one-hot and h = weight the gain is Gini's and -G / H the classes' shares.
    """
    outs, usable = g.shape[1], np.array([len(e) for e in edges])
    b, v = np.ascontiguousarray(b.T), np.ascontiguousarray(np.concatenate([g, h], axis=1).T)
    feature, threshold, left, right = [-1], [0.0], [-1], [-1]
    sums, covers = [g.sum(0)], [h.sum(0)]
    slot, nodes = np.zeros(len(g), np.int64), np.array([0])
    for _ in range(depth):
        s = len(nodes)
        chosen = columns(s)
        both = histograms(b, slot, chosen, v).cumsum(axis=3)
        gl, hl = both[:outs], both[outs:]
        gt, ht = gl[..., -1:], hl[..., -1:]
        gain = ((gl**2 / (hl + ridge)) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)).sum(axis=0) if ridge else _gini(gl, hl, gt, ht)
        fit = (hl.sum(0) >= least) & ((ht - hl).sum(0) >= least) & (np.arange(BINS) < usable[chosen][:, :, None])
        gain = np.where(fit, gain, -np.inf).reshape(s, -1)
        best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(s, np.int64)
        good = gain[np.arange(s), best] > 1e-9 if gain.shape[1] else np.zeros(s, bool)
        if not good.any():
            break
        place, k = best // BINS, best % BINS
        f = chosen[np.arange(s), place]
        nodes_below = []
        for i in np.flatnonzero(good):
            at = nodes[i]
            nodes_below += [len(feature), len(feature) + 1]
            feature[at], threshold[at], left[at], right[at] = int(f[i]), float(edges[f[i]][k[i]]), len(feature), len(feature) + 1
            lg, lh = gl[:, i, place[i], k[i]], hl[:, i, place[i], k[i]]
            sums += [lg, sums[at] - lg]
            covers += [lh, covers[at] - lh]
            feature, threshold, left, right = feature + [-1, -1], threshold + [0.0, 0.0], left + [-1, -1], right + [-1, -1]
        on = good[slot]
        if not on.all():
            b, v, slot = b[:, on], v[:, on], slot[on]
        slot = 2 * (good.cumsum() - 1)[slot] + (b[f[slot], np.arange(len(slot))] > k[slot])
        nodes = np.array(nodes_below)
    sums, covers = np.array(sums), np.array(covers)
    return {"feature": np.array(feature), "threshold": np.array(threshold), "left": np.array(left), "right": np.array(right), "value": -sums / np.maximum(covers + ridge, 1e-300), "cover": covers.sum(1)}


def _gini(gl: np.ndarray, hl: np.ndarray, gt: np.ndarray, ht: np.ndarray) -> np.ndarray:
    """Without a ridge an empty side gains nothing."""
    parts = [np.divide(a**2, np.broadcast_to(w, a.shape), out=np.zeros_like(a), where=np.broadcast_to(w, a.shape) > 1e-12) for a, w in ((gl, hl), (gt - gl, ht - hl), (gt + 0 * gl, ht + 0 * hl))]
    return (parts[0] + parts[1] - parts[2]).sum(axis=0)


def stacked(trees: list[Model]) -> Model:
    """Trees one after the other."""
    root = np.cumsum([0, *[len(t["feature"]) for t in trees]])[:-1]
    shift = {"left": root, "right": root}
    out = {k: np.concatenate([np.where(t[k] >= 0, t[k] + r, -1) if k in shift else t[k] for t, r in zip(trees, root, strict=True)]) for k in ("feature", "threshold", "left", "right", "value", "cover")}
    return out | {"root": root}


def leaf_of(m: Model, x: np.ndarray, root: int = 0) -> np.ndarray:
    """The leaf of each row under ``root``."""
    feature, own, nth = m["feature"], np.arange(len(m["feature"])), np.arange(len(x))
    inner = feature >= 0
    below = np.stack([np.where(inner, m["right"], own), np.where(inner, m["left"], own)])
    feature, at = np.maximum(feature, 0), np.full(len(x), root)
    while inner[at].any():
        at = below[(x[nth, feature[at]] <= m["threshold"][at]).view(np.int8), at]
    return at


def leaf_sums(m: Model, x: np.ndarray) -> np.ndarray:
    """The sum of each row's leaves' values."""
    out = np.zeros((len(x), m["value"].shape[1]))
    for r in m["root"]:
        out += m["value"][leaf_of(m, x, r)]
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def log_loss(p: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-15)).mean())


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int, held: tuple[np.ndarray, np.ndarray] | None = None, patience: int = 50, seed: int = 42, depth: int = 6, rate: float = 0.05, share: float = 0.8, ridge: float = 1.0) -> Model:
    """Softmax boosting: every round one tree for each class, from ``share`` of rows and features; with ``held`` rows it stops ``patience`` rounds after the best log loss there and keeps the trees up to it."""
    rng, edges = np.random.default_rng(seed), bin_edges(x)
    b, one = binned(x, edges), np.eye(CLASSES)[y]
    margin, trees, best = np.zeros((len(x), CLASSES)), [], (np.inf, 0)
    test = np.zeros((len(held[0]), CLASSES)) if held else None
    f = x.shape[1]
    for k in range(rounds):
        p = softmax(margin)
        rows = np.flatnonzero(rng.random(len(x)) < share) if share < 1 else np.arange(len(x))
        some = np.sort(rng.permutation(f)[: max(1, int(share * f))])
        g, h = ((p - one) * w[:, None])[rows], np.maximum(2 * p * (1 - p) * w[:, None], 1e-16)[rows]
        part = b.T[:, rows].T
        for c in range(CLASSES):
            t = grow(part, edges, g[:, [c]], h[:, [c]], depth, ridge, 1.0, lambda s: np.broadcast_to(some, (s, len(some))))
            value = np.zeros((len(t["value"]), CLASSES))
            value[:, c] = rate * t["value"][:, 0]
            trees.append(stacked([t | {"value": value}]))
            margin[:, c] += value[leaf_of(t, x), c]
            if held:
                test[:, c] += value[leaf_of(t, held[0]), c]
        if held:
            loss = log_loss(softmax(test), held[1])
            if loss < best[0]:
                best = (loss, k + 1)
            elif k + 1 - best[1] >= patience:
                break
    return stacked(trees[: CLASSES * best[1]] if held else trees) | {"kind": np.array("boosted")}


def forest(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 200, depth: int = 8, seed: int = 42) -> Model:
    """Trees of bootstrapped rows by Gini's gain; each node looks at a random root of the features. Values are the classes' shares over the number of trees."""
    rng, edges, f = np.random.default_rng(seed), bin_edges(x), x.shape[1]
    b, one, most = binned(x, edges), np.eye(CLASSES)[y], max(1, int(np.sqrt(x.shape[1])))
    out = []
    for _ in range(trees):
        times = np.bincount(rng.integers(0, len(x), len(x)), minlength=len(x))
        rows = np.flatnonzero(times)
        v = (w[rows] * times[rows])[:, None]
        t = grow(b.T[:, rows].T, edges, -one[rows] * v, v, depth, 0.0, 1e-12, lambda s: rng.random((s, f)).argsort(axis=1)[:, :most])
        out.append(t | {"value": t["value"] / trees})
    return stacked(out) | {"kind": np.array("forest")}


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float = 1.0, steps: int = 100) -> Model:
    """Softmax regression of standardised features by Newton's steps; coefficients, not intercepts, are penalised by half their squares."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 0, scale, 1.0)
    a, one = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1), np.eye(CLASSES)[y]
    d = a.shape[1]
    ridge = np.tile(np.r_[np.full(d - 1, penalty), 1e-8], CLASSES)

    def loss(beta: np.ndarray) -> float:
        z = a @ beta.T
        top = z.max(axis=1)
        return float((w * (top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - z[np.arange(len(y)), y])).sum() + 0.5 * (ridge * beta.ravel() ** 2).sum())

    beta = np.zeros((CLASSES, d))
    now = loss(beta)
    for _ in range(steps):
        p = softmax(a @ beta.T)
        grad = (((p - one) * w[:, None]).T @ a).ravel() + ridge * beta.ravel()
        hess = np.diag(ridge)
        for i in range(CLASSES):
            for j in range(CLASSES):
                hess[i * d : (i + 1) * d, j * d : (j + 1) * d] += (a * (w * p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ a
        step, size = np.linalg.solve(hess, grad).reshape(CLASSES, d), 1.0
        while (then := loss(beta - size * step)) > now and size > 1e-6:
            size /= 2
        if now - then <= 1e-9 * max(1.0, abs(now)):
            break
        beta, now = beta - size * step, then
    return {"kind": np.array("logistic"), "mean": mean, "scale": scale, "beta": beta}


def probabilities(m: Model, x: np.ndarray) -> np.ndarray:
    kind = str(m["kind"])
    if kind == "logistic":
        return softmax(((x - m["mean"]) / m["scale"]) @ m["beta"][:, :-1].T + m["beta"][:, -1])
    s = leaf_sums(m, x)
    return softmax(s) if kind == "boosted" else s / np.maximum(s.sum(axis=1, keepdims=True), 1e-300)


def weighted_f1(y: np.ndarray, guess: np.ndarray) -> float:
    """F1 by class, weighted by the classes' rows; a class without a right guess counts 0."""
    total = 0.0
    for c in np.unique(y):
        hit = ((y == c) & (guess == c)).sum()
        total += (y == c).sum() * 2 * hit / ((y == c).sum() + (guess == c).sum())
    return float(total / len(y)) if len(y) else 0.0


def leaves(m: Model, root: int):
    """Of each leaf under ``root``: its node and, by feature on the way, (low, high, share): the interval that leads there and the share of cover that would take the way without knowing the feature."""
    stack = [(int(root), {})]
    while stack:
        n, path = stack.pop()
        f = int(m["feature"][n])
        if f < 0:
            yield n, path
            continue
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        cut = float(m["threshold"][n])
        for child, lo, hi in ((int(m["left"][n]), low, min(high, cut)), (int(m["right"][n]), max(low, cut), high)):
            stack.append((child, path | {f: (lo, hi, share * m["cover"][child] / m["cover"][n])}))


def attributions(m: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact path-dependent Shapley values (rows x features x classes) of the sums of leaves, and the base value.

    A leaf's game is the product over its features of o (known: does the row go there?) or z (unknown: the share that does). Shapley's weights are integrals of powers of t and 1 - t, so a
    feature's part is (o - z) times the integral over t of the product of o t + z (1 - t) over the others: a polynomial, which Gauss's rule integrates exactly.
    """
    phi, base = np.zeros((len(x), x.shape[1], m["value"].shape[1])), np.zeros(m["value"].shape[1])
    for r in m["root"]:
        for n, path in leaves(m, r):
            value = m["value"][n]
            if not path:
                base += value
                continue
            f = np.array(list(path))
            low, high, z = (np.array(v) for v in zip(*path.values(), strict=True))
            base += value * z.prod()
            t, w = np.polynomial.legendre.leggauss((len(f) + 1) // 2)
            t, w = (t + 1) / 2, w / 2
            o = ((x[:, f] > low) & (x[:, f] <= high)).astype(float)
            terms = o[:, :, None] * t + z[None, :, None] * (1 - t)
            part = (o - z) * ((terms.prod(axis=1)[:, None, :] / terms) * w).sum(axis=2)
            phi[:, f, :] += part[:, :, None] * value
    return phi, base


def linear_attributions(m: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shapley values of the linear margins for independent features: a coefficient times the standardised value."""
    z = (x - m["mean"]) / m["scale"]
    return z[:, :, None] * m["beta"][:, :-1].T[None], m["beta"][:, -1]


def packed(m: Model) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **m)
    return out.getvalue()


def unpacked(raw: bytes) -> Model:
    with np.load(io.BytesIO(bytes(raw)), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}
