"""Feature building, clustering, training and scoring.

Models are fitted by grouped workers, one for each (slot, candidate, fold), on all rows of the slot that the fold trains on and tests.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.core import KEY, in_blocks
from tidemark.operators import rolling, trees
from tidemark.operators.density import density_clusters
from tidemark.operators.places import in_ranks
from tidemark.sources.io import scratch

#: Columns that are never features.
NOT_FEATURES = ["ts", "ts_date", "exchange", "symbol", "regime", "cluster", "label_revert_3", "label_revert_10", "label_spread", "adf_pvalue_60", "hedge_ratio_kalman", "spread", "spread_zscore"]
LABELS = {"REVERT": 0, "FLAT": 1, "TREND": 2}
SPREAD_LABELS = {"CONVERGE": 0, "NEUTRAL": 1, "DIVERGE": 2}
WEIGHTS = {0: 2.0, 1: 1.0, 2: 2.0}
TRENDING = ["TRENDING_UP", "TRENDING_DOWN"]
NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def feature_cols(df: DataFrame) -> list[str]:
    """Numeric columns but for the excluded names and labels."""
    return [c for c, t in df.dtypes if t in NUMERIC and c not in NOT_FEATURES and not c.startswith("label_")]


def feature_profile(df: DataFrame) -> DataFrame:
    """M01 over rows: each feature column with its rows and nulls."""
    cols = feature_cols(df)
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(cols)])
    return one.select("rows", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"nulls_{i}").alias("nulls")) for i, c in enumerate(cols)])).alias("f")).select("f.name", "rows", "f.nulls")


def build_features(bars: DataFrame, regimes: DataFrame | None = None) -> DataFrame:
    """Quotes carried forward, smoothed flow, ratios, rolling statistics (the half-life of the microprice delta), interactions of the smoothed columns, the regime as of the bar."""
    delta = F.col("microprice_mid_delta") if "microprice_mid_delta" in bars.columns else F.lit(None).cast("double")

    def run(x: DataFrame, keys: list[str]) -> DataFrame:
        x = rolling.savgol5(rolling.savgol5(x, "ofi_l1", keys=keys), "spread_mean", keys=keys)
        x = rolling.hurst(rolling.hurst(rolling.flow_ratios(x), 20, keys), 60, keys)
        x = rolling.ou_halflife(x.withColumn("delta", F.coalesce(delta, F.lit(0.0))), 60, "delta", keys).drop("delta")
        return rolling.kyle_lambda(x, 60, keys)

    # One cut into blocks serves all windows: 60 rows of flow that is smoothed over 5.
    x = in_blocks(rolling.ffill_quotes(bars), 64, run)
    x = rolling.interactions(x, "ofi_l1_sg", "spread_mean_sg").withColumn("microprice_x_hawkes", F.coalesce("microprice_x_hawkes", F.lit(0.0)))
    if regimes is not None:
        x = x.join(regimes.select(*KEY, "ts", "regime"), [*KEY, "ts"], "left").withColumn("regime", F.coalesce("regime", F.lit("RANGING")))
    return x


def write_labels(df: DataFrame, path: str) -> None:
    """The label table by exchange, symbol and date; a rerun replaces the partitions that it writes."""
    df.withColumn("date", F.to_date("ts")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("exchange", "symbol", "date").parquet(path)


#: The regimes that are clustered.
REGIMES = ["RANGING", "HIGH_VOL", "THIN_BOOK", "TRENDING_UP", "TRENDING_DOWN"]


def regime_points(features: DataFrame, cols: list[str], least: int, components: int) -> DataFrame | None:
    """(grp, id, x): the principal components (``components`` at most) of the standardised features of each regime with ``least`` rows; grp is the regime's place in ``REGIMES``. None if there is no such regime."""
    sizes = {r["regime"]: r["n"] for r in features.where(F.col("regime").isin(REGIMES)).groupBy("regime").agg(F.count(F.lit(1)).alias("n")).collect()}  # five regimes
    parts = []
    for k, regime in enumerate(REGIMES):
        if sizes.get(regime, 0) < least or not cols:
            continue
        raw = features.where(F.col("regime") == regime).select("id_", array_to_vector(_vector(cols)).alias("raw"))
        steps = [StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), PCA(k=min(components, len(cols), sizes[regime] - 1), inputCol="scaled", outputCol="components")]
        turned = Pipeline(stages=steps).fit(raw).transform(raw).select(F.lit(k).cast("long").alias("grp"), F.col("id_").alias("id"), vector_to_array("components").alias("x"))
        parts.append(turned.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), components - F.size("x")))))  # regimes may have fewer components; zeros change no distance
    return reduce(DataFrame.unionByName, parts) if parts else None


def cluster_regimes(features: DataFrame, cols: list[str], least: int = 50, components: int = 10) -> DataFrame:
    """Density clusters of at least ``least`` rows in each regime, on the principal components of its standardised features; noise is -1.

    Rows of regimes with fewer rows, of other regimes and without one keep the label they had, or -1 if there is no column ``cluster``. Without feature columns or rows nothing is clustered.
    """
    path, spark = scratch(features.sparkSession, "features"), features.sparkSession
    features.withColumn("id_", F.monotonically_increasing_id()).write.parquet(path)
    t = spark.read.parquet(path)
    old = F.col("cluster").cast("int") if "cluster" in features.columns else F.lit(-1)
    rest = [c for c in features.columns if c != "cluster"]
    points = regime_points(t, cols, least, components)
    if points is None:
        return t.select(*rest, old.alias("cluster"))
    path = scratch(spark, "clusters")
    density_clusters(points, least).select(F.col("id").alias("id_"), F.col("cluster").cast("int").alias("label_")).write.parquet(path)
    return t.join(spark.read.parquet(path), "id_", "left").select(*rest, F.coalesce("label_", old).alias("cluster"))


def cluster_stats(clustered: DataFrame, least: int = 50) -> DataFrame:
    """M04 by regime: rows, clusters and the share of noise in percent, of the regimes with ``least`` rows."""
    by = clustered.where(F.col("regime").isin(REGIMES)).groupBy("regime")
    noise = 100 * F.avg((F.col("cluster") == -1).cast("int"))
    return by.agg(F.count(F.lit(1)).alias("n_samples"), F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"), F.round(noise, 1).alias("noise_pct")).where(F.col("n_samples") >= least)


def with_weights(df: DataFrame, label: str) -> DataFrame:
    """Label index (unknown is FLAT) and class weight."""
    index = reduce(lambda acc, kv: F.when(F.col(label) == kv[0], kv[1]).otherwise(acc), LABELS.items(), F.lit(1))
    d = df.withColumn("label", index.cast("double"))
    return d.withColumn("weight", F.when(F.col("label") == 1, WEIGHTS[1]).otherwise(WEIGHTS[0]))


#: Rows that attributions are averaged over: the slot's first ones, as the reference does.
EXPLAINED = 500
#: The candidates in the order in which ties are decided.
CANDIDATES = ("boosted", "forest", "logistic")
#: Rounds of boosting over folds, where the test part stops them, and of the refit on all rows, which nothing stops.
ROUNDS, FINAL_ROUNDS = 500, 300
SLOT = ["regime", "cluster"]
#: Partitions for fits, one each if there are no more.
MOST_TASKS = 2000


def balanced(y: np.ndarray) -> np.ndarray:
    """Each row's weight by the rarity of its class."""
    n = np.bincount(y, minlength=trees.CLASSES)
    return (len(y) / ((n > 0).sum() * np.maximum(n, 1)))[y]


def fitted(name: str, x: np.ndarray, y: np.ndarray, held: tuple[np.ndarray, np.ndarray] | None = None) -> trees.Model:
    """One candidate at the reference's size with class weights; forest and regression multiply them with balanced ones. With ``held`` rows boosting stops early."""
    w = np.array([WEIGHTS[c] for c in range(trees.CLASSES)])[y]
    if name == "boosted":
        return trees.boost(x, y, w, ROUNDS if held else FINAL_ROUNDS, held)
    return trees.forest(x, y, w * balanced(y)) if name == "forest" else trees.logistic(x, y, w * balanced(y))


def purged_parts(nth: np.ndarray, n: int, fold: int, folds: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Which positions of ``n`` train and test in a fold (from 1): [0, e) and [e + gap, e + gap + size)."""
    size = n // (folds + 1)
    end = size * fold
    return nth < end, (nth >= end + gap) & (nth < end + gap + size)


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = rows.sort_values("nth_", kind="stable")
    return np.array(rows["x"].tolist(), np.float64).reshape(len(rows), -1), rows["y"].to_numpy(np.int64), rows["nth_"].to_numpy()


def _fold_score(folds: int, gap: int):
    """The weighted F1 of one candidate on one fold of a slot; 0 where a fold trains on one class or tests nothing."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        *slot, name, fold = key
        x, y, nth = _arrays(rows)
        train, test = (slice(part.argmax(), part.argmax() + part.sum()) for part in purged_parts(nth, int(rows["n_"].iloc[0]), fold, folds, gap))  # ranges, which are not copied
        f1, grown = 0.0, 0
        if len(np.unique(y[train])) > 1 and len(y[test]):
            m = fitted(name, x[train], y[train], (x[test], y[test]))
            f1, grown = trees.weighted_f1(y[test], trees.probabilities(m, x[test]).argmax(axis=1)), len(m.get("root", ()))
        return pd.DataFrame([(*slot, name, fold, f1, grown)])

    return run


def _refit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The chosen candidate on all of a slot's rows, with its mean absolute attributions (class by class for each feature)."""
    x, y, _ = _arrays(rows)
    name = rows["candidate"].iloc[0]
    m = fitted(name, x, y)
    phi, _ = (trees.linear_attributions if name == "logistic" else trees.attributions)(m, x[:EXPLAINED])
    by_class = np.abs(phi).mean(axis=0)
    return pd.DataFrame([(*key, by_class.ravel().tolist(), trees.packed(m))])


def _vector(cols: list[str]) -> Column:
    """The features, nulls and NaNs as 0."""
    return F.array(*[F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cols])


REGISTRY = "regime string, cluster int, model_id string, cv_score double, n long, scores map<string,double>, importances map<string,double>, by_class map<string,array<double>>, features array<string>, model binary"


def train_slots(features: DataFrame, target: str, cols: list[str], folds: int = 5, gap: int = 5, least: int = 200, labels: dict[str, int] = LABELS) -> DataFrame:
    """For each (regime, cluster) with ``least`` rows that have a label, neither trending nor noise, the candidate of the best mean weighted F1 over purged folds, refitted on all rows.

    A registry row for each slot: model_id (boosted, forest, logistic), cv_score, n, the candidates' scores, mean absolute attributions by feature (M08), the features and the model. Unknown labels count as FLAT, null and
    empty ones leave. Slots of one class are left out. Models see all rows of their fold and, chosen, of their slot; one worker holds them. No slot: an empty table.
    """
    spark = features.sparkSession
    known = features.where(F.col(target).isNotNull() & (F.col(target) != "") & ~F.col("regime").isin(TRENDING) & (F.col("cluster") != -1))
    y = reduce(lambda acc, kv: F.when(F.col(target) == kv[0], kv[1]).otherwise(acc), labels.items(), F.lit(1))
    rows = known.select("regime", F.col("cluster").cast("int").alias("cluster"), "ts", *KEY, _vector(cols).alias("x"), y.alias("y"))
    path = scratch(spark, "slots")
    in_ranks(rows, SLOT, ["ts", *KEY]).where(F.col("n_") >= least).select(*SLOT, "x", "y", "nth_", "n_").write.parquet(path)
    placed = spark.read.parquet(path)
    many = placed.groupBy(*SLOT).agg(F.max("n_").alias("n"), F.count_distinct("y").alias("classes")).where("classes > 1").drop("classes")
    tasks = many.select(*SLOT, "n", F.explode(F.array(*[F.lit(c) for c in CANDIDATES])).alias("candidate")).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    tasks = tasks.where(F.floor(F.col("n") / (folds + 1)) * (F.col("fold") + 1) + gap <= F.col("n")).drop("n")  # folds past the end are left out
    seen = placed.join(tasks, SLOT).where(F.col("nth_") < F.floor(F.col("n_") / (folds + 1)) * (F.col("fold") + 1) + gap)  # a fold ends with its test part
    grouped = seen.repartition(max(1, min(tasks.count(), MOST_TASKS)), *SLOT, "candidate", "fold").groupBy(*SLOT, "candidate", "fold")  # a fit holds its rows
    scored = grouped.applyInPandas(_fold_score(folds, gap), "regime string, cluster int, candidate string, fold int, f1 double, trees int")
    path = scratch(spark, "scores")
    scored.write.parquet(path)
    means = spark.read.parquet(path).groupBy(*SLOT, "candidate").agg(F.avg("f1").alias("f1"))
    order = F.create_map(*[x for i, c in enumerate(CANDIDATES) for x in (F.lit(c), F.lit(-i))])
    every = many.select(*SLOT, "n", F.explode(F.array(*[F.lit(c) for c in CANDIDATES])).alias("candidate")).join(means, [*SLOT, "candidate"], "left").withColumn("f1", F.coalesce("f1", F.lit(0.0)))
    best = every.groupBy(*SLOT, "n").agg(F.max_by("candidate", F.struct("f1", order[F.col("candidate")])).alias("candidate"), F.max("f1").alias("cv_score"), F.map_from_entries(F.collect_list(F.struct("candidate", "f1"))).alias("scores"))
    chosen = placed.join(best.select(*SLOT, "candidate"), SLOT).repartition(*SLOT).groupBy(*SLOT)
    models = chosen.applyInPandas(_refit, "regime string, cluster int, told array<double>, model binary")
    path = scratch(spark, "registry")
    by_class = F.transform(F.sequence(F.lit(0), F.size("features") - 1), lambda i: F.slice("told", i * trees.CLASSES + 1, trees.CLASSES))
    whole = best.join(models, SLOT).withColumn("features", F.array(*[F.lit(c) for c in cols])).withColumn("by_class", by_class)
    summed = F.transform("by_class", lambda v: F.aggregate(v, F.lit(0.0), lambda acc, u: acc + u))
    whole = whole.withColumn("importances", F.map_from_arrays("features", summed)).withColumn("by_class", F.map_from_arrays("features", "by_class"))
    whole.select(*SLOT, F.col("candidate").alias("model_id"), "cv_score", "n", "scores", "importances", "by_class", "features", "model").write.parquet(path)
    return spark.read.schema(REGISTRY).parquet(path)


def importances(registry: DataFrame) -> DataFrame:
    """Mean absolute attribution of each feature of each slot's model: exact path-dependent Shapley values of trees' sums, linear ones of a regression; over classes, and for each class."""
    return registry.select(*SLOT, "model_id", F.explode("importances").alias("feature", "importance"), "by_class").withColumn("by_class", F.element_at("by_class", F.col("feature")))


def gated(df: DataFrame) -> Column:
    """Rows that are FLAT without a model: trending regimes, and a Hurst exponent of 0.5 or more where there is one."""
    hurst = F.coalesce(F.col("hurst_60"), F.lit(0.0)) >= 0.5 if "hurst_60" in df.columns else F.lit(False)
    return F.coalesce(F.col("regime").isin(TRENDING), F.lit(False)) | hurst


def _guesser(models: dict[str, tuple[bytes, np.ndarray]]):
    """Class shares of each row by its regime's model; the features are those of all models, each takes its own."""
    held: dict[str, tuple] = {}

    @F.pandas_udf("array<double>")
    def guess(regime: pd.Series, x: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(regime), dtype=object)
        for name in regime.unique():
            if name not in held:
                raw, own = models[name]
                held[name] = (trees.unpacked(raw), own)
            m, own = held[name]
            at = np.flatnonzero((regime == name).to_numpy())
            p = trees.probabilities(m, np.array(x.iloc[at].tolist(), np.float64).reshape(len(at), -1)[:, own])
            out.iloc[at] = list(p)
        return out

    return guess


def best_models(registry: DataFrame) -> dict[str, dict]:
    """The model of each regime with the best cv_score (of equal ones the smaller cluster). Regimes are few, a model has at most FINAL_ROUNDS trees for a class."""
    own = Window.partitionBy("regime").orderBy(F.desc("cv_score"), "cluster")
    best = registry.where("cluster <> -1").withColumn("first", F.row_number().over(own)).where("first = 1")
    return {r["regime"]: r.asDict() for r in best.collect()}


def score(features: DataFrame, registry: DataFrame) -> DataFrame:
    """Label, confidence, model_id, the model's cluster and the deviation of every row: FLAT 1.0 by the gates or where the regime has no model, else the likeliest class of the regime's best model."""
    best = best_models(registry)
    all_cols = sorted({c for b in best.values() for c in b["features"]})
    models = {k: (bytes(b["model"]), np.array([all_cols.index(c) for c in b["features"]], np.int64)) for k, b in best.items()}
    known = [c for c in all_cols if c in features.columns]
    x = F.array(*[F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) if c in known else F.lit(0.0) for c in all_cols])
    deviation = F.coalesce(F.col("microprice_mid_delta").cast("double"), F.lit(0.0)) if "microprice_mid_delta" in features.columns else F.lit(0.0)
    has_model = F.col("regime").isin(list(models)) if models else F.lit(False)
    open_row = ~gated(features) & F.coalesce(has_model, F.lit(False))
    flat = features.where(~open_row).select(*KEY, "ts", "regime", F.lit("FLAT").alias("label"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("model_id"), F.lit(-1).alias("model_cluster"), deviation.alias("deviation"))
    if not models:
        return flat
    p = features.where(open_row).select(*KEY, "ts", "regime", deviation.alias("deviation"), _guesser(models)("regime", x).alias("p"))
    names = F.array(*[F.lit(n) for n in LABELS])
    which = F.array_position("p", F.array_max("p")).cast("int")
    ids, clusters = (F.create_map(*[v for k, b in best.items() for v in (F.lit(k), F.lit(b[f]))]) for f in ("model_id", "cluster"))
    told = p.select(*KEY, "ts", "regime", F.element_at(names, which).alias("label"), F.array_max("p").alias("confidence"), ids[F.col("regime")].alias("model_id"), clusters[F.col("regime")].alias("model_cluster"), "deviation")
    return flat.unionByName(told)


#: The slot under which a pair's models stand in the registry.
PAIR = "SPREAD"


def train_spread(pair: DataFrame, cols: list[str], **sizes) -> DataFrame:
    """The pair's models: as M07, over all rows of ``pair`` (exchange, ts, label_spread of W14, features) as one slot."""
    rows = pair.withColumns({"symbol": F.lit(PAIR), "regime": F.lit(PAIR), "cluster": F.lit(0)})
    return train_slots(rows, "label_spread", cols, labels=SPREAD_LABELS, **sizes)


def score_spread(pair: DataFrame, registry: DataFrame | None = None, z_min: float = 1.5, p_max: float = 0.1) -> DataFrame:
    """Adds label, reason, confidence and model_id. NEUTRAL with confidence 0 inside the zone (a null z too), where the unit-root test fails (a null p counts as 1) and where the registry has no pair model;
    else the likeliest class of its model with the best cv_score."""
    z, p = F.col("spread_z"), F.coalesce(F.col("adf_pvalue_60"), F.lit(1.0))
    best = None if registry is None else best_models(registry.where(F.col("regime") == PAIR)).get(PAIR)
    reason = F.when(z.isNull() | F.isnan(z) | (F.abs(z) <= z_min), "neutral_zone").when(p > p_max, "adf_fail").otherwise("model" if best else "no_spread_model")
    out = pair.withColumn("reason", reason)
    if best is None:
        return out.withColumns({"label": F.lit("NEUTRAL"), "confidence": F.lit(0.0), "model_id": F.lit(None).cast("string")})
    guess = _guesser({PAIR: (bytes(best["model"]), np.arange(len(best["features"])))})
    have = [c if c in pair.columns else None for c in best["features"]]
    x = F.array(*[F.lit(0.0) if c is None else F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in have])
    out = out.withColumn("shares_", guess(F.lit(PAIR), x))
    names = F.array(*[F.lit(n) for n in SPREAD_LABELS])
    on = F.col("reason") == "model"
    label = F.when(on, F.element_at(names, F.array_position("shares_", F.array_max("shares_")).cast("int"))).otherwise("NEUTRAL")
    return out.withColumns({"label": label, "confidence": F.when(on, F.array_max("shares_")).otherwise(0.0), "model_id": F.when(on, F.lit(best["model_id"]))}).drop("shares_")
