"""Cross-validated training, ensemble scoring and rank blending on pyspark.ml.

The booster is Spark's ``GBTClassifier`` (distributed fit); the reference's
LightGBM-specific knobs without a Spark counterpart (L1/L2, leaves,
categorical smoothing) are not reproduced.

The wide feature table is read twice, whatever the number of folds, members and
rounds: once for the quantile cuts of every numeric column (a bounded sample), once to write each
row's bins as one vector next to its fold and encodings.  All fits read that
narrow table; a fold's vectors are written once.  Categorical features are
target-encoded per fold with the one-pass "total minus fold" tables, joined once
for all folds.

A booster stops by patience: it is fitted in growing stages, the held-out loss
of every round is read from the model, and the best round is the one that no
round of the next ``patience`` improves.  A fitted ensemble carries its cuts and
encodings, so it scores rows by itself after it is saved and loaded.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.operators.ordered import average_rank, prefix_counts, stratified_folds
from loanlens.operators.target_encoding import (category_key, encoding_arrays, fit_target_encodings, hash_normal,
                                                join_levels)
from loanlens.session import cut_lineage


@dataclass(frozen=True)
class BoostParams:
    max_depth: int = 6
    step_size: float = 0.03
    subsampling_rate: float = 0.7
    feature_subset: str = "0.7"
    max_bins: int = 100
    min_instances: int = 100
    max_iter: int = 10_000  # patience ends the fit
    patience: int = 50
    least_gain: float = 0.0  # a round's loss must fall by more than this to count as a gain
    seed: int = 42


# -- vectors -------------------------------------------------------------------
#: Rows that the quantile cuts are taken from: about so many, by a hash of the id.
CUT_ROWS = 20_000


def fit_cuts(df: DataFrame, features: Sequence[str], bins: int = 100, id_col: str | None = None,
             rows: int = CUT_ROWS) -> dict[str, list[float]]:
    """Quantile cuts of each column, at most ``bins`` - 1, from one pass over the
    table.  Tables beyond ``rows`` rows are sampled by a hash of ``id_col``, so
    that the driver holds about ``rows`` doubles a column; the booster's own
    split points come from a sample of that size, too.  A column without values
    has no cuts."""
    features = list(features)
    if not features:
        return {}
    n = df.count()
    if n > rows:
        limit = int((1 << 30) * (rows / n))
        key = F.xxhash64(F.col(id_col)) if id_col else F.xxhash64(*df.columns)
        df = df.where(F.pmod(key, F.lit(1 << 30)) < limit)

    def run(batches):
        for batch in batches:
            if len(batch):
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["x"])

    values = df.select(*[F.col(c).cast("double").alias(f"_b{k}") for k, c in enumerate(features)])
    got = [np.frombuffer(r["x"], np.float64).reshape(-1, len(features)) for r in values.mapInArrow(run, "x binary").collect()]
    x = np.concatenate(got) if got else np.zeros((0, len(features)))
    share = np.arange(1, bins) / bins
    out = {}
    for k, c in enumerate(features):
        own = x[:, k][~np.isnan(x[:, k])]
        out[c] = np.unique(np.quantile(own, share, method="inverted_cdf")).tolist() if len(own) else []
    return out


def binned_rows(df: DataFrame, cuts: dict[str, list[float]], carry: Sequence[str]) -> DataFrame:
    """``carry`` columns and ``bins``: 0 for a missing value, else 1 plus the cuts below the value."""
    edges = [np.array(c, np.float64) for c in cuts.values()]

    def run(batches):
        for batch in batches:
            held = batch.num_columns - len(edges)
            out = np.zeros((len(batch), len(edges)), np.float32)
            for k, cut in enumerate(edges):
                x = batch.column(held + k).to_numpy(zero_copy_only=False).astype(np.float64)
                out[:, k] = np.where(np.isnan(x), 0, 1 + np.searchsorted(cut, x, side="left"))
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(edges))
            yield pa.RecordBatch.from_arrays([*batch.columns[:held], pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))],
                                             [*batch.schema.names[:held], "bins"])

    kept = [F.col(c) for c in carry]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField("bins", T.ArrayType(T.FloatType()))])
    # cuts are positional, so a column may have any name
    return df.select(*kept, *[F.col(c).cast("double").alias(f"_b{k}") for k, c in enumerate(cuts)]).mapInArrow(run, schema)


#: Numbers of a partition of vectors: a booster sums one histogram a partition and level, so small tables get few.
PARTITION_CELLS = 1 << 24


def _few_partitions(data: DataFrame, width: int) -> DataFrame:
    """Rows made and written by as many tasks as there are, and read by few."""
    data = cut_lineage(data)
    return data.coalesce(max(1, -(-data.count() * max(1, width) // PARTITION_CELLS)))


def _vector(encodings: Sequence[Column]) -> Column:
    """Bins and encodings of a row as one vector."""
    own = F.col("bins").cast("array<double>")
    return array_to_vector(F.concat(own, F.array(*encodings)) if encodings else own).alias("features")


# -- boosters ------------------------------------------------------------------
def booster(params: BoostParams, rounds: int, bins: int) -> GBTClassifier:
    return GBTClassifier(labelCol="label", featuresCol="features", maxDepth=params.max_depth, stepSize=params.step_size,
                         subsamplingRate=params.subsampling_rate, featureSubsetStrategy=params.feature_subset,
                         maxBins=bins, minInstancesPerNode=params.min_instances, maxIter=rounds, seed=params.seed)


def best_round(losses: Sequence[float], patience: int, least_gain: float = 0.0) -> tuple[int, bool]:
    """(rounds up to the best loss, whether ``patience`` rounds without gain have passed).

    Rounds after those don't count; of equal losses the first is the best, and a
    loss within ``least_gain`` of the best so far is no better.
    """
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best] - least_gain:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The booster of the first ``rounds`` rounds, which a fit of so many rounds
    gives, too: a round hangs on the ones before it and on its seed only."""
    java, jvm = model._java_obj, SparkSession.active().sparkContext._jvm.org.apache.spark.ml
    trees = JavaWrapper._new_java_array(list(java.trees())[:rounds], jvm.regression.DecisionTreeRegressionModel)
    weights = JavaWrapper._new_java_array(model.treeWeights[:rounds], SparkSession.active().sparkContext._jvm.double)
    return GBTClassificationModel(jvm.classification.GBTClassificationModel(java.uid(), trees, weights))


def fit_with_patience(train: DataFrame, held_out: DataFrame, params: BoostParams) -> tuple[GBTClassificationModel, list[float]]:
    """The booster of the best round, and the held-out loss of every round fitted.

    Stages double, so all of them together cost about twice the last; a
    stage repeats the rounds of the one before it, since they have the same seed.
    The best round's booster is the beginning of the last stage's.
    """
    bins = max(2, params.max_bins + 2)
    rounds = min(params.max_iter, 4 * params.patience)
    while True:
        model = booster(params, rounds, bins).fit(train)
        losses = [float(x) for x in model.evaluateEachIteration(held_out)]
        best, over = best_round(losses, params.patience, params.least_gain)
        if over or rounds >= params.max_iter:
            break
        rounds = min(params.max_iter, 2 * rounds)
    return (first_rounds(model, best) if best < len(losses) else model), losses


def importances(model: GBTClassificationModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Per-feature importance of a fitted booster by gain; ``split_counts`` counts splits."""
    vec = model.featureImportances  # may end at the last feature in use
    return [(f, float(vec[i]) if i < vec.size else 0.0) for i, f in enumerate(features)]


def split_counts(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """(feature, importance): how many splits of a saved booster use each feature.

    Read from the table of nodes that Spark writes with the model; a feature
    without splits has 0.
    """
    nodes = spark.read.parquet(f"{path.rstrip('/')}/data")
    used = (nodes.where("nodeData.leftChild >= 0").groupBy(F.col("nodeData.split.featureIndex").alias("place"))
            .agg(F.count(F.lit(1)).alias("n")))
    names = spark.createDataFrame(list(enumerate(features)), "place int, feature string")
    return names.join(used, "place", "left").select("feature", F.coalesce("n", F.lit(0)).cast("double").alias("importance"))


def score_counts(df: DataFrame, score_col: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, _ll_s, _ll_n, _ll_p, _ll_q): rows with a score, positives and
    negatives of each score; a score that many rows share is one row."""
    y = F.col(label)
    return df.groupBy(*keys, F.col(score_col).alias("_ll_s")).agg(
        F.count(score_col).alias("_ll_n"), F.count_if(y == 1).alias("_ll_p"), F.count_if(y == 0).alias("_ll_q"))


def auc_of_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, AUC) of ``score_counts``; rows without a score have no rank, and
    count as positives and negatives."""
    n, p = F.col("_ll_n"), F.col("_ll_p")
    rank = F.col("before") + (n + F.lit(1)) / F.lit(2.0)
    a = prefix_counts(counts, keys, ["_ll_s"], "_ll_n").groupBy(*keys).agg(
        F.sum(F.when((p > 0) & (n > 0), p * rank)).alias("_rp"),
        F.sum("_ll_p").cast("double").alias("_p"), F.sum("_ll_q").cast("double").alias("_n"))
    return a.select(*keys, ((F.col("_rp") - F.col("_p") * (F.col("_p") + 1) / 2.0) /
                            (F.col("_p") * F.col("_n"))).alias("AUC"))


def auc(df: DataFrame, score_col: str, label: str) -> DataFrame:
    """ROC AUC as the normalised rank-sum of the positives (M9), one row."""
    return auc_of_counts(score_counts(df, score_col, label))


def blend_ranks(df: DataFrame, id_col: str, score_cols: Sequence[str], out: str = "TARGET",
                keep_ranks: bool = False) -> DataFrame:
    """Average rank of each score column, mean across them, min-max scaled
    to [0, 1] (M8).  Ranks use the distributed rank pass."""
    x = df
    ranks = []
    for i, s in enumerate(score_cols, 1):
        x = average_rank(x, s, f"RANK_{i}")
        ranks.append(f"RANK_{i}")
    mean = sum((F.col(r) for r in ranks), F.lit(0.0)) / F.lit(float(len(ranks)))
    x = x.withColumn("_mr", mean)
    b = x.agg(F.min("_mr").alias("_lo"), F.max("_mr").alias("_hi"))
    x = x.crossJoin(F.broadcast(b))  # one row
    scaled = F.when(F.col("_hi") > F.col("_lo"), (F.col("_mr") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))) \
        .otherwise(F.lit(0.0))
    keep = [id_col] + (ranks if keep_ranks else [])
    return x.select(*keep, scaled.alias(out))


def cross_validate(df: DataFrame, features: Sequence[str], cats: Sequence[str], label: str,
                   id_col: str, k: int = 8, seed: int = 42, smoothing: float = 5.0,
                   params: BoostParams = BoostParams(), noise_level: float = 0.0, parallelism: int = 4):
    """Stratified k-fold CV (M1, M4): returns (fold metrics, best round per
    fold, importances frame with a fold column).  A fold's metrics are its
    ``train_auc`` and ``valid_auc`` at its best round.  ``parallelism`` folds are
    fitted at a time, as jobs of one session."""
    spark = df.sparkSession
    folded = stratified_folds(df, label, id_col, k, seed)
    numeric = [f for f in features if f not in cats]
    names = numeric + [f"{c}_ENCODED" for c in cats]
    cuts = fit_cuts(df, numeric, params.max_bins, id_col)
    levels = [f"_level_{i}" for i in range(len(cats))]
    x = folded.withColumns({"label": F.col(label).cast("double"), **{own: category_key(c) for own, c in zip(levels, cats)}})
    # levels are counted and joined on narrow rows
    x = cut_lineage(binned_rows(x, cuts, [id_col, "label", "fold", *levels]))
    data, priors = encoding_arrays(x, levels, "label", "fold", k, smoothing)
    data = _few_partitions(data.drop(*levels), len(names))

    def one(f: int):
        held = F.col("fold") == f
        encodings = []
        for i in range(len(cats)):
            known = F.col(f"_enc_{i}")[f]
            noisy = known * (F.lit(1.0) + F.lit(noise_level) * hash_normal(id_col, seed)) if noise_level > 0 else known
            # noise goes on known levels of training rows only
            encodings.append(F.coalesce(F.when(held, known).otherwise(noisy), F.lit(priors[f])))
        # the fits, losses and scores of a fold read its vectors many times
        rows = cut_lineage(data.select("label", held.alias("held"), _vector(encodings)))
        model, losses = fit_with_patience(rows.where("NOT held"), rows.where("held"), params)
        rated = model.transform(rows).select(F.lit(f).alias("fold"), "held", "label", vector_to_array("probability")[1].alias("p"))
        counts = cut_lineage(score_counts(rated, "p", "label", ["fold", "held"]))
        return counts, model.getNumTrees, [(f, n, v) for n, v in importances(model, names)], losses

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(one, range(k)))
    counts = done[0][0]
    for own, *_ in done[1:]:
        counts = counts.unionByName(own)
    aucs = {(r["fold"], r["held"]): r["AUC"] for r in auc_of_counts(counts, ["fold", "held"]).collect()}  # 2k rows
    scores = [{"train_auc": aucs.get((f, False)), "valid_auc": aucs.get((f, True))} for f in range(k)]
    imp = spark.createDataFrame([r for _, _, rows, _ in done for r in rows], "fold int, feature string, importance double")
    return scores, [n for _, n, _, _ in done], imp


def loss_curve(losses: Sequence[Sequence[float]], spark: SparkSession) -> DataFrame:
    """(fold, round, loss) of the held-out losses of each fold."""
    return spark.createDataFrame([(f, r, float(x)) for f, own in enumerate(losses) for r, x in enumerate(own, 1)],
                                 "fold int, round int, loss double")


def best_rounds(curve: DataFrame, patience: int) -> DataFrame:
    """(fold, best): ``best_round`` of a curve table, in Spark.

    The stopping round is the first that lies ``patience`` rounds behind the
    best before it; the best is the first lowest loss up to there.
    """
    from pyspark.sql import Window
    so_far = Window.partitionBy("fold").orderBy("round").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    led = curve.withColumn("led", F.min(F.struct("loss", "round")).over(so_far)["round"])
    stop = led.groupBy("fold").agg(F.min(F.when(F.col("round") - F.col("led") >= patience, F.col("round"))).alias("stop"))
    return (led.join(stop, "fold").where(F.col("stop").isNull() | (F.col("round") <= F.col("stop")))
            .groupBy("fold").agg(F.min(F.struct("loss", "round"))["round"].alias("best")))


def final_round_count(best_rounds: Sequence[int], factor: float = 1.05) -> int:
    """Rounds for the full-data fit: int(mean best round x 1.05) (M5)."""
    return max(1, int(sum(best_rounds) / len(best_rounds) * factor))


def mean_importance(imp: DataFrame) -> DataFrame:
    """Mean importance per feature over folds or models."""
    return imp.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_importances(imp: DataFrame, n: int = 50) -> DataFrame:
    """Top-N by importance, ties by name."""
    return imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)


# Members, what each takes off the shares of columns and rows, their floor, and the steps in turn.
MEMBERS, SHARE_STEP, SHARE_FLOOR = 7, 0.02, 0.5
STEP_FACTORS = (0.9, 1.1, 1.0)


def ensemble_params(base: BoostParams, members: int = MEMBERS) -> list[BoostParams]:
    """The first member is ``base`` with seed 1; each later one draws from
    smaller shares, down to the floor, and turns through the step factors (M6)."""
    out = []
    for i in range(1, members + 1):
        if i == 1:
            out.append(replace(base, seed=1))
            continue
        columns, rows = (max(SHARE_FLOOR, share - SHARE_STEP * i) for share in (float(base.feature_subset), base.subsampling_rate))
        out.append(replace(base, seed=i, feature_subset=f"{columns:.2f}", subsampling_rate=round(rows, 10),
                           step_size=base.step_size * STEP_FACTORS[i % 3]))
    return out


ENSEMBLE_VERSION = 1


@dataclass
class Ensemble:
    """Boosters with the cuts and encodings that turn rows into their vectors."""

    id_col: str
    cuts: dict[str, list[float]]          # numeric features in order
    cats: list[str]
    encoders: DataFrame | None            # (feature, _cat_key, enc) of all categories, written
    prior: float
    models: list[GBTClassificationModel]

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *[f"{c}_TARGET_ENCODED" for c in self.cats]]

    def vectors(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """(id, carry, features) of rows; an unseen level gets the prior, a missing column is missing in every row."""
        x = df.select("*", *[F.lit(None).cast("double").alias(c) for c in self.cuts if c not in df.columns],
                      *[F.lit(None).cast("string").alias(c) for c in self.cats if c not in df.columns])
        if self.cats:
            x = join_levels(x, self.cats, self.encoders, "enc")
        encodings = [f"_enc_{i}" for i in range(len(self.cats))]
        rows = binned_rows(x, self.cuts, [self.id_col, *carry, *encodings])
        return rows.select(self.id_col, *carry, _vector([F.coalesce(c, F.lit(self.prior)) for c in encodings]))

    def member_scores(self, df: DataFrame) -> DataFrame:
        """(id, TRAINING_ROUND_1, ...): every member's P(default) from one pass over the rows (M7)."""
        x, out = self.vectors(df), []
        for i, model in enumerate(self.models, 1):
            own = model.copy().setPredictionCol(f"_class_{i}").setRawPredictionCol(f"_raw_{i}").setProbabilityCol(f"_p_{i}")
            x = own.transform(x)
            out.append(vector_to_array(f"_p_{i}")[1].alias(f"TRAINING_ROUND_{i}"))
        return x.select(self.id_col, *out)

    def score(self, df: DataFrame) -> DataFrame:
        """(id, TARGET): the members' ranks among the rows of ``df``, blended (M8)."""
        scored = cut_lineage(self.member_scores(df))
        return blend_ranks(scored, self.id_col, [c for c in scored.columns if c != self.id_col])

    def save(self, path: str) -> list[str]:
        """Write members, encoders and manifest below ``path``; the members' paths."""
        path, spark = path.rstrip("/"), SparkSession.active()
        paths = [f"{path}/model_round_{i}" for i in range(1, len(self.models) + 1)]
        for model, p in zip(self.models, paths):
            model.write().overwrite().save(p)
        if self.encoders is not None:
            self.encoders.write.mode("overwrite").parquet(f"{path}/encoders")
        rows = [(c, at, cut) for at, (c, own) in enumerate(self.cuts.items()) for cut in (own or [None])]
        spark.createDataFrame(rows, "feature string, place int, cut double").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/cuts")
        manifest = {"version": ENSEMBLE_VERSION, "id": self.id_col, "categories": self.cats, "prior": self.prior,
                    "members": len(self.models)}
        spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/manifest")
        return paths

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        path = path.rstrip("/")
        m = json.loads(spark.read.parquet(f"{path}/manifest").first()["manifest"])
        if m["version"] != ENSEMBLE_VERSION:
            raise ValueError(f"ensemble of version {m['version']} in {path}; this is version {ENSEMBLE_VERSION}")
        cuts: dict[str, list[float]] = {}
        # at most a hundred cuts a feature
        for r in spark.read.parquet(f"{path}/cuts").orderBy("place", "cut").collect():
            cuts.setdefault(r["feature"], []).extend([] if r["cut"] is None else [r["cut"]])
        models = [GBTClassificationModel.load(f"{path}/model_round_{i}") for i in range(1, m["members"] + 1)]
        encoders = spark.read.parquet(f"{path}/encoders") if m["categories"] else None
        return cls(m["id"], cuts, m["categories"], encoders, m["prior"], models)


def load_and_score(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """(id, TARGET) of new rows from a saved ensemble."""
    return Ensemble.load(spark, path).score(df)


def fit_ensemble(train: DataFrame, features: Sequence[str], cats: Sequence[str], label: str, id_col: str, rounds: int,
                 smoothing: float = 5.0, members: int = MEMBERS, base: BoostParams = BoostParams(),
                 parallelism: int = 4) -> Ensemble:
    """Cuts, encodings and members on all labelled rows (M5, M6); ``parallelism`` members at a time."""
    numeric = [f for f in features if f not in cats]
    cuts = fit_cuts(train, numeric, base.max_bins, id_col)
    prior = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    encoders = cut_lineage(fit_target_encodings(train, cats, label, prior, smoothing)) if cats else None
    out = Ensemble(id_col, cuts, list(cats), encoders, float(prior or 0.0), [])
    data = out.vectors(train.withColumn("label", F.col(label).cast("double")), ["label"])
    data = _few_partitions(data, len(out.features))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        out.models = list(pool.map(lambda p: booster(p, max(1, rounds), max(2, p.max_bins + 2)).fit(data),
                                   ensemble_params(base, members)))
    return out


def train_and_score(train: DataFrame, test: DataFrame, features: Sequence[str], cats: Sequence[str],
                    label: str, id_col: str, rounds: int, smoothing: float = 5.0,
                    members: int = MEMBERS, base: BoostParams = BoostParams(), parallelism: int = 4):
    """Full-data encoding, ensemble fits, rank-blended test scores (M5-M8).
    Returns (predictions[id, TARGET], importances[feature, importance], ensemble)."""
    ensemble = fit_ensemble(train, features, cats, label, id_col, rounds, smoothing, members, base, parallelism)
    rows = [(n, v) for m in ensemble.models for n, v in importances(m, ensemble.features)]
    imp = train.sparkSession.createDataFrame(rows, "feature string, importance double")
    imp = imp.groupBy("feature").agg((F.sum("importance") / F.lit(float(members))).alias("importance"))
    return ensemble.score(test), imp, ensemble
