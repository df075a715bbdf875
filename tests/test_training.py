import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from loanlens.operators.ordered import stratified_folds
from loanlens.operators.target_encoding import (apply_target_encoding, encoding_arrays, fit_target_encoding,
                                                fit_target_encodings, hash_normal)
from loanlens.plans.training import (BoostParams, Ensemble, auc, best_round, best_rounds, binned_rows, blend_ranks,
                                     cross_validate, ensemble_params, final_round_count, fit_cuts,
                                     first_rounds, fit_with_patience, importances, load_and_score, loss_curve,
                                     split_counts, top_importances, train_and_score)


def test_blend_ranks_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(200), "a": rng.integers(0, 20, 200).astype(float),
                        "b": rng.random(200)})
    got = blend_ranks(spark.createDataFrame(pdf), "id", ["a", "b"]).toPandas().sort_values("id")
    r = pdf[["a", "b"]].rank(method="average").mean(axis=1)
    exp = (r - r.min()) / (r.max() - r.min())
    assert np.allclose(got.TARGET.values, exp.values)


def test_auc_rank_sum(spark):
    pdf = pd.DataFrame({"s": [0.1, 0.4, 0.35, 0.8, 0.4], "y": [0, 0, 1, 1, 1]})
    got = auc(spark.createDataFrame(pdf), "s", "y").first().AUC
    pos, neg = pdf.s[pdf.y == 1].values, pdf.s[pdf.y == 0].values
    exp = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert abs(got - exp) < 1e-12


def test_auc_of_ties_and_rows_without_score(spark):
    """As ranks of single rows give it; a row without a score has no rank."""
    rng = random.Random(5)
    rows = [(None if i % 17 == 0 else rng.randrange(6) / 8, rng.choice([0, 1, 1, None])) for i in range(300)]
    pdf = pd.DataFrame(rows, columns=["s", "y"])
    rank, p, n = pdf.s.rank(), (pdf.y == 1).sum(), (pdf.y == 0).sum()
    df = spark.createDataFrame(rows, "s double, y int")
    assert abs(auc(df, "s", "y").first().AUC - (rank[pdf.y == 1].sum() - p * (p + 1) / 2) / (p * n)) < 1e-12
    assert auc(df.where("y = 0"), "s", "y").first().AUC is None


def test_ensemble_params_and_rounds():
    ps = ensemble_params(BoostParams(), 7)
    assert [p.seed for p in ps] == list(range(1, 8))
    assert ps[0] == BoostParams(seed=1)
    assert abs(ps[2].subsampling_rate - 0.64) < 1e-12 and abs(ps[2].step_size - 0.027) < 1e-12
    assert abs(ps[3].step_size - 0.033) < 1e-12 and ps[6].feature_subset == "0.56"
    # shares stop at the floor
    assert ensemble_params(BoostParams(), 12)[-1].feature_subset == "0.50" and ensemble_params(BoostParams(), 12)[-1].subsampling_rate == 0.5
    assert final_round_count([100, 110, 120]) == 115


def test_noise_is_reproducible_and_standard(spark):
    df = spark.range(20000)
    a = df.select(hash_normal("id", 7).alias("z")).toPandas().z
    b = df.repartition(5).select("id", hash_normal("id", 7).alias("z")).toPandas().sort_values("id").z
    assert np.allclose(a.values, b.values)
    assert abs(a.mean()) < 0.05 and abs(a.std() - 1) < 0.05


def test_top_importances_ties_by_name(spark):
    imp = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "feature string, importance double")
    assert [r.feature for r in top_importances(imp, 2).collect()] == ["c", "a"]


def test_encodings_of_all_folds_in_one_join(spark):
    rows = [(i, "abc"[i % 3] if i % 7 else None, int(i % 4 == 0), i % 3) for i in range(60)] + [(99, "lone", 1, 2)]
    df = spark.createDataFrame(rows, "id int, c string, y int, fold int")
    x, priors = encoding_arrays(df, ["c"], "y", "fold", 3, 2.0)
    got = {r.id: r._enc_0 for r in x.collect()}
    for f in range(3):
        table, prior = fit_target_encoding(df.where(F.col("fold") != f), "c", "y", 2.0)
        want = {r.id: r.e for r in apply_target_encoding(df, "c", table, prior, "e").collect()}
        assert abs(priors[f] - prior.first()[0]) < 1e-12
        assert all(abs((got[i][f] if got[i][f] is not None else priors[f]) - want[i]) < 1e-12 for i in want)
    assert got[99][2] is None


@pytest.mark.parametrize("losses,patience,want", [
    ([5, 4, 4.5, 4.4, 3, 3.5], 3, (5, False)),       # dips, recovers: the later best
    ([5, 4, 4.5, 4.4, 4.3, 3, 2], 3, (2, True)),     # three rounds without gain end it
    ([1, 1, 1, 1], 3, (1, True)), ([3, 2, 1], 2, (3, False)), ([2.0], 5, (1, False))])
def test_best_round_waits(spark, losses, patience, want):
    assert best_round(losses, patience) == want
    assert best_round([5, 4.9, 4.8, 4.7], 3, least_gain=0.5) == (1, True)
    assert best_rounds(loss_curve([losses, losses[::-1]], spark), patience).where("fold = 0").first()["best"] == want[0]


def test_patience_fits_further_stages(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.standard_normal(600) > 0).astype(float)
    df = spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, label double")
    rows = binned_rows(df, fit_cuts(df, ["a", "b", "c"], 16), ["id", "label"]).select(
        "id", "label", array_to_vector(F.col("bins").cast("array<double>")).alias("features")).cache()
    params = BoostParams(max_depth=2, step_size=0.3, min_instances=2, patience=4, max_iter=60, subsampling_rate=1.0, feature_subset="1.0")
    model, losses = fit_with_patience(rows.where("id % 3 > 0"), rows.where("id % 3 = 0"), params)
    best, over = best_round(losses, 4)
    assert model.getNumTrees == best and len(losses) > 5 and (over or len(losses) == 60)
    assert [round(v, 9) for v in model.evaluateEachIteration(rows.where("id % 3 = 0"))] == [round(v, 9) for v in losses[:best]]


def test_the_best_round_is_not_fitted_again(spark, monkeypatch):
    """The last stage holds it; the booster of its first rounds is the one that a fit of so many rounds gives."""
    from loanlens.plans import training
    df = spark.range(0, 900, 1, 2).select(((F.col("id") * 37 % 100 + F.col("id") % 7 * 9) > 80).cast("double").alias("label"), array_to_vector(
        F.array(*[F.expr(f"double(id * {m} % {n})") for m, n in ((37, 100), (1, 7), (1, 1))])).alias("features")).cache()
    params, fits = BoostParams(max_depth=2, step_size=0.3, min_instances=5, patience=3, least_gain=0.02), []
    plain = training.booster
    monkeypatch.setattr(training, "booster", lambda *a: fits.append(a[1]) or plain(*a))
    model, losses = fit_with_patience(df, df, params)
    assert fits == [12 << i for i in range(len(fits))] and model.getNumTrees < fits[-1] == len(losses)
    want = plain(params, model.getNumTrees, params.max_bins + 2).fit(df)
    tree = lambda m: m.toDebugString.split("\n", 1)[1]
    assert tree(model) == tree(want) == tree(first_rounds(want, 99))
    assert importances(model, "abc") == importances(want, "abc") and importances(model, "abc")[2] == ("c", 0.0)
    assert [r.probability for r in model.transform(df).collect()] == [r.probability for r in want.transform(df).collect()]


def test_categories_are_counted_in_one_pass_and_rows_stay(spark):
    """However many categories: one scan to count the levels, and no shuffle of the rows to join few of them."""
    cats = [f"c{i}" for i in range(6)]
    df = spark.range(0, 500, 1, 4).select("id", (F.col("id") % 4).cast("int").alias("fold"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                          *[(F.col("id") % (i + 2)).cast("string").alias(c) for i, c in enumerate(cats)])
    x, _priors = encoding_arrays(df, cats, "y", "fold", 4)
    plan = x._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 6 and "SortMergeJoin" not in plan
    table = fit_target_encodings(df, cats, "y", df.agg(F.avg("y")).first()[0], 2.0)
    assert table._jdf.queryExecution().sparkPlan().toString().count("Range ") == 1
    got = {(r.feature, r._cat_key): r.enc for r in table.collect()}
    for c in cats:
        for r in fit_target_encoding(df, c, "y", 2.0)[0].collect():
            assert got.pop((c, r._cat_key)) == r.enc
    assert not got


def test_a_category_of_many_levels_is_joined_by_a_shuffle(spark, monkeypatch):
    from loanlens.operators import target_encoding
    df = spark.createDataFrame([(i, str(i % 40), i % 2) for i in range(200)], "id int, c string, y int")
    table = fit_target_encodings(df, ["c"], "y", 0.5).localCheckpoint()
    sent = target_encoding.join_levels(df, ["c"], table, "enc")
    monkeypatch.setattr(target_encoding, "SENT_LEVELS", 39)
    moved = target_encoding.join_levels(df, ["c"], table, "enc")
    assert "BroadcastHashJoin" not in moved._jdf.queryExecution().sparkPlan().toString()
    assert sorted(sent.collect()) == sorted(moved.collect()) and moved.columns == ["id", "c", "y", "_enc_0"]


def test_bins_follow_the_cuts(spark):
    df = spark.createDataFrame([(k, None if k % 9 == 0 else float(k), 7.0, None if k else float("nan")) for k in range(300)],
                               "id int, `a.b c` double, same double, none double").toDF("id", "a b", "same", "none")
    cuts = fit_cuts(df, ["a b", "same", "none"], 10)
    assert len(cuts["a b"]) == 9 and cuts["same"] == [7.0] and cuts["none"] == []
    for r in binned_rows(df.repartition(3), cuts, ["id"]).collect():
        assert r.bins[0] == (0 if r.id % 9 == 0 else 1 + sum(c < r.id for c in cuts["a b"])) and r.bins[1:] == [1, 0]


def test_cross_validation_and_scoring_on_a_small_frame(spark, tmp_path):
    """Negative day columns with missing values; noise on training encodings only."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.4)
        rows.append((i, y if i < 300 else None, None if i % 11 == 0 else -20000.0 + 9000 * y + rng.random() * 2000,
                     "ab"[int(rng.random() < 0.3 + 0.4 * y)]))
    df = spark.createDataFrame(rows, "id long, y int, days double, cat string")
    train, test = df.where("y IS NOT NULL"), df.where("y IS NULL")
    base = BoostParams(min_instances=5, max_iter=4, max_depth=3)
    for noise in (0.0, 0.01):
        folds, rounds, imp = cross_validate(train, ["days", "cat"], ["cat"], "y", "id", k=2, params=base, noise_level=noise)
        assert len(folds) == 2 and all(f["valid_auc"] > 0.9 and f["train_auc"] > 0.9 for f in folds)
        assert all(1 <= r <= 4 for r in rounds) and imp.count() == 4
    preds, importance, ensemble = train_and_score(train, test, ["days", "cat"], ["cat"], "y", "id", 3, members=2, base=base)
    got = preds.collect()
    assert len(got) == 100 and min(r.TARGET for r in got) == 0 and max(r.TARGET for r in got) == 1
    assert len(ensemble.models) == 2 and importance.count() == 2
    # saved and loaded: the same scores, for whole tables and for one row
    path = f"file:{tmp_path}/models"
    ensemble.save(path)
    assert sorted(load_and_score(spark, path, test).collect()) == sorted(got)
    again = Ensemble.load(spark, path)
    before = {r.id: r for r in ensemble.member_scores(test).collect()}
    assert {r.id: r for r in again.member_scores(test).collect()} == before
    row, = again.member_scores(test.where("id = 321")).collect()
    assert row == before[321]
    # an unseen level has the saved prior, a missing column is a missing value
    x, = again.vectors(test.where("id = 321").withColumn("cat", F.lit("zzz"))).collect()
    assert abs(x.features[1] - train.agg(F.avg("y")).first()[0]) < 1e-12
    x, = again.vectors(test.where("id = 321").drop("days", "y")).collect()
    assert x.features[0] == 0
    # splits of the saved trees, by feature
    counts = {r.feature: r.importance for r in split_counts(spark, f"{path}/model_round_1", again.features).collect()}
    inner = sum((t.numNodes - 1) // 2 for t in again.models[0].trees)
    assert set(counts) == {"days", "cat_TARGET_ENCODED"} and sum(counts.values()) == inner > 0


def test_split_counts_of_two_trees(spark, tmp_path):
    split = "struct<id:int, leftChild:int, split:struct<featureIndex:int>>"
    nodes = [(0, (0, 1, (2,))), (0, (1, -1, (-1,))), (0, (2, 3, (0,))), (0, (3, -1, (-1,))), (0, (4, -1, (-1,))),
             (1, (0, 1, (2,))), (1, (1, -1, (-1,))), (1, (2, -1, (-1,)))]
    spark.createDataFrame(nodes, f"treeID int, nodeData {split}").write.parquet(f"{tmp_path}/m/data")
    got = {r.feature: r.importance for r in split_counts(spark, f"{tmp_path}/m", ["a", "b", "c"]).collect()}
    assert got == {"a": 1.0, "b": 0.0, "c": 2.0}


def test_folds_keep_repeated_ids(spark):
    df = spark.createDataFrame([(i % 50, i % 2) for i in range(100)], "id long, y int")
    assert stratified_folds(df, "y", "id", 5, 1).count() == 100


def test_ensemble_query_takes_its_rounds_from_cross_validation(spark, monkeypatch):
    from loanlens.plans import registry, training
    seen = {}
    frame = spark.createDataFrame([(k, k % 2 if k < 4 else None, 100.0, 50.0, "x") for k in range(6)],
                                  "SK_ID_CURR long, TARGET int, AMT_CREDIT double, AMT_GOODS_PRICE double, CODE_GENDER string")

    def cross_validate(train, *args, params, **kwargs):
        seen["train"], seen["most"], seen["patience"] = train.count(), params.max_iter, params.patience
        return [], [20, 41], None

    def train_and_score(train, test, names, cats, *args, rounds, members, **kwargs):
        seen["rounds"], seen["members"], seen["ratio"], seen["cats"] = rounds, members, "RATIO_AMT_CREDIT_TO_AMT_GOODS_PRICE" in names, cats
        return test, None, None

    monkeypatch.setattr(registry, "_domain", lambda spark, sf: {"application": frame})
    monkeypatch.setattr(training, "cross_validate", cross_validate)
    monkeypatch.setattr(training, "train_and_score", train_and_score)
    assert registry.QUERIES["m2_m8_ensemble_scores"](spark, "").count() == 2
    assert seen == {"train": 4, "most": 10_000, "patience": 5, "rounds": 32, "members": 7, "ratio": True, "cats": ["CODE_GENDER"]}
