import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanlens.operators import sparse
from loanlens.operators.encoders import fit_categories, one_hot
from loanlens.operators.sparse import SparseDummies

ROWS = [(1, "b", 2, True), (2, "a", None, False), (3, None, 10, None), (4, "b", 2, True), (5, "a b", 10, False)]
COLUMNS = "id int, s string, n int, t boolean"


@pytest.mark.parametrize("sent", [500_000, 1])
def test_same_as_one_hot_columns(spark, monkeypatch, tmp_path, sent):
    monkeypatch.setattr(sparse, "SENT_VALUES", sent)
    df = spark.createDataFrame(ROWS, COLUMNS)
    SparseDummies.fit(df, ["s", "n", "t"]).save(f"file:{tmp_path}/d")
    fitted = SparseDummies.load(spark, f"file:{tmp_path}/d")
    names = [r.name for r in fitted.names().orderBy("place").collect()]
    want = {r.id: r.asDict() for r in one_hot(df, fit_categories(df, ["s", "n", "t"])).collect()}
    for r in fitted.transform(df).select("id", vector_to_array("dummies").alias("v")).collect():
        own = {k.replace("True", "true").replace("False", "false"): v for k, v in want[r.id].items() if k != "id"}
        assert dict(zip(names, r.v)) == own


def test_unseen_values_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    fitted = SparseDummies.fit(df, ["s", "n"])
    new = spark.createDataFrame([(9, "zzz", 2, "x"), (8, "a", 77, "y")], "id int, s string, n int, s__place string")
    got = {r.id: r for r in fitted.transform(new).select("id", "s", vector_to_array("dummies").alias("v")).collect()}
    assert sum(got[9].v) == 1 and sum(got[8].v) == 1 and got[9].s == "zzz" and len(got[9].v) == 5
    none = SparseDummies.fit(df.where(F.lit(False)), ["s", "n"])
    assert none.width == 0 and [len(r.v) for r in none.transform(df).select(vector_to_array("dummies").alias("v")).collect()] == [0] * 5
    assert fitted.transform(df.where(F.lit(False))).count() == 0


def test_a_column_of_many_values_trains(spark):
    df = spark.range(120_000).select(
        "id", (F.col("id") % 100_000).cast("string").alias("many"), (F.col("id") % 3).cast("string").alias("few"),
        (F.col("id") % 3 == 0).cast("double").alias("label"))
    fitted = SparseDummies.fit(df, ["many", "few"])
    assert fitted.width == 100_003
    model = LogisticRegression(maxIter=3, regParam=0.01, featuresCol="dummies").fit(fitted.transform(df))
    assert model.numFeatures == 100_003
