import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.plans.features import combine_applications, split_train_test
from loanlens.sources import read_features, read_table, write_features, write_importances, write_predictions
from loanlens.sources.schemas import BUREAU_BALANCE


def test_sources_and_sinks_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="loanlens-test-io-")
    csv = os.path.join(out, "bb.csv")
    with open(csv, "w") as f:
        f.write("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n5,-1,C\n5,-2,X\n6,oops,0\n")
    bb = read_table(spark, csv, BUREAU_BALANCE, with_row_position=True)
    rows = bb.orderBy("_row_pos").collect()
    assert [r.STATUS for r in rows] == ["C", "X", "0"] and rows[2].MONTHS_BALANCE is None  # coerced
    train = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.1)], "SK_ID_CURR long, TARGET int, f double")
    test = spark.createDataFrame([(3, 0.7)], "SK_ID_CURR long, f double")
    tr, te = split_train_test(combine_applications(train, test))
    write_features(tr, te, out)
    tr2, te2 = read_features(spark, out)
    assert tr2.count() == 2 and te2.count() == 1 and te2.first().TARGET is None
    p = write_predictions(te2.select("SK_ID_CURR", F.col("f").alias("TARGET")), out, "v1")
    back = spark.read.option("header", True).csv(p)
    assert back.columns == ["SK_ID_CURR", "TARGET"] and back.count() == 1
    imp = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "feature string, importance double")
    write_importances(imp, os.path.join(out, "imp"))
    lines = [r.value for r in spark.read.text(os.path.join(out, "imp")).collect()]
    assert lines == ["b: 3.000000", "a: 1.000000"]


def test_row_position_follows_the_files(spark, tmp_path):
    """Two files of different size: the position orders by file, then by row."""
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "part-00000.csv").write_text("k\n0\n")
    (folder / "part-00001.csv").write_text("k\n" + "\n".join(str(i) for i in range(1, 5000)) + "\n")
    df = read_table(spark, str(folder), fmt="csv", with_row_position=True)
    assert [int(r.k) for r in df.orderBy("_row_pos").collect()] == list(range(5000))


def test_missing_strings_of_csv_are_null(spark, tmp_path):
    folder = tmp_path / "na"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v,s\n1,NaN,NA\n2,1.5,x\n3,,null\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType())])
    rows = read_table(spark, str(folder), schema, fmt="csv").orderBy("k").collect()
    assert [(r.v, r.s) for r in rows] == [(None, None), (1.5, "x"), (None, None)]


def test_importances_are_plain_numbers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1234.5), ("b", 2.0)], "feature string, importance double")
    write_importances(df, str(tmp_path / "imp"))
    assert [r.value for r in spark.read.text(str(tmp_path / "imp")).collect()] == ["a: 1234.500000", "b: 2.000000"]


def test_malformed_rows_and_values_are_quarantined(spark, tmp_path):
    from loanlens.sources.io import read_checked, reject_counts
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "a.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n2,-2\n3,oops,X\n4,-4,C,extra\n5,NA,0\n6,,\n")
    (folder / "b.csv").write_text('SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n7,-7,"a, b"\nx,1.5,C\n')
    rows, rejects = read_checked(spark, str(folder), BUREAU_BALANCE, with_row_position=True)
    got = [(r.SK_ID_BUREAU, r.MONTHS_BALANCE, r.STATUS) for r in rows.orderBy("_row_pos").collect()]
    assert got == [(1, -1, "C"), (3, None, "X"), (5, None, "0"), (6, None, None), (7, -7, "a, b"), (None, None, "C")]
    found = {(r.file.rsplit("/", 1)[1], r.reason, r.column, r.value) for r in rejects.collect()}
    assert found == {("a.csv", "row", None, "2,-2"), ("a.csv", "row", None, "4,-4,C,extra"), ("a.csv", "type", "MONTHS_BALANCE", "oops"),
                     ("b.csv", "type", "SK_ID_BUREAU", "x"), ("b.csv", "type", "MONTHS_BALANCE", "1.5")}
    # good rows and row rejects are all rows of the files
    assert rows.count() + rejects.where("reason = 'row'").count() == 8
    table = read_table(spark, str(folder), BUREAU_BALANCE, fmt="csv", quarantine=str(tmp_path / "q"))
    assert table.count() == 6
    counts = {(r.reason, r["column"]): r.n for r in reject_counts(spark.read.parquet(str(tmp_path / "q"))).collect()}
    assert counts == {("row", None): 2, ("type", "MONTHS_BALANCE"): 2, ("type", "SK_ID_BUREAU"): 1}
    # without it: as before
    assert read_table(spark, str(folder), BUREAU_BALANCE, fmt="csv").count() == 8


def test_quarantine_of_clean_and_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n")
    (tmp_path / "c.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n")
    for name, n in (("e", 0), ("c", 1)):
        assert read_table(spark, str(tmp_path / f"{name}.csv"), BUREAU_BALANCE, quarantine=str(tmp_path / f"q{name}")).count() == n
        assert spark.read.parquet(str(tmp_path / f"q{name}")).count() == 0
