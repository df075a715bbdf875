import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm import hard_negatives

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("uid", T.StringType()),
                        T.StructField("slot", T.StringType()), T.StructField("planes", T.StringType())])
LONG = (1 << 63) - 1


def make_vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "u", "s", "p") for i, v, l in rows], VECTORS)


def labelled_rows(seed, n=420, dim=20):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, dim)) + 0.8).astype(np.float32)
    x[50:120] = x[50]  # many copies of one vector
    # a third of all rows has one label
    labels = np.where(rng.random(n) < 0.34, 3, rng.integers(0, 10, n))
    rows = [(int(i), v.tolist(), int(l)) for i, v, l in zip(rng.permutation(n), x, labels)]
    return rows + [rows[7], (None, x[3].tolist(), 3), (None, x[3].tolist(), 4), (1000, None, 1), (1100, [None] * dim, 1),
                   (1200, x[0].tolist(), None), (1300, [float("nan")] * dim, 1), (1400, [1.0, 2.0], 5), (1401, [3.0, 1.0], 6),
                   (1402, [1.0, 1.0], 5), (1403, [0.9, 0.5], 4), (1500, [], 1), (1501, [], 2), (1502, [], 1),
                   (1600, [float("inf")] * dim, 2)]


def brute_force(rows, positives=5, negatives=10):
    good = []
    for u, (i, v, l) in enumerate(rows):
        if v is None or l is None or None in v or not np.isfinite(np.array(v, float)).all():
            continue
        l = (l + 1) % 10 if i is not None and i % 7 == 0 else l
        good.append((u, i, l, [int(np.floor(256.0 * float(np.float32(c)))) for c in v]))
    out = []
    for u, i, l, q in good:
        if i is None or i % 100:
            continue
        score = lambda c: max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(q, c))))
        scored = sorted((-score(c), j is None, j or 0, w, m) for w, j, m, c in good if w != u and len(c) == len(q))
        for s, none, j, _, m in [r for r in scored if r[4] == l][:positives]:
            fit = [r for r in scored if r[4] != l and 30 * -s <= 100 * -r[0] <= 90 * -s]
            out += [(i, None if none else j, k + 1, None if r[1] else r[2], -s, -r[0])
                    for k, r in enumerate(fit[:negatives])]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [(8192, 65536), (2, 37)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(hard_negatives, "CANDIDATE_BLOCK", blocks[1])
    rows = labelled_rows(3)
    got = hard_negatives.hard_negative_digest(make_vectors(spark, rows)).collect()
    want = brute_force(rows)
    assert len(want) > 100
    assert sorted(map(tuple, got), key=str) == want


def test_large_components(spark):
    rng = np.random.default_rng(5)
    scale = [1.0, 1e4, 1e9, 1e16, 1e30]
    rows = [(k, (abs(rng.standard_normal(6)) * scale[k % 5 if k % 100 else k // 100]).tolist(), k % 3) for k in range(500)]
    got = hard_negatives.hard_negative_digest(make_vectors(spark, rows)).collect()
    want = brute_force(rows)
    assert want and sorted(map(tuple, got), key=str) == want


def test_few_and_no_rows(spark):
    assert hard_negatives.hard_negative_digest(make_vectors(spark, [])).collect() == []
    lone = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1)]  # the first label becomes 2
    assert hard_negatives.hard_negative_digest(make_vectors(spark, lone)).collect() == []
    got = hard_negatives.hard_negative_digest(make_vectors(spark, [*lone, (2, [1.0, 1.0], 2)])).collect()
    assert [tuple(r) for r in got] == [(0, 2, 1, 1, 65536, 32768)]


def test_planes_and_tables():
    rng = np.random.default_rng(1)
    for dim, top in ((13, 300), (8, 1 << 29), (3, 1)):
        a, x = rng.integers(-top, top + 1, (5, dim)), rng.integers(-top, top + 1, (40, dim))
        n = int(hard_negatives.bits_of(x).max())
        planes = hard_negatives.pack_planes(x, n)
        assert (hard_negatives.unpack_planes(planes, dim) == x).all()
        assert (hard_negatives.SubsetTables(a, n).scores(planes) == x @ a.T).all()
    big = np.array([[10 ** 30, -7], [-(10 ** 25), 3]], object)
    planes = hard_negatives.pack_planes(big, int(hard_negatives.bits_of(big).max()))
    assert (hard_negatives.unpack_planes(planes, 2) == big).all()
    assert (hard_negatives.SubsetTables(big, planes.shape[1]).scores(planes) == big @ big.T).all()


@pytest.mark.parametrize("positive", [-7, 0, 1, 9, 100, 12345, LONG])
def test_window(positive):
    least, most = hard_negatives.score_window(positive, 30, 90)
    fits = lambda s: 30 * positive <= 100 * s <= 90 * positive
    assert not fits(least - 1) and not fits(most + 1)
    assert (fits(least) and fits(most)) or least > most


def test_sql_has_the_same_rows(spark, tmp_path):
    import duckdb
    rows = [r for r in labelled_rows(9)[:420] if r[0] is not None]
    path = f"{tmp_path}/embeddings"
    make_vectors(spark, rows).select("vec_id", "embedding", F.col("label")).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    got = con.execute(hard_negatives.ORACLE_SQL).fetchall()
    assert sorted(got, key=str) == brute_force(rows)
