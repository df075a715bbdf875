import random

import pytest

from loanlens.plans import profile
from loanlens.plans.profile import similar_for_probes


@pytest.mark.parametrize("tolerances", [{"a": 3.0, "b": 0.5}, {"a": 1.5, "b": 0.0}])
def test_against_all_pairs(spark, tolerances):
    rng = random.Random(6)
    rows = [(k, rng.choice([None, float("nan"), float("inf"), 1e290, -0.0, *[round(rng.uniform(-20, 20), 2) for _ in range(12)]]),
             float(rng.randrange(4))) for k in range(300)]
    rows += [(1000 + k, 5.0, 1.0) for k in range(150)]  # a third of all rows in one cell
    probes = [r for r in rows if r[0] % 7 == 0] + [(None, 5.0, 1.0), (-1, 4.0, 2.0)]
    schema = "id long, a double, b double"
    df, asked = spark.createDataFrame(rows, schema), spark.createDataFrame(probes, schema)
    got = sorted(tuple(r) for r in similar_for_probes(df, asked, tolerances, "a", "id", 4).collect())
    fine = lambda x: x is not None and abs(x) < 1e300
    want = []
    for p, pa, pb in probes:
        if p is None or not fine(pa):
            continue
        near = sorted((abs(a - pa), i) for i, a, b in rows if i != p and fine(a) and abs(a - pa) <= tolerances["a"]
                      and abs(b - pb) <= tolerances["b"])
        want += [(p, r + 1, i) for r, (_, i) in enumerate(near[:4])]
    assert got == sorted(want) and len(got) > 50
    assert similar_for_probes(df.limit(0), asked, tolerances, "a", "id").collect() == []
    assert similar_for_probes(df, asked.limit(0), tolerances, "a", "id").collect() == []


def test_probes_of_a_crowded_band_meet_few_rows(spark, monkeypatch):
    """1,500 rows in one cell, some of them alike and some ids twice: a probe meets 40 at most, or wider cells where these hold too few."""
    monkeypatch.setattr(profile, "MOST_MET", 40)
    rng = random.Random(3)
    rows = [(k % 1400, rng.uniform(0, 9), float(k % 50 == 0)) for k in range(1500)]
    rows += [(2000 + k // 3, 4.5, 0.0) for k in range(90)] + [(5000 + k, -700.0, 1.0) for k in range(3)]
    probes = [r for r in rows if r[0] % 20 == 0]
    schema = "id long, a double, b double"
    df, asked = spark.createDataFrame(rows, schema), spark.createDataFrame(probes, schema)
    got = sorted(tuple(r) for r in similar_for_probes(df, asked, {"a": 10.0, "b": 0.0}, "a", "id", 4).collect())
    want = []
    for p, pa, pb in probes:
        near = sorted((abs(a - pa), i) for i, a, b in rows if i != p and abs(a - pa) <= 10 and b == pb)
        want += [(p, r + 1, i) for r, (_, i) in enumerate(near[:4])]
    assert got == sorted(want)
    x = df.selectExpr("id AS _id", "a AS _x0", "b AS _x1")
    p = asked.selectExpr("id AS probe_id", "monotonically_increasing_id() AS _probe", "a AS _p0", "b AS _p1")
    levels = profile.probe_levels(x, p, [10.0, 0.0], 0)
    for level, own in enumerate(levels[:-1]):
        widths = profile._halved([10.0, 0.0], 0, level)
        met = profile._asking_cells(own, widths).join(profile._in_cells(x, widths), ["_c0", "_c1"]).groupBy("_probe").count()
        assert all(r["count"] <= 40 for r in met.collect())
    assert len(levels) > 3 and sum(own.count() for own in levels) == len(probes)
