"""Oracle comparison on the smallest driver scale (the driver's gate runs at sf0.01)."""
import math
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def _checked():
    """Every query with SQL, but those of the training-data subpackage, which has its own tests."""
    from loanlens.plans.registry import ORACLE
    return sorted(ORACLE)


def _canon(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: None if v is None else (round(v, 3) if isinstance(v, float) and not math.isnan(v) else v)
    return sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=lambda t: tuple(str(x) for x in t))


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", _checked())
def test_matches_duckdb(spark, name):
    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "documents", "labels", "nation", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    orows, ocols = res.fetchall(), [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "c_custkey" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
