import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import mixing, topk_search
from tests.llm.conftest import make_documents, words
from tests.llm.test_dedup import make_vectors, vector_rows


def brute_top(rows, k=5):
    good = []
    for i, v in rows:
        if v is not None and None not in v and np.isfinite(v).all():
            good.append((i, [int(np.floor(256.0 * np.float64(x))) for x in np.array(v, np.float32)]))
    out = []
    for a, (i, q) in enumerate(good):
        if i is None or i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, c)), j is None, j or 0) for b, (j, c) in enumerate(good)
                        if b != a and len(c) == len(q))
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(16 << 20, 1 << 18, 1 << 12), (600, 64, 16), (1, 1 << 18, 50)])
def test_top_k_matches_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK_BYTES", "STRIP_ROWS", "LEAST_STRIP"), sizes):
        monkeypatch.setattr(topk_search, name, size)
    rows = vector_rows(2)
    rows += [(50, rows[0][1]), (100, [1e12] * 24), (150, [1.0]), (200, [])]
    got = topk_search.top_k_digest(make_vectors(spark, rows)).collect()
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=str) == brute_top(rows)


def test_top_k_of_few_rows(spark):
    assert topk_search.top_k_digest(make_vectors(spark, [])).collect() == []
    got = topk_search.top_k_digest(make_vectors(spark, [(0, [1.0, 0.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 2, 65536), (0, 2, 3, 65536)]


def test_bounds_hold():
    rng = np.random.default_rng(0)
    q, x = rng.integers(-300, 300, (20, 37)).astype(float), rng.integers(-300, 300, (50, 37)).astype(float)
    exact = q @ x.T
    last = None
    for ql, xl in zip(topk_search.segment_levels(q), topk_search.segment_levels(x)):
        bound = ql @ xl.T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.mean() <= last
        last = bound.mean()


def mixed_texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(words(rng, rng.randrange(80))) for _ in range(n)]


def test_mix_matches_the_sql(spark, monkeypatch, tmp_path):
    docs = make_documents(spark, mixed_texts(1, 300) + [None, "", "tail \t\n"])
    path = f"{tmp_path}/documents"
    docs.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(tuple(r) for r in con.execute(mixing.ORACLE_SQL).fetchall())
    for slot_rows in (20_000, 10):
        monkeypatch.setattr(mixing, "SLOT_ROWS", slot_rows)
        got = sorted(tuple(r) for r in mixing.mixing_digest(spark, docs).collect())
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-6 and g[4] == w[4]


def test_slots_stay_small_for_unlike_weights_and_equal_ids(spark, monkeypatch):
    # ten words each: most in another script, many without an id
    texts = [" ".join(["word" if k % 4 == 0 else "\u4f60\u597d\u4f60\u597d"] * 10) for k in range(800)]
    ids = [None if k % 3 == 0 else k for k in range(800)]
    docs = make_documents(spark, texts, ids).withColumn("source", F.lit("one"))
    monkeypatch.setattr(mixing, "SLOT_ROWS", 40)
    bases = []
    write = mixing.Workspace.write

    def kept(self, df, table):
        out = write(self, df, table)
        if table == "slots":
            bases.extend(sorted(r.base for r in out.collect()))
        return out

    monkeypatch.setattr(mixing.Workspace, "write", kept)
    rows = mixing.mix_documents(docs, ["doc_id"]).collect()
    assert len(rows) == 800 and sum(r.copies for r in rows) == 1200
    assert max(b - a for a, b in zip(bases, [*bases[1:], 8000])) <= 10 * 3 * 40


def brute_targets(sizes, weights, total):
    target, open_ = {}, set(sizes)
    left = total
    while open_:
        share = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / share >= 2 * sizes[s]}
        if not full:
            return target | {s: left * weights[s] / share for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_are_filled_and_shared_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 40, "d": 0, None: 500}
    order = ["a", "b", "c", "d", None]
    rows = [(s, n, 1, 1.0) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(rows, "source string, source_size long, n_docs long, mean_weight double")).collect()}
    want = brute_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    assert {s: round(t, 6) for s, t in got.items()} == {s: round(t, 6) for s, t in want.items()}


def test_mix_comes_near_its_targets(spark, odd_documents, no_documents):
    docs = make_documents(spark, mixed_texts(4, 900))
    rows = mixing.mix_documents(docs, ["doc_id", "source"]).collect()
    by = {}
    for r in rows:
        assert r.copies * r.size <= 2 * r.size
        entry = by.setdefault(r.source, [0, r.target])
        entry[0] += r.copies * r.size
    assert all(abs(taken - target) <= 80 for taken, target in by.values())
    again = mixing.mix_documents(docs.repartition(5), ["doc_id", "source"]).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    odd = mixing.mixing_digest(None, odd_documents).collect()
    assert len(odd) == odd_documents.count() and all(r.taken <= 2 * r.size for r in odd)
    assert mixing.mixing_digest(None, no_documents).collect() == []


def test_other_scripts_are_drawn_alike(spark):
    rng = random.Random(31)
    scripts = [(0x61, 26), (0x4E00, 2000), (0x430, 32), (0x627, 20), (0x915, 30)]
    texts = [" ".join("".join(chr(scripts[k % 5][0] + rng.randrange(scripts[k % 5][1])) for _ in range(6)) for _ in range(10))
             for k in range(2000)]
    docs = make_documents(spark, texts).withColumn("source", F.lit("one"))
    rows = mixing.mix_documents(docs, ["doc_id"]).collect()
    twice = [0] * 5
    for r in rows:
        twice[r.doc_id % 5] += r.copies == 2
    # half of the documents are taken twice, of each script
    assert sum(twice) == 1000 and max(twice) - min(twice) < 80
    odd = spark.createDataFrame([("12 34 !!",), ("ab cd",), ("你好 你",), ("",), (None,)], "text string")
    assert [r[0] for r in odd.select(mixing.quality_weight("text")).collect()] == [1 / 7, 1.0, 1.0, 1.0, 1.0]
