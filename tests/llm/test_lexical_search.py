import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from loanlens.llm import lexical_search
from tests.llm.conftest import make_documents, words

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("uid", T.StringType()), T.StructField("terms", T.StringType())])
TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def make_items(spark, rows):
    return spark.createDataFrame([(i, t, "u", "t") for i, t in rows], ITEMS)


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(TERM, lower)


def brute_force(documents, items, k=20):
    docs = [(u, i, Counter(terms(t)), len(terms(t))) for u, (i, t) in enumerate(documents)]
    docs = [d for d in docs if d[3]]
    big_n, big_l = len(docs), sum(d[3] for d in docs)
    df = Counter(t for d in docs for t in d[2])
    out = []
    for item_id, text in items:
        scored = []
        for u, i, tf, n in docs:
            m = 75 + 25 * n * big_n // big_l
            score = 0
            for t, times in Counter(terms(text)).items():
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, u))
        out += [(item_id, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(odd_texts):
    rng = random.Random(12)
    texts = [t if t is None or len(t) < 50000 else t[:40000] for t in odd_texts]
    texts += [" ".join(words(rng, rng.randrange(1, 90), 60)) for _ in range(250)]
    # a third of all documents is one text
    texts += [texts[-1]] * 120 + ["É é ÉÉ 你好 x-y_z", "   Αα", "same same SAME"]
    documents = list(zip(range(len(texts)), texts))
    rng.shuffle(documents)
    documents += [(None, "w1a alone"), (documents[0][0], documents[0][1])]
    items = [(k, texts[30 + 7 * k] + " extra") for k in range(20)]
    items += [(3, "w1a w1a W1A w2ee"), (None, "é 你好 same"), (50, None), (51, ""), (52, "... -- !"), (53, "nowhere"),
              (54, " ".join(t for t in texts if t)), (3, "w1a w1a W1A w2ee")]
    return documents, items


@pytest.mark.parametrize("limits", [(8192, 1 << 21, 1_000_000, 1 << 15, 1 << 22), (16, 300, 100, 64, 200)])
def test_against_brute_force(spark, monkeypatch, odd_texts, limits):
    for name, value in zip(("BLOCK_DOCUMENTS", "BLOCK_POINTS", "SENT_TERMS", "BATCH_CELLS", "KEPT_CELLS"), limits):
        monkeypatch.setattr(lexical_search, name, value)
    documents, items = corpus(odd_texts)
    docs = make_documents(spark, [t for _, t in documents], [i for i, _ in documents])
    got = lexical_search.rank_documents(docs, make_items(spark, items)).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(documents, items)


def test_empty_tables(spark, no_documents):
    one = make_items(spark, [(1, "a b")])
    assert lexical_search.rank_documents(no_documents, one).collect() == []
    docs = make_documents(spark, ["a b", None, "", "?"])
    assert lexical_search.rank_documents(docs, make_items(spark, [])).collect() == []
    assert lexical_search.rank_documents(docs, make_items(spark, [(1, "c"), (2, None)])).collect() == []


def test_sql_has_the_same_rows(spark, tmp_path, odd_texts):
    documents, items = corpus(odd_texts)
    documents = [d for d in documents if d[0] is not None]
    make_documents(spark, [t for _, t in documents], [i for i, _ in documents]).write.parquet(f"{tmp_path}/documents")
    make_items(spark, items).write.parquet(f"{tmp_path}/benchmark")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    got = con.execute(lexical_search.ORACLE_SQL).fetchall()
    assert sorted(got, key=str) == brute_force(documents, items)


@pytest.mark.parametrize("side,points", [(1, 1), (5, 9), (64, 700), (200, 3000)])
def test_tree_holds_the_maxima_of_its_cells(side, points):
    rng = np.random.default_rng(side)
    cells = np.unique(rng.integers(0, side, (points, 2)), axis=0)
    rows, columns, values = cells[:, 0], cells[:, 1], rng.integers(1, 10 ** 9, len(cells))
    tree = lexical_search.Treap.unpacked(*lexical_search.Treap.build(rows, columns, values, side).packed())
    grid = {}
    for r, c, v in zip(rows.tolist(), columns.tolist(), values.tolist()):
        for shift in range(tree.height + 1):
            key = (shift, r >> shift, c >> shift)
            grid[key] = max(grid.get(key, 0), v)
    assert tree.maxima[0] == grid[tree.height, 0, 0] and sum(tree.sizes) == len(grid)
    for r, c in rng.integers(0, side, (200, 2)).tolist():
        cell = np.zeros(1, np.int32)
        for shift in reversed(range(tree.height)):
            cell = tree.children(cell, np.array([2 * ((r >> shift) & 1) + ((c >> shift) & 1)]))
            assert tree.maxima[cell[0]] == grid.get((shift, r >> shift, c >> shift), 0)


def test_terms_of_long_texts(monkeypatch):
    rng = random.Random(8)
    text = " ".join(words(rng, 3000)) + " é" * 50 + "x" * 1000
    monkeypatch.setattr(lexical_search, "CHUNK", 64)
    assert [t.decode() for block in lexical_search.terms_of(text) for t in block] == terms(text)
