import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from loanlens.llm import lattice_dedup, line_align, minhash_dedup
from loanlens.llm.components import connected_components
from tests.llm.conftest import make_documents, words


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(200, 300)] + [(7, 7), (299, 5), (5, 299)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in want.items() if n in got}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_near(texts):
    sets = [shingles(t) for t in texts]
    links = []
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                links.append((b, a))
    return sets, components(range(len(sets)), links)


def near_texts(seed):
    """Copies, chains of edits whose ends don't link, a crowd around one text, and singles."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        text = words(rng, rng.randrange(20, 120))
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(text))
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(9999)}"
    crowd = words(rng, 100)
    for _ in range(120):
        own = list(crowd)
        for _ in range(rng.randrange(0, 6)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(9999)}"
        texts.append(" ".join(own))
    texts += [" ".join(words(rng, rng.randrange(0, 9))) for _ in range(30)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,small", [(1, 32), (2, 4)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, seed, small):
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    texts = near_texts(seed)
    sets, want = brute_near(texts)
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(make_documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for k in range(len(texts)):
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (len(sets[k]), want[k], want[k] == k)


def test_blocks_of_a_large_bucket_find_links(spark, monkeypatch):
    # small limits leave much to the last round
    monkeypatch.setattr(minhash_dedup, "SMALL", 2)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    texts = near_texts(3)
    _, want = brute_near(texts)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(make_documents(spark, texts)).collect()}
    assert got == want


def test_near_duplicates_of_odd_rows(odd_documents):
    got = minhash_dedup.near_duplicates(odd_documents, ["doc_id", "text", "uid", "n"]).collect()
    assert len(got) == odd_documents.count()
    by_text = {}
    for r in got:
        by_text.setdefault(r.text, []).append(r)
    assert all(r.kept and r.component_id == r.doc_id for t in (None, "", " ") for r in by_text[t])
    copies = [r for r in got if r.text and r.text.lower().startswith("w") and r.n_shingles == 56]
    assert {r.component_id for r in copies} == {7} and sum(r.first for r in copies) == 1
    assert {r.uid for r in got} == {"u"}


def test_near_duplicates_of_an_empty_table(no_documents):
    assert minhash_dedup.near_duplicates(no_documents).collect() == []


def test_posterior_bounds_miss_little():
    for n, least in minhash_dedup.least_matches():
        rng = np.random.default_rng(0)
        matches = rng.binomial(n, 0.75, 200000)
        assert (matches < least).mean() < 1e-3


def test_lines_and_words_follow_python():
    import pyarrow as pa
    texts = ["a b c\n\nd e\n", "", None, "x", "word at end\nx y", "continues here\n\n\n  \nlast line ", "", "", "tail\x0c\r\nq"]
    for text, (h, w) in zip(texts, line_align.document_lines(pa.array(texts))):
        lines = (text or "").split("\n")
        assert w.tolist() == [len(x.split()) for x in lines]
        assert [bool(x) for x in h] == [bool(x.strip()) for x in lines]


def test_patience_aligns_equal_lines_in_order():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        pairs = line_align.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert line_align.patience([1, 2, 3, 4], [1, 9, 3, 4]) == [(0, 0), (2, 2), (3, 3)]


def test_moved_passages_are_cut():
    # a passage behind short lines that align: 1 is the passage, 2 and 3 are short and shared
    assert line_align.common_blocks([1, 2, 4, 3, 5], [2, 6, 3, 7, 1], [3, 12, 3, 12, 60]) == {4}
    assert line_align.common_blocks([1, 2], [2, 1], [3, 60]) == {1}
    rng = random.Random(5)
    for _ in range(500):
        size = [rng.randrange(1, 7) for _ in range(9)]
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(16))] for _ in range(2))
        # every run of ten words or more that both have, by brute force
        runs = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + 1, len(a) + 1) if sum(size[x] for x in a[i:j]) >= 10}
        want = {x for i in range(len(b)) for j in range(i + 1, len(b) + 1) if tuple(b[i:j]) in runs for x in range(i, j)}
        assert line_align.shared_runs(a, b, [size[x] for x in b]) == want
        gone = line_align.common_blocks(a, b, [size[x] for x in b])
        assert want <= gone
        left = [x for k, x in enumerate(b) if k not in gone]
        assert not line_align.shared_runs(a, left, [size[x] for x in left])


def passage(rng, n):
    return " ".join(words(rng, n, 5000))


def test_line_dedup_keeps_first_and_deletes_later_blocks(spark):
    rng = random.Random(6)
    own = [[passage(rng, 12) for _ in range(4)] for _ in range(30)]
    shared, swapped = passage(rng, 55), passage(rng, 20)
    short = ["short a b", "c d e f", "g h i j"]  # together ten words and more
    lone = "All rights reserved"
    texts = []
    for k, lines in enumerate(own):
        lines = list(lines)
        if k % 3 == 0:
            lines.insert(1, shared)
        if k % 5 == 0:
            lines = ([swapped] if k % 2 else []) + lines + ([] if k % 2 else [swapped])
        if k % 7 == 0:
            lines[2:2] = short
        texts.append("\n".join([lone, *lines]))
    texts.append(texts[4])
    got = {r.doc_id: r for r in line_align.line_dedup_digest(make_documents(spark, texts)).collect()}
    everything = "\n".join(r.text for r in got.values())
    for line in {x for t in texts for x in t.split("\n")}:
        assert line in everything
    assert everything.count(shared) == 1 and everything.count(swapped) == 1 and everything.count("\n".join(short)) == 1
    assert got[0].text == texts[0] and got[30].text == ""
    # a short common line alone is no block
    assert all(r.text.startswith(lone) for k, r in got.items() if k < 30 and k % 5)
    for k in range(30):
        assert all(x in got[k].text for x in own[k])


def test_line_dedup_of_a_passage_in_all_documents(spark):
    rng = random.Random(8)
    for n in (3, 40):
        shared = passage(rng, 60)
        texts = ["\n".join([passage(rng, 12), shared, passage(rng, 12)]) for _ in range(n)]
        got = {r.doc_id: r for r in line_align.line_dedup_digest(make_documents(spark, texts)).collect()}
        assert got[0].text == texts[0]
        assert all(got[k].text == texts[k].replace(shared + "\n", "") for k in range(1, n))


def test_line_dedup_of_unspaced_scripts(spark):
    rng = random.Random(9)
    share, yes = "Share this page with your friends", "Yes."
    chinese = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(24))
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(30))
    texts = []
    for k in range(70):
        lines = [yes, passage(rng, 12), share, passage(rng, 12), share]
        lines += [passage(rng, 12), chinese, passage(rng, 12), thai] if k % 10 == 0 else []
        texts.append("\n".join(lines))
    got = {r.doc_id: r for r in line_align.line_dedup_digest(make_documents(spark, texts)).collect()}
    assert got[0].text == texts[0]
    for k in range(1, 70):
        # short lines between others make no block, however many documents have them
        want = [x for x in texts[k].split("\n") if x not in (chinese, thai)]
        assert got[k].text.split("\n") == want and got[k].n_removed == 2 * (k % 10 == 0)


def template_texts(seed, n):
    """Documents of a few lines, many of them from a small stock."""
    rng = random.Random(seed)
    stock = [passage(rng, rng.randrange(1, 9)) for _ in range(25)]
    long = [passage(rng, 14) for _ in range(12)]
    texts = []
    for _ in range(n):
        lines = []
        for _ in range(rng.randrange(1, 9)):
            lines += rng.choice([[passage(rng, rng.randrange(1, 15))], [rng.choice(stock)], [rng.choice(long)],
                                 stock[(at := rng.randrange(22)):at + 3]])
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("limits", [(100_000, 256), (5, 3)])
def test_no_block_is_left_in_any_pair(spark, monkeypatch, limits):
    monkeypatch.setattr(line_align, "HOT_UNITS", limits[0])
    monkeypatch.setattr(line_align, "LEAD_GROUP", limits[1])
    texts = template_texts(14, 200)
    got = {r.doc_id: r for r in line_align.line_dedup_digest(make_documents(spark, texts)).collect()}
    split = [t.split("\n") for t in texts]
    size = {x: len(x.split()) for lines in split for x in lines}
    earlier: set = set()
    for k, lines in enumerate(split):
        rest, left = got[k].text.split("\n") if got[k].text else [], []
        for x in lines:
            if rest and rest[0] == x:
                left.append(rest.pop(0))
            else:
                left.append(None)
        assert not rest
        # no run of ten words that stayed stands in an earlier document; the first holder lost nothing
        runs = {tuple(lines[i:j]) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)
                if sum(size[x] for x in lines[i:j]) >= 10}
        stayed = {tuple(left[i:j]) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)}
        assert not runs & stayed & earlier
        if not runs & earlier:
            assert got[k].text == texts[k]
        earlier |= runs


def test_larger_tables_cut_the_same_lines(spark):
    texts = template_texts(15, 60)
    rng = random.Random(16)
    more = texts + ["\n".join([passage(rng, 12), rng.choice(texts).split("\n")[0].split(" ")[0], passage(rng, 9)])
                    for _ in range(5940)]
    few = {r.doc_id: r.text for r in line_align.line_dedup_digest(make_documents(spark, texts)).collect()}
    many = {r.doc_id: r.text for r in line_align.line_dedup_digest(make_documents(spark, more)).collect()}
    assert all(many[k] == few[k] for k in few) and any(few[k] != texts[k] for k in few)


def test_lines_of_long_texts(monkeypatch):
    import pyarrow as pa
    rng = random.Random(17)
    texts = ["\n".join(" " * rng.randrange(3) + " ".join(words(rng, rng.choice([0, 1, 5, 60]))) for _ in range(40)) + "\n" * k
             for k in range(3)] + ["\u4f60\u597d" * 100 + " x\n" + " " * 200 + "\n" + "y" * 300, " " * 400, "\n" * 300]
    whole = [(h.tolist(), w.tolist()) for h, w in line_align.document_lines(pa.array(texts))]
    monkeypatch.setattr(line_align, "CHUNK", 50)
    for text, want in zip(texts, whole):
        (h, w), = line_align.document_lines(pa.array([text]))
        assert (h.tolist(), w.tolist()) == want


def test_line_dedup_of_odd_rows(odd_documents, no_documents):
    got = line_align.dedup_lines(odd_documents).collect()
    assert len(got) == odd_documents.count() and got[0].asDict().keys() >= {"uid", "row", "n", "size", "n_removed"}
    texts = sorted((r.text is not None, r.text or "", r.n_removed) for r in got)
    want = [r.text for r in odd_documents.collect()]
    base = want[7]
    assert sum(t == base for _, t, _ in texts) == 1 and sum(n for _, _, n in texts) == 1
    assert sum(r.text is None for r in got) == 1
    assert line_align.dedup_lines(no_documents).collect() == []


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("uid", T.StringType()),
                        T.StructField("cell", T.StringType())])


def make_vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "u", "c") for i, v in rows], VECTORS)


def vector_rows(seed, n=300, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim)).astype(np.float32)
    crowd = base[0] + 0.06 * rng.standard_normal((80, dim)).astype(np.float32)
    pairs = base[100:140] + 0.15 * rng.standard_normal((40, dim)).astype(np.float32)
    every = np.concatenate([base, crowd, pairs, base[50:60], 2 * base[60:65]]).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in enumerate(every[rng.permutation(len(every))])]
    return rows + [(9000, None), (9001, [0.0] * dim), (9002, [float("nan")] * dim), (9003, [None, *[1.0] * (dim - 1)]),
                   (9004, []), (9005, [1.0, 2.0]), (9006, [2.0, 4.0]), (9007, [float("inf")] * dim), (None, rows_value(every))]


def rows_value(every):
    return (every[0] * 3).tolist()


@pytest.mark.parametrize("block", [512, 16])
def test_lattice_links_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice_dedup, "CELL_BLOCK", block)
    rows = vector_rows(1)
    got = lattice_dedup.near_duplicate_vectors(make_vectors(spark, rows)).collect()
    assert len(got) == len(rows)
    usable = [(k, i, np.array(v)) for k, (i, v) in enumerate(rows)
              if v and None not in v and np.isfinite(v).all() and any(v)]
    want = {k: 0 for k in range(len(rows))}
    pairs = 0
    for a, (ka, _, x) in enumerate(usable):
        for kb, _, y in usable[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                want[ka] += 1
                want[kb] += 1
                pairs += 1
    found = {r.vec_id: r for r in got}
    links = sum(r.n_links for r in got) / 2
    assert 0.9 * pairs <= links <= pairs
    for k, (i, _) in enumerate(rows):
        assert found[i].n_links <= want[k]
        if want[k] == 0:
            assert found[i].kept and found[i].component_id == i
    for i in (9000, 9001, 9002, 9003, 9004, 9007):
        assert found[i].n_links == 0 and found[i].kept
    assert found[9006].component_id == 9005 and not found[9006].kept


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    for dim in (16, 64, 256):
        a = rng.standard_normal((2000, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.standard_normal((2000, dim))
        b -= (a * b).sum(1, keepdims=True) * a
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        near = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * b
        met = lattice_dedup._first_meeting(*lattice_dedup.cells(a), *lattice_dedup.cells(near)) != 0
        assert met.mean() > 0.93


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.standard_normal((300, 8)) * 2
    point = lattice_dedup.nearest_e8(y)
    twice = np.rint(2 * point).astype(int)
    assert ((twice % 2 == 0).all(1) | (twice % 2 != 0).all(1)).all() and (twice.sum(1) % 4 == 0).all()
    best = ((y - point) ** 2).sum(1)
    for v in lattice_dedup.short_vectors():
        assert (((y - point - v) ** 2).sum(1) >= best - 1e-9).all()


def test_lattice_of_an_empty_table(spark):
    assert lattice_dedup.near_duplicate_vectors(make_vectors(spark, [])).collect() == []


def test_lattice_vectors_are_not_sent_to_every_task(spark):
    """The join that gives the rows their labels holds the vectors on both sides."""
    df = spark.createDataFrame([(k, [float(k % 5), 1.0, 2.0]) for k in range(20)], "vec_id long, embedding array<double>")
    got = lattice_dedup.near_duplicate_vectors(df)
    assert len(got.collect()) == 20
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin [data" in plan and "BroadcastHashJoin [data" not in plan


def test_lattice_recall_in_a_large_table(spark, tmp_path):
    """100,000 vectors, 8,000 of them planted near others; links against all cosines."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = np.random.default_rng(12)
    n, planted, d = 100_000, 8_000, 64
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    of = rng.integers(0, n - planted, planted)
    off = rng.standard_normal((planted, d))
    off -= (off * x[of]).sum(axis=1, keepdims=True) * x[of]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = rng.uniform(0.95, 0.995, planted)[:, None]
    x[n - planted:] = cosine * x[of] + np.sqrt(1 - cosine ** 2) * off
    # rows far apart on disk
    order = rng.permutation(n)
    pq.write_table(pa.table({"vec_id": order, "embedding": pa.array(list(x[order]), pa.list_(pa.float64()))}),
                   f"{tmp_path}/embeddings.parquet", row_group_size=5000)
    links = np.zeros(n, np.int64)
    single = x.astype(np.float32)
    for a in range(0, n, 2000):
        i, j = np.nonzero(single[a:a + 2000] @ single.T >= 0.9499)
        true = (np.einsum("ij,ij->i", x[a + i], x[j]) >= 0.95) & (a + i != j)
        np.add.at(links, a + i[true], 1)
    got = lattice_dedup.near_duplicate_vectors(spark.read.parquet(f"{tmp_path}/embeddings.parquet")).collect()
    assert sorted(r.vec_id for r in got) == list(range(n))
    found = np.zeros(n, np.int64)
    for r in got:
        found[r.vec_id] = r.n_links
    assert (found <= links).all() and links.sum() >= 2 * planted * 0.99
    recall = found.sum() / links.sum()
    print("recall", recall)
    assert recall >= 0.97
