import random

import corpus_pipeline
from loanlens.llm import queries
from tests.llm.conftest import make_documents, words


def test_stages_over_planted_documents(spark, tmp_path):
    rng = random.Random(21)
    texts = ["\n".join(" ".join(words(rng, 15, 3000)) for _ in range(6)) for _ in range(240)]
    passage = " ".join(words(rng, 60, 3000))
    toxic = {k for k in range(240) if k % 6 == 0}
    for k in range(0, 240, 6):
        for _ in range(5):
            texts[k] = texts[k].replace(" ", " idiot ", 1).replace("\n", " moron\n", 1)
    for k in (1, 7, 13):
        texts[k] += "\n" + passage
    texts[20] = texts[19]
    near = texts[31].replace("\n", " ").split()
    texts[31] = " ".join(near)
    near[40] = "edited"
    texts[32] = " ".join(near)
    texts += [None, ""]
    docs = make_documents(spark, texts)
    sf = str(tmp_path)
    docs.select(*corpus_pipeline.COLUMNS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(240)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{sf}/labels.parquet")
    at = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == corpus_pipeline.COLUMNS
        at.write.parquet(f"{sf}/{name}")
        at = spark.read.parquet(f"{sf}/{name}")
        kept[name] = {}
        for r in at.collect():
            kept[name].setdefault(r.doc_id, []).append(r.text)
    assert not toxic & set(kept["toxicity"])
    assert set(range(242)) - toxic == set(kept["toxicity"])
    lines = kept["line_dedup"]
    assert sum((t or "").count(passage) for v in lines.values() for t in v) == 1 and passage in lines[1][0]
    assert 20 not in lines and lines[19][0] == texts[19] and lines[241] == [""]
    near = kept["near_dedup"]
    assert 31 in near and 32 not in near and set(lines) - {32} == set(near)
    assert all(len(v) <= 2 for v in kept["mixing"].values()) and any(len(v) == 2 for v in kept["mixing"].values())
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in pieces} == set(kept["mixing"])
    fill = {}
    for r in pieces:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024


def small_tables(spark, sf, seed, texts=()):
    rng = random.Random(seed)
    texts = [*texts, *("\n".join(" ".join(words(rng, 15, 3000)) for _ in range(4)) for _ in range(80))]
    for k in range(10, 70, 7):
        texts[k] = texts[k].replace(" ", " idiot moron ", 4)
    ids = list(range(len(texts)))
    ids[5], ids[9] = None, ids[8]
    make_documents(spark, texts, ids).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, 1, int(10 <= k < 70 and (k - 10) % 7 == 0)) for k in range(len(texts))] + [(None, None, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return list(zip(ids, texts))


def rows_of(df):
    return sorted((tuple(r) for r in df.drop("sequence_id", "offset").collect()), key=str)


def folders(spark):
    import os
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return {x for x in os.listdir(root) if not x.startswith("rdd-") and len(x.split("-")[-1]) == 32}


def test_odd_rows_and_empty_tables(spark, tmp_path, odd_texts):
    rows = small_tables(spark, str(tmp_path), 3, odd_texts)
    before = folders(spark)
    one = corpus_pipeline.CorpusRun(spark, str(tmp_path))
    got = one.result.collect()
    # every row that a stage drops is a copy, toxic or left out by the mix; sources repeat every five rows
    assert {r.doc_id for r in got} <= {i for i, _ in rows} and None in {r.doc_id for r in got}
    whole = {}
    for r in got:
        whole.setdefault((r.doc_id, r.doc_tokens), []).append(r.length)
    assert all(sum(v) % n == 0 for (_, n), v in whole.items())
    assert max(r.doc_tokens for r in got) > 20000
    # outputs of earlier stages are gone, and after clear all folders
    assert len(folders(spark) - before) <= 2
    one.clear()
    assert folders(spark) == before
    empty = f"{tmp_path}/empty"
    spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_two_runs_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    for name, seed in (("a", 5), ("b", 6)):
        small_tables(spark, f"{tmp_path}/{name}", seed)
    alone = {n: rows_of(corpus_pipeline.run(spark, f"{tmp_path}/{n}")) for n in "ab"}
    with ThreadPoolExecutor(3) as pool:
        both = list(pool.map(lambda n: rows_of(corpus_pipeline.run(spark, f"{tmp_path}/{n}")), "aba"))
    assert both == [alone["a"], alone["b"], alone["a"]]


def test_every_operator_is_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {*queries.QUERIES, "pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
