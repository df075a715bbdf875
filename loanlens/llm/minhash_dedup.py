"""Operator 2: MinHash near-dedup with sequential Bayesian verification.

1. Each document's distinct 5-word shingles give a 128-bit set key and a
   signature of ``HASHES`` minima.  Documents with one set are one class;
   copies are never paired.
2. The signatures of classes are cut into bands of ``ROWS``; classes that
   agree in a band are candidates.  At a similarity of 0.75 a pair agrees in
   no band with a probability of 2e-5.
3. Candidates are compared signature batch by batch; a pair is dropped as soon as the
   posterior probability (uniform prior) of a similarity of 0.75 or more
   falls below ``MISS``.
4. Survivors are verified on their full shingle sets.

Candidates are made in rounds so that a group of near copies never makes all
its pairs.  First each class of a bucket meets the bucket's first class,
and in large buckets its neighbours in a random order.  Then, in buckets that
are still not one component, all classes of different components meet; in
large ones inside tasks, block by block, so that no pairs are written.  Pairs inside a
component can't change it, so the components are those of all links.

Defined results: documents without words have an empty set, link with
nothing and are kept; a row with a null ``doc_id`` is kept only if it links
with nothing, and a component has a null id only if all its rows have; rows
with the same ``doc_id`` are rows of their own; an empty table gives no rows;
other columns are carried if asked for.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.components import connected_components
from loanlens.llm.storage import Workspace
from loanlens.llm.text import batch_words, mix64, shingle_set, signed
from loanlens.llm.token_files import _arrow, row_ids
from loanlens.llm.vectors import key_runs

ROWS = 5
BANDS = 40
HASHES = ROWS * BANDS
#: Hashes compared before the posterior is looked at again.
STEP = 40
#: Probability at which a candidate is given up.
MISS = 1e-6
#: Links need SHARE_OF % of the union in common.
PERCENT = 75
#: Classes of a bucket whose pairs are written as rows; a larger bucket is compared in blocks of ``BLOCK``.
SMALL, BLOCK = 32, 256
#: Candidate ids up to this many are sent to every task (about 32 MB); more are joined by a shuffle.
SENT_IDS = 1_000_000

_SEED = mix64(np.arange(1, HASHES + 1, dtype=np.uint64))
_XOR = (_SEED >> np.uint64(32)).astype(np.uint32)[:, None]
_MUL = (_SEED.astype(np.uint32) | np.uint32(1))[:, None]

_PROFILE = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("signature", T.BinaryType())])
_BAND = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("node", T.LongType()),
                      T.StructField("n", T.LongType())])
_SET = T.StructType([T.StructField("n", T.LongType()), T.StructField("hi", T.LongType()),
                     T.StructField("lo", T.LongType()), T.StructField("shingles", T.BinaryType())])


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` hash functions over a set, 32 bits each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        h = (x[None, at:at + 2048] ^ _XOR) * _MUL
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
        np.minimum(out, h.min(axis=1), out=out)
    return out


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set; equal sets and, but for chance, only they agree."""
    hi = mix64(shingles ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    lo = mix64(shingles + np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return int(hi.astype(np.int64)), int(lo.astype(np.int64))


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on) of each batch.

    With m matches of n and a uniform prior the similarity is Beta(m+1,
    n-m+1), and P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    t, bounds = percent / 100, []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        bounds.append((n, m))
    return bounds


def profiles(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Set size, set key and signature of every document; ``row`` has the columns to carry."""

    def run(batches):
        uid = row_ids()
        for batch in batches:
            n, hi, lo, signs = [], [], [], []
            for _, words in batch_words(batch.column(2)):
                shingles = shingle_set(words)
                key = set_key(shingles)
                n.append(len(shingles))
                hi.append(key[0])
                lo.append(key[1])
                signs.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([next(uid) for _ in n], pa.int64()), batch.column(1), pa.array(n, pa.int64()),
                 pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(signs, pa.binary())],
                ["row", "uid", "doc_id", "n", "hi", "lo", "signature"])

    row = F.struct(*[F.col(c) for c in carry or ["doc_id"]]).alias("row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *_PROFILE.fields]))


def bands(classes: DataFrame) -> DataFrame:
    """(bucket, node, n): each class once for each band."""

    def run(batches):
        salt = mix64(np.arange(7001, 7001 + BANDS, dtype=np.uint64))
        for batch in batches:
            if not len(batch):
                continue
            signs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
            key = np.broadcast_to(salt, signs.shape[:2])
            for k in range(ROWS):
                key = mix64(key ^ signs[:, :, k])
            node, n = (np.repeat(batch.column(k).to_numpy(), BANDS) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key.reshape(-1))), pa.array(node), pa.array(n)], schema=_arrow(_BAND))

    return classes.select("node", "n", "signature").mapInArrow(run, _BAND)


def _possible(a: str, b: str) -> str:
    """Sets whose sizes alone allow a link."""
    return f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})"


def _survivors(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that the signature batches don't rule out."""
    bounds = least_matches()

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, HASHES)
                           for k in (2, 3))
            alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
            for n, least in bounds:
                matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                keep = matches >= least
                alive, matches, done = alive[keep], matches[keep], n
            yield batch.select([0, 1]).take(pa.array(alive))

    signs = classes.select("node", "signature")
    joined = (pairs.join(signs.toDF("a", "sa"), "a").join(signs.toDF("b", "sb"), "b")
              .select("a", "b", "sa", "sb"))
    return joined.mapInArrow(run, "a long, b long")


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, work: Workspace, table: str) -> DataFrame:
    """(node, shingles) of the classes in ``nodes``, made anew from the texts."""
    wanted = work.write(nodes.join(classes.select("node", "n", "hi", "lo", "some_doc"), "node"), f"{table}-wanted")
    ids = wanted.select("some_doc").distinct()
    if wanted.count() <= SENT_IDS:
        ids = F.broadcast(ids)

    def run(batches):
        for batch in batches:
            rows = []
            for _, words in batch_words(batch.column(0)):
                shingles = shingle_set(words)
                hi, lo = set_key(shingles)
                rows.append({"n": len(shingles), "hi": hi, "lo": lo, "shingles": shingles.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(_SET))

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("some_doc")), "left_semi").select("text").mapInArrow(run, _SET)
    found = sets.join(wanted, ["n", "hi", "lo"]).select("node", "shingles")
    return work.write(found.dropDuplicates(["node"]), table)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that link by their full sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= PERCENT * (len(x) + len(y) - common):
                    keep.append(k)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return (pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "u long, v long"))


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, work: Workspace, name: str) -> DataFrame:
    kept = work.write(_survivors(pairs, classes), f"{name}-survivors")
    nodes = kept.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = work.write(_verified(kept, _full_sets(docs, classes, nodes, work, f"{name}-sets")), f"{name}-links")
    work.remove(f"{name}-survivors", f"{name}-sets", f"{name}-sets-wanted")
    return links


def _named(members: DataFrame, found: DataFrame, work: Workspace, table: str) -> DataFrame:
    """Members of buckets whose classes are in several components, with the component."""
    named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_buckets = (named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                    .where("x <> y").select("bucket"))
    return work.write(named.join(open_buckets, "bucket").select("bucket", "node", "n", "component", "led", "size"), table)


def _neighbours(members: DataFrame) -> DataFrame:
    """Pairs (a, b) next to each other in a random order of each bucket.

    The order is global, so a large bucket spreads over many partitions.
    """

    def run(batches):
        last = None
        for batch in batches:
            bucket, node, n = (batch.column(k).to_numpy() for k in range(3))
            rows = np.stack([bucket, node, n])
            if last is not None:
                rows = np.concatenate([last, rows], axis=1)
            if rows.shape[1]:
                x, y = rows[:, :-1], rows[:, 1:]
                small, large = np.minimum(x[2], y[2]), np.maximum(x[2], y[2])
                fits = (x[0] == y[0]) & (100 * small >= PERCENT * large)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(x[1], y[1])[fits]), pa.array(np.maximum(x[1], y[1])[fits])], ["a", "b"])
                last = rows[:, -1:]

    mixed = members.select("bucket", "node", "n", F.xxhash64("node", "bucket").alias("order"))
    return (mixed.repartitionByRange("bucket", "order").sortWithinPartitions("bucket", "order")
            .select("bucket", "node", "n").mapInArrow(run, "a long, b long"))


def _across(named: DataFrame) -> DataFrame:
    """All pairs (a, b) of small buckets that are in different components and were not paired with its first class."""
    a, b = named.alias("a"), named.alias("b")
    return (a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.component") != F.col("b.component"))
                   & (F.col("a.node") < F.col("b.node")) & ~F.col("a.led") & F.expr(_possible("a.n", "b.n")))
            .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct())


def _block_links(rows: pa.Table) -> list[tuple[int, int]]:
    """Links between classes of different components, of two blocks or inside one."""
    node, n, of = (rows[c].to_numpy() for c in ("node", "n", "component"))
    signs = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(-1, HASHES)
    sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
    side = rows["side"].to_numpy()
    inner = rows["block_a"][0].as_py() == rows["block_b"][0].as_py()
    left = np.arange(len(node)) if inner else np.flatnonzero(side == 1)
    right = left if inner else np.flatnonzero(side == 0)
    fits = of[left][:, None] != of[right][None, :]
    fits &= 100 * np.minimum(n[left][:, None], n[right]) >= PERCENT * np.maximum(n[left][:, None], n[right])
    if inner:
        fits = np.triu(fits, 1)
    (i, j), done = np.nonzero(fits), 0
    i, j = left[i], right[j]
    matches = np.zeros(len(i), np.int64)
    for upto, least in least_matches():
        for a in range(0, len(i), 1 << 16):
            part = slice(a, a + (1 << 16))
            matches[part] += (signs[i[part], done:upto] == signs[j[part], done:upto]).sum(axis=1)
        keep = matches >= least
        i, j, matches, done = i[keep], j[keep], matches[keep], upto
    # likely links first; a pair whose components have met needs no check
    order = np.argsort(-matches, kind="stable")
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    links = []
    for x, y in zip(i[order].tolist(), j[order].tolist()):
        p, q = find(int(of[x])), find(int(of[y]))
        if p == q:
            continue
        small, large = (sets[x], sets[y]) if len(sets[x]) < len(sets[y]) else (sets[y], sets[x])
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        common = int((large[at] == small).sum())
        if 100 * common >= PERCENT * (len(small) + len(large) - common):
            links.append((int(node[x]), int(node[y])))
            root[max(p, q)] = min(p, q)
    return links


def _cluster_links(named: DataFrame, docs: DataFrame, classes: DataFrame, work: Workspace) -> DataFrame:
    """Links between components that share a large bucket, compared in blocks inside tasks.

    Components that share a large bucket, directly or in turn, form a
    cluster; its classes are dealt into blocks, and every pair of blocks is one
    run of rows.  Only links are returned.
    """
    lead = named.groupBy("bucket").agg(F.min("component").alias("v"))
    shared = named.join(lead, "bucket").select(F.col("component").alias("u"), "v").distinct()
    clusters = connected_components(shared).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    nodes = work.write(named.select("node", "n", "component").distinct().join(clusters, "component"), "clustered")
    sets = _full_sets(docs, classes, nodes.select("node"), work, "cluster-sets")
    blocks = nodes.groupBy("cluster").agg(F.expr(f"ceil(count(*) / {BLOCK})").alias("blocks"))
    dealt = (nodes.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("cluster", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
                     (F.col("own") <= F.col("other")).cast("int").alias("side"), "node", "n", "component"))
    rows = dealt.join(classes.select("node", "signature"), "node").join(sets, "node")

    def run(batches):
        for group in key_runs(batches, ["cluster", "block_a", "block_b"]):
            links = _block_links(group)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()),
                                                  pa.array([y for _, y in links], pa.int64())], ["u", "v"])

    keys = ["cluster", "block_a", "block_b"]
    return work.write(rows.repartition(*keys).sortWithinPartitions(*keys, "node")
                      .select(*keys, "side", "node", "n", "component", "signature", "shingles")
                      .mapInArrow(run, "u long, v long"), "cluster-links")


def near_duplicates(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (else doc_id), n_shingles, component_id, kept and first of every row of ``docs``.

    ``first`` marks one row of each component, the one with the smallest
    ``doc_id`` that was read first.  Carried columns with the names of results
    give way to them.
    """
    if carry:
        carry = [c for c in carry if c not in ("n_shingles", "component_id", "kept", "first")] or None
    work = Workspace(docs.sparkSession, "minhash")
    rows = work.write(profiles(docs, carry), "profiles")
    key = ["n", "hi", "lo"]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    grouped = (rows.where("n > 0").groupBy(*key)
               .agg(F.min("uid").alias("node"), F.min(order).alias("lead"), F.count("*").alias("copies")))
    firsts = rows.select(F.col("uid").alias("node"), F.col("doc_id").alias("some_doc"), "signature")
    classes = work.write(grouped.join(firsts, "node"), "classes")

    banded = bands(classes)
    led = (banded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("size"))
           .where("size > 1").select("bucket", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n"), "size"))
    members = work.write(banded.join(led, "bucket").withColumn("led", F.col("node") == F.col("lead")), "members")
    stars = (members.where(f"NOT led AND {_possible('n', 'lead_n')}")
             .select(F.col("lead").alias("a"), F.col("node").alias("b")))
    near = _neighbours(members.where(f"size > {SMALL}"))
    links = _links(stars.union(near).distinct(), docs, classes, work, "first")
    found = connected_components(links)
    named = _named(members, found, work, "named")
    more = _links(_across(named.where(f"size <= {SMALL}")), docs, classes, work, "across")
    large = named.where(f"size > {SMALL}")
    if not large.isEmpty():
        more = more.union(_cluster_links(large, docs, classes, work))
    if not more.isEmpty():
        found = connected_components(links.union(more))

    # only components of several rows need a label
    named = classes.select(*key, "node", "lead", "copies").join(found, "node", "left") \
        .where("component IS NOT NULL OR copies > 1").withColumn("component", F.coalesce("component", "node"))
    leads = named.groupBy("component").agg(F.min("lead").alias("lead"))
    labels = named.drop("lead").join(leads, "component").select(*key, "lead")
    several = work.write(rows.select("uid", *key).join(labels, key).select(
        F.col("uid").alias("of"), F.col("lead.doc_id").alias("component_id"), (F.col("lead.uid") == F.col("uid")).alias("first")),
        "several")
    work.remove("classes", "members", "named", "first-links", "across-links", "cluster-links", "cluster-sets",
                "cluster-sets-wanted", "clustered")
    if several.count() <= SENT_IDS:
        several = F.broadcast(several)
    alone = F.col("of").isNull()
    return (rows.join(several, F.col("uid") == F.col("of"), "left")
            .select("row.*", F.col("n").alias("n_shingles"),
                    F.when(alone, rows["doc_id"]).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(alone, F.lit(True)).otherwise(F.coalesce(rows["doc_id"] == F.col("component_id"), F.lit(False)))
                    .alias("kept"), F.when(alone, F.lit(True)).otherwise(F.col("first")).alias("first")))
