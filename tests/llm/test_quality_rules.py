import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loanlens.llm import quality_rules
from loanlens.llm.text import mix64, text_bytes
from tests.llm.conftest import make_documents, words


def base_of(text):
    """The base counts, word by word."""
    text = text or ""
    found = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(found[k:k + 5]) for k in range(len(found) - 4))
    inside = {k + j for k in range(len(found) - 4) if windows[tuple(found[k:k + 5])] > 1 for j in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            repeated += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall("[#*$%&|<>]", text)), repeated, len(inside)


def tokens_of(text):
    """Letters, digits and characters beyond ASCII stick together; so do other marks."""
    return re.findall("[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\x20\x09-\x0d]+", text or "")


def hash_of(token):
    data, offsets = text_bytes(pa.array([token]))
    return quality_rules.token_hashes(data, offsets)[0]


def buckets_of(text, buckets):
    hashes = [hash_of(t)[0] for t in tokens_of(text)]
    pairs = [mix64(np.array([a]) * quality_rules._SECOND + b)[0] for a, b in zip(hashes, hashes[1:])]
    return [int(h) % buckets for h in hashes + pairs]


def judge(texts, trusted, tail=0.001, margin=0.2):
    """(base, failed, kept) of each text by plain loops."""
    buckets = quality_rules.bucket_count(sum(len((t or "").encode()) for t in texts))
    grams = [buckets_of(t, buckets) for t in texts]
    raw, target = Counter(), Counter()
    for k, g in enumerate(grams):
        raw.update(g)
        target.update(g if k in trusted else ())
    n_raw, n_target = sum(raw.values()), sum(target.values())
    weight = {b: round(65536 * (math.log(target[b] + 1) - math.log(raw[b] + 1) - math.log(n_target + buckets)
                                + math.log(n_raw + buckets))) for b in raw}
    sums = [sum(weight[b] for b in g) if n_target else 0 for g in grams]
    base = [base_of(t) for t in texts]
    failed = [b[0] < 10 or 100 * b[4] > 20 * b[0] for b in base]
    steps = sorted(math.floor(sums[k] / len(grams[k]) / 64) for k in trusted if not failed[k] and grams[k])
    limit = steps[int(tail * len(steps))] * 64 - round(margin * 65536) if steps else None
    return [(b, f, not f and (limit is None or s >= limit * len(g))) for b, f, s, g in zip(base, failed, sums, grams)]


def corpus():
    rng = random.Random(4)
    texts = [" ".join(words(rng, rng.randrange(8, 60))) for _ in range(120)]
    texts += [" ".join(w + "%%%" for w in words(rng, 40)) for _ in range(30)]
    line = " ".join(words(rng, 12))
    texts += ["\n".join([line] * 3), f"{line}\n x \n{line} \n{line}\n\n\n", " ".join(words(rng, 30)) + " # <a> | $5"]
    return texts


def check(got, want, ids):
    assert len(got) == len(want)
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((tuple(r[c] for c in quality_rules.BASE), r.base_failed, r.kept))
    expected = {}
    for i, w in zip(ids, want):
        expected.setdefault(i, []).append(w)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


@pytest.mark.parametrize("sent", [1 << 24, 1])
def test_against_plain_loops(spark, monkeypatch, odd_texts, sent):
    monkeypatch.setattr(quality_rules, "SENT_BUCKETS", sent)
    texts = [t if t is None or len(t) < 20000 else t[:9000] for t in odd_texts] + corpus()
    ids = list(range(len(texts)))
    ids[3], ids[8] = None, ids[7]
    trusted = {k for k in range(30, 110)}
    docs = make_documents(spark, texts, ids)
    good = spark.createDataFrame([(k,) for k in [*trusted, *trusted, None]], "doc_id long")
    got = quality_rules.judge_quality(docs, good).collect()
    want = judge(texts, trusted)
    check(got, want, ids)
    assert {w[2] for w in want} == {True, False}
    # junk that passes the base rules goes by its ratio
    junk = range(len(odd_texts) + 120, len(odd_texts) + 150)
    assert not any(want[k][2] for k in junk) and not any(want[k][1] for k in junk)


def test_without_trusted_documents(spark, no_documents):
    texts = corpus()
    none = spark.createDataFrame([], "doc_id long")
    assert quality_rules.judge_quality(no_documents, none).collect() == []
    got = quality_rules.judge_quality(make_documents(spark, texts), none).collect()
    check(got, judge(texts, set()), range(len(texts)))


def test_labels_of_the_held_out_third_are_not_used(spark):
    texts = corpus()
    docs = make_documents(spark, texts)
    from zlib import crc32
    rows = [(k, 1 if k < 120 else 0) for k in range(150)]
    labels = spark.createDataFrame(rows + [(None, 1), (3, None)], "doc_id long, quality int")
    other = [(k, 1 - q if crc32(str(k).encode()) % 3 == 1 else q) for k, q in rows]
    flipped = spark.createDataFrame(other, "doc_id long, quality int")
    first = quality_rules.quality_rules_digest(docs, labels).collect()
    assert sorted(first) == sorted(quality_rules.quality_rules_digest(docs, flipped).collect())
    kept = {r.doc_id for r in first if r.kept}
    learned = {r.doc_id for r in first if not r.base_failed and r.doc_id < 120 and crc32(str(r.doc_id).encode()) % 3 != 1}
    assert not kept & set(range(120, 150)) and learned <= kept


def test_very_long_text_in_bounded_memory():
    rng = random.Random(2)
    piece = " ".join(words(rng, 4000)) + "\n"
    text = piece * (20_000_000 // len(piece)) + "tail"
    data, offsets = text_bytes(pa.array([text]))
    tracemalloc.start()
    base = quality_rules.base_counts(data, offsets)
    row, bucket = quality_rules.gram_buckets(data, offsets, 1 << 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = len(text.split())
    assert base[0].tolist()[0] == n and base[0].tolist()[4] == n - 1 and len(bucket) > 2 * n - 2
    assert peak < 20 * len(text)


def test_one_very_long_word(monkeypatch):
    from loanlens.llm import text as texts
    rng = random.Random(3)
    line = " ".join("".join(rng.choice("abcxyz") for _ in range(n)) for n in (5, 7000, 64, 65, 128, 1, 4000))
    data, offsets = text_bytes(pa.array([line, line[:5000]]))
    whole = [quality_rules.token_hashes(data, offsets), texts.word_hashes(data, offsets)]
    monkeypatch.setattr(texts, "CHUNK", 64)
    for f, (hashes, counts) in zip((quality_rules.token_hashes, texts.word_hashes), whole):
        assert (f(data, offsets)[0] == hashes).all() and (f(data, offsets)[1] == counts).all()
