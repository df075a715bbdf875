import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from loanlens.llm import language_id, pu_quality, toxicity
from loanlens.llm.dense_features import NAMES, all_features
from loanlens.llm.labelled import is_held_out, remainder
from tests.llm.conftest import make_documents, words

LABELS = "doc_id long, quality int, toxic int, uid string"
PARTS = {"en": "th er on an re he in ed nd ha".split(), "de": "sch ein ich ung ver ge te äu ö ber".split(),
         "fr": "eau oux ment que é è aire tion ou les".split()}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Clean, shouted, symbol-ridden, repeated and insulting texts with labels."""
    rng = random.Random(11)
    texts, labels, langs = [], [], []
    for k in range(900):
        lang = rng.choice(list(PARTS))
        body = sentence(rng, lang, rng.randrange(20, 200)).split()
        quality, toxic = 1, 0
        if k % 7 == 0:
            quality = 0
            kind = k // 7 % 3
            body = [w.upper() + "!!" for w in body] if kind == 0 else \
                [w + rng.choice(["***", "###"]) for w in body] if kind == 1 else [body[0]] * len(body)
        elif k % 5 == 0:
            toxic = 1
            for _ in range(4):
                body.insert(rng.randrange(len(body)), rng.choice(["idiot", "zorgling", "zorgler", "st0pid"]))
        texts.append(" ".join(body))
        labels.append((k, quality, toxic, "u"))
        langs.append(lang)
    return texts, labels, langs


def frames(spark, corpus):
    texts, labels, _ = corpus
    docs = make_documents(spark, [*texts, None, "", "?!", "x" * 20000], [*range(len(texts)), 5000, 5001, None, 5003])
    return docs, spark.createDataFrame(labels, LABELS)


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def accuracy(rows, truth):
    own = [(r.predicted, truth[r.doc_id]) for r in rows if r.doc_id in truth and r.held_out]
    return np.mean([p == y for p, y in own])


def test_split_is_the_crc_of_the_id_as_text(spark, corpus):
    docs, _ = frames(spark, corpus)
    for r in docs.select("doc_id", is_held_out()).collect():
        assert r.held_out == (zlib.crc32(b"") % 3 == 1 if r.doc_id is None else held(r.doc_id))


def test_quality_on_held_out_rows(spark, corpus):
    docs, labels = frames(spark, corpus)
    rows = pu_quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert accuracy(rows, {r[0]: r[1] for r in corpus[1]}) > 0.97


def test_quality_never_reads_held_out_labels(spark, corpus):
    docs, labels = frames(spark, corpus)
    turned = spark.createDataFrame([(i, 1 - q if held(i) else q, t, u) for i, q, t, u in corpus[1]], LABELS)
    a, b = ({r.doc_id: r.score for r in pu_quality.score_quality(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_prior_estimate():
    rng = np.random.default_rng(2)
    p = rng.normal(1, 1, 5000)
    u = np.where(rng.random(5000) < 0.7, rng.normal(1, 1, 5000), rng.normal(-3, 1, 5000))
    assert abs(pu_quality.best_bin_prior(p, u) - 0.7) < 0.06


def test_toxicity_on_held_out_rows(spark, corpus):
    docs, labels = frames(spark, corpus)
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert accuracy(rows, {r[0]: r[2] for r in corpus[1]}) > 0.97
    clean = [r.predicted for r in rows if r.doc_id is not None and r.doc_id < 5000 and not corpus[1][r.doc_id][2]]
    assert np.mean(clean) < 0.01


@pytest.mark.parametrize("score", [toxicity.score_toxicity, pu_quality.score_quality])
def test_classifiers_of_little(spark, no_documents, corpus, score):
    docs, labels = frames(spark, corpus)
    assert score(no_documents, labels).collect() == []
    few = score(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(few) == docs.count() and len({r.score for r in few}) == 1


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = toxicity.ToxicityModel.fit(x, y, rng.integers(0, 3, 2000), [x, x, x])
    assert ((model(x) >= 0.5) == y).mean() > 0.97
    at, share = toxicity.isotonic(np.array([3.0, 1.0, 2.0, 2.0, 5.0]), np.array([1, 0, 1, 0, 1.0]))
    assert (np.diff(at) >= 0).all() and (np.diff(share) >= 0).all() and share[0] == 0 and share[-1] == 1


def test_features_of_odd_texts(odd_texts):
    x = all_features(pa.array(odd_texts))
    assert x.shape == (len(odd_texts), len(NAMES)) and np.isfinite(x).all()
    assert (x[0] == x[1]).all()
    full = toxicity.ToxicFeatures(np.zeros(0, np.uint64))(pa.array(odd_texts))
    assert len(full) == len(odd_texts) and np.isfinite(full).all()


def test_lexicon_sees_substitutes_and_second_person():
    f = toxicity.ToxicFeatures(np.zeros(0, np.uint64))(pa.array(["you idiot", "the idiot", "an 1d10t here", "fine 10 3"]))
    near, hidden = f[:, len(NAMES) + 3], f[:, len(NAMES) + 4]
    assert near.tolist() == [1, 0, 0, 0] and hidden.tolist() == [0, 0, 1, 0]


def reference_grams(text):
    s = "".join(c if c.isalpha() else " " for c in text.lower())
    s = "  " + " ".join(s.split()) + " "
    return [s[i:i + 4] for i in range(len(s) - 3)] if s.strip() else []


def test_grams_follow_python():
    texts = ["Hello, World!", "", "  ", "a", "é È!x", "12 3", "ab\x01cd", "x  y\n\nz ", "tail", "..a.. b"]
    keys, counts = language_id.gram_keys(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        got = ["".join(chr((int(k) >> s) & 0xFFFF) for s in (48, 32, 16, 0)) for k in keys[at:at + n]]
        assert got == reference_grams(text.replace("\x01", " "))
        at += n


def test_kneser_ney_against_its_formula():
    keys, _ = language_id.gram_keys(["the cat sat on the mat the rat"] * 2 + ["a bat", "the hat"])
    grams, n = np.unique(keys, return_counts=True)
    letters = np.unique(grams & np.uint64(0xFFFF))
    model = language_id.KneserNey.fit(grams, n.astype(float), len(letters))
    for k in (0, 4, 9):
        context = grams[k] >> np.uint64(16) << np.uint64(16)
        assert abs(np.exp(model.log_probability(context | letters)).sum() - 1) < 1e-9
    # the plain formula, order by order
    table = {int(g): float(c) for g, c in zip(grams, n)}
    tables = [table]
    for k in (3, 2, 1):
        lower = {}
        for g in tables[-1]:
            lower[g & ((1 << 16 * k) - 1)] = lower.get(g & ((1 << 16 * k) - 1), 0) + 1.0
        tables.append(lower)

    def p(g, k):
        if k == 0:
            return 1 / len(letters)
        own, g = tables[4 - k], g & ((1 << 16 * k) - 1)
        ones, twos = sum(v == 1 for v in own.values()), sum(v == 2 for v in own.values())
        d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        total = sum(v for x, v in own.items() if x >> 16 == g >> 16)
        if not total:
            return p(g, k - 1)
        kinds = sum(x >> 16 == g >> 16 for x in own)
        return max(own.get(g, 0) - d, 0) / total + d * kinds / total * p(g, k - 1)

    got = np.exp(model.log_probability(grams))
    assert np.allclose(got, [p(int(g), 4) for g in grams])


def test_languages_on_held_out_rows(spark, corpus):
    texts, _, langs = corpus
    rows = [(k, t, x, "s") for k, (t, x) in enumerate(zip(texts, langs))]
    rows += [(7000, None, "en", "s"), (7001, "", "de", "s"), (7002, "12 !?", "fr", "s"), (None, texts[0], None, "s"), (7004, "é", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out string")
    got = language_id.identify_languages(docs, language_id.fit_language_model(docs)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    own = [by[k].lang_pred == langs[k] for k in range(len(langs)) if held(k)]
    assert np.mean(own) > 0.98
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (7000, 7001, 7002))
    assert by[None].lang_pred == langs[0] and by[7004].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got)


def test_large_language_models_keep_every_gram(spark, corpus, monkeypatch):
    texts, _, langs = corpus
    rows = [(k, t, x) for k, (t, x) in enumerate(zip(texts, langs))]
    rows += [(7000, None, "en"), (7001, "", "de"), (7002, "12 !?", "fr"), (None, texts[0], None), (7004, "é 你好 \U00020000", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sent = language_id.fit_language_model(docs)
    want = sorted((str(r.doc_id), r) for r in language_id.identify_languages(docs, sent).collect())
    # far fewer than the grams of the three languages: tables are joined and no gram is left out
    monkeypatch.setattr(language_id, "SENT_GRAMS", 100)
    monkeypatch.setattr(language_id, "RUN_CHARS", 20_000)
    model = language_id.fit_language_model(docs)
    assert model.tables is not None and not model.models
    assert model.temper == sent.temper and abs(model.reject_above - sent.reject_above) < 1e-9
    got = sorted((str(r.doc_id), r) for r in language_id.identify_languages(docs, model).collect())
    assert len(got) == len(want)
    for (_, g), (_, w) in zip(got, want):
        assert g[:3] == w[:3] and abs(g.score - w.score) < 1e-9 and g.rejected == w.rejected


def test_languages_of_nothing(no_documents, odd_documents):
    model = language_id.fit_language_model(no_documents)
    assert language_id.identify_languages(no_documents, model).collect() == []
    assert {r.lang_pred for r in language_id.identify_languages(odd_documents, model).collect()} == {"und"}


def test_lexicons_of_folds_have_not_seen_their_fold(spark):
    rng = random.Random(41)
    rows = []
    for k in range(240):
        toxic = int(k % 4 == 0)
        fold = int(toxicity.folds_of(np.array([k]))[0])
        # one bad word everywhere, one that only a fold's toxic texts have
        bad = ["gromble", f"zork{'abc'[fold]}xy"] if toxic else []
        rows.append((k, " ".join(words(rng, 20) + bad), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int")
    every, *others = toxicity.mine_lexicons(frame)
    known = {w: toxicity._hash_list([w])[0] for w in ("gromble", "zorkaxy", "zorkbxy", "zorkcxy")}
    assert all(h in every for h in known.values())
    for f, mined in enumerate(others):
        assert known["gromble"] in mined
        assert [known[f"zork{c}xy"] in mined for c in "abc"] == [f != j for j in range(3)]


def test_lexical_counts_of_long_texts(monkeypatch):
    rng = random.Random(42)
    text = " ".join(rng.choice(["you", "idiot", "1d10t", "fine", "nice day"]) for _ in range(3000))
    f = toxicity.ToxicFeatures(np.zeros(0, np.uint64))
    data = np.frombuffer(text.encode(), np.uint8)
    whole = f._counts(data, np.array([0, len(data)]))[0]
    monkeypatch.setattr(toxicity, "CHUNK", 4000)
    parts = f.lexical(data, np.array([0, len(data)]))
    # only "near" may differ, where a segment ends between a hit and the second person
    assert (np.minimum(whole, 12) == parts[:, :toxicity.LEXICAL]).all()


def test_languages_are_calibrated_on_all_training_rows(spark, corpus, monkeypatch):
    """Beyond what any sample held: the bound is the quantile of every training document."""
    monkeypatch.setattr(language_id, "CALIBRATION", 5, raising=False)
    texts, _, langs = corpus
    docs = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(zip(texts, langs))] + [(7000, None, "en"), (7001, "12", "de")],
                                 "doc_id long, text string, lang string")
    model = language_id.fit_language_model(docs)
    rows = [r for r in docs.where(remainder() != 1).select("lang", "text").collect() if r.lang is not None and r.text is not None]
    sums, sizes = model.likelihoods([r.text for r in rows])
    own = [(-sums[k, model.langs.index(r.lang)] / sizes[k]) for k, r in enumerate(rows) if sizes[k]]
    assert len(own) > 50
    assert model.reject_above == pytest.approx(np.quantile(own, 0.995), rel=1e-9)
