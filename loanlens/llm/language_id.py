"""Operator 9: language id by interpolated Kneser-Ney character models.

Each language has a model of ``ORDER`` = 4 characters.  Counts of all
character 4-grams come from every document with a language that isn't held
out; lower orders count distinct left contexts, as Kneser-Ney asks.  The discount of each
order is n1 / (n1 + 2 n2).  A model is stored as sorted arrays of 64-bit n-gram keys with
their discounted probabilities and back-off weights; a text's language is the
one with the lowest cross-entropy per character.

Texts are read in lower case, runs of characters that aren't letters become
one space, and the text stands between spaces.  A key packs four characters
of 16 bits; rare characters beyond them share one code.

The score is the winner's share after a softmax over the total log
likelihoods, tempered by a factor fitted on all training documents.
``rejected`` marks texts whose cross-entropy is above that of
all but one in 200 of these; the prediction stays.

All counts are taken over all documents and all are kept.  Models of up to
``SENT_GRAMS`` 4-grams together are sent to every task.  Larger ones are
tables: Spark aggregates make the shares and back-off weights of each order,
the distinct 4-grams of the texts are joined to them, and each chunk of texts
meets the scores of its own 4-grams.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
if nothing could be learned; ties go to the first language by name; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.labelled import is_held_out, remainder
from loanlens.llm.storage import Workspace
from loanlens.llm.text import signed
from loanlens.operators.ordered import quantile_table

ORDER = 4
#: 4-grams of all models that are sent to every task; more are joined by shuffles.
SENT_GRAMS = 1 << 21
#: Factors of the softmax that are tried, and the share of training documents that aren't rejected.
FACTORS = np.geomspace(0.005, 1.0, 40)
KEPT_SHARE = 0.995
#: Characters of the texts that are counted or scored together.
RUN_CHARS = 1 << 19
#: Distinct 4-grams whose scores a worker keeps.
KEPT_GRAMS = 1 << 20
UNKNOWN = "und"
_SPACE, _EDGE, _RARE = 32, 1, 2
_TABLE: list[np.ndarray] = []


def _letter_codes() -> np.ndarray:
    """Code of each character of the first plane: itself for a letter, else a space."""
    if not _TABLE:
        table = np.full(1 << 16, _SPACE, np.uint16)
        letters = [c for c in range(1 << 16) if chr(c).isalpha()]
        table[letters] = letters
        table[_EDGE] = _EDGE
        _TABLE.append(table)
    return _TABLE[0]


def gram_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram keys, how many each text has); none for a text without letters."""
    joined = "\x01" + "\x01".join(t.replace("\x01", " ").lower() for t in texts) + "\x01"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = points >= 1 << 16
    codes = _letter_codes()[np.where(wide, 0, points)]
    if wide.any():
        codes[wide] = [_RARE if chr(c).isalpha() else _SPACE for c in points[wide].tolist()]
    # one space for a run; the edges between texts stay and count as spaces around
    blank = (codes == _SPACE) | (codes == _EDGE)
    keep = np.ones(len(codes), bool)
    keep[1:] = ~((codes[1:] == _SPACE) & blank[:-1])
    keep[:-1] &= ~((codes[:-1] == _SPACE) & (codes[1:] == _EDGE))
    codes = codes[keep]
    edge = np.flatnonzero(codes == _EDGE)
    letters = np.diff(edge) - 1
    # an edge becomes two spaces after, one before its text
    width = np.where(codes == _EDGE, 3, 1)
    codes = np.repeat(np.where(codes == _EDGE, _SPACE, codes), width).astype(np.uint64)
    key = (codes[:-3] << np.uint64(48)) | (codes[1:-2] << np.uint64(32)) | (codes[2:-1] << np.uint64(16)) | codes[3:]
    # text k starts at the second space of its edge and ends at the first space of the next
    start = edge + 2 * np.arange(len(edge)) + 1
    counts = np.where(letters > 0, letters, 0)
    begin = start[:-1]
    index = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return key[index], counts


def _text_runs(texts: list[str | None]):
    """Row ranges of about ``RUN_CHARS`` characters."""
    a = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= RUN_CHARS:
            yield a, k + 1
            a, size = k + 1, 0
    if a < len(texts):
        yield a, len(texts)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts with a language; summed in each task first."""

    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def merged(lang, key, n):
            if lang in held:
                key, n = np.concatenate([held[lang][0], key]), np.concatenate([held[lang][1], n])
                key, inverse = np.unique(key, return_inverse=True)
                n = np.bincount(inverse, weights=n, minlength=len(key)).astype(np.int64)
            held[lang] = [key, n]

        def out():
            for lang, (key, n) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key), pa.string()), pa.array(signed(key)), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                own = [t for t, x in zip(texts, langs) if x == lang]
                for a, b in _text_runs(own):
                    merged(lang, *(x.astype(t) for x, t in zip(
                        np.unique(gram_keys(own[a:b])[0], return_counts=True), (np.uint64, np.int64))))
            size = sum(len(key) for key, _ in held.values())
            if size > 4 * KEPT_GRAMS:
                yield from out()
                held.clear()
        yield from out()

    rows = docs.select(F.col("lang").cast("string"), F.col("text").cast("string")).where("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sum of values, rows) of sorted groups."""
    keys, start, rows = np.unique(key, return_index=True, return_counts=True)
    return keys, np.add.reduceat(value, start) if len(keys) else value, rows


def _find(keys: np.ndarray, values: np.ndarray, x: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(x), missing)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, values[at], missing)


def _discount(ones: int, twos: int) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones else 0.5


@dataclass
class KneserNey:
    """Sorted arrays of one language: for each order the grams and the contexts."""

    orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    floor: float

    @classmethod
    def fit(cls, gram: np.ndarray, n: np.ndarray, alphabet: int) -> KneserNey:
        orders = []
        for k in range(ORDER, 0, -1):
            order = np.argsort(gram, kind="stable")
            gram, n = gram[order], n[order]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = _discount(ones, twos)
            context = gram >> np.uint64(16)
            contexts, total, kinds = _sums(context, n)
            sums = total[np.searchsorted(contexts, context)]
            orders.append((gram, np.maximum(n - discount, 0.0) / sums, contexts, discount * kinds / total))
            # one order down a gram counts the kinds of characters before it
            shorter = gram & np.uint64((1 << (16 * (k - 1))) - 1)
            shorter = np.sort(shorter)
            gram, _, n = _sums(shorter, np.ones(len(shorter)))
        return cls(orders, 1.0 / max(alphabet, 2))

    def log_probability(self, gram: np.ndarray) -> np.ndarray:
        """Natural log of p(last character | three before it)."""
        p = np.full(len(gram), self.floor)
        for k, (grams, share, contexts, back) in zip(range(1, ORDER + 1), reversed(self.orders)):
            key = gram & np.uint64((1 << (16 * k)) - 1)
            p = _find(grams, share, key, 0.0) + _find(contexts, back, key >> np.uint64(16), 1.0) * p
        return np.log(p)


@dataclass
class LanguageModel:
    langs: list[str]
    models: list[KneserNey]
    temper: float = 1.0
    reject_above: float = np.inf
    tables: GramTables | None = None
    _keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    _logs: np.ndarray | None = None

    def _scores(self, grams: np.ndarray) -> np.ndarray:
        """Log probabilities of sorted distinct grams in all languages; kept in the worker."""
        if self._logs is None:
            self._logs = np.zeros((0, len(self.models)))
        if len(self._keys):
            at = np.minimum(np.searchsorted(self._keys, grams), len(self._keys) - 1)
            known = self._keys[at] == grams
        else:
            at, known = np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
        out = np.zeros((len(grams), len(self.models)))
        out[known] = self._logs[at[known]]
        new = grams[~known]
        if len(new):
            logs = np.stack([m.log_probability(new) for m in self.models], axis=1)
            out[~known] = logs
            if len(self._keys) < KEPT_GRAMS:
                where = np.searchsorted(self._keys, new)
                self._keys, self._logs = np.insert(self._keys, where, new), np.insert(self._logs, where, logs, axis=0)
        return out

    def likelihoods(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log likelihood of each text in each language, characters scored)."""
        sums, sizes = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        for a, b in _text_runs(texts):
            keys, counts = gram_keys([t or "" for t in texts[a:b]])
            sizes[a:b] = counts
            if len(keys) and self.models:
                grams, inverse = np.unique(keys, return_inverse=True)
                logs = self._scores(grams)
                some = np.flatnonzero(counts)
                start = (np.cumsum(counts) - counts)[some]
                for k in range(len(self.models)):
                    sums[a + some, k] = np.add.reduceat(logs[inverse, k], start)
        return sums, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        return self.decide(*self.likelihoods(texts))

    def decide(self, sums: np.ndarray, sizes: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) from the results of ``likelihoods``."""
        if not self.langs:
            return [UNKNOWN] * len(sizes), np.zeros(len(sizes)), np.ones(len(sizes), bool)
        best, some = sums.argmax(axis=1), sizes > 0
        score = np.where(some, _softmax(sums * self.temper)[np.arange(len(sizes)), best], 0.0)
        entropy = -sums.max(axis=1) / np.maximum(sizes, 1)
        return ([self.langs[k] if s else UNKNOWN for k, s in zip(best.tolist(), some.tolist())], score,
                ~some | (entropy > self.reject_above))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class GramTables:
    """Models too large to send: (gram, lang, value) tables of each order, from 1 to ``ORDER``."""

    work: Workspace
    shares: list[DataFrame]
    backs: list[DataFrame]
    floor: float

    @classmethod
    def fit(cls, work: Workspace, counts: DataFrame, langs: list[str], alphabet: int) -> GramTables:
        """The sums of ``KneserNey.fit`` as Spark aggregates; ``counts`` is (lang, gram, n) with lang as a number."""
        shares, backs = [], []
        for k in range(ORDER, 0, -1):
            seen = {r.lang: (r.ones, r.twos) for r in counts.groupBy("lang").agg(
                F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()}
            discount = F.element_at(F.array(*[F.lit(_discount(*seen.get(x, (0, 0)))) for x in range(len(langs))]),
                                    F.col("lang") + 1)
            context = F.shiftrightunsigned("gram", 16)
            back = work.write(counts.groupBy("lang", context.alias("context")).agg(
                F.sum("n").alias("total"), F.count("*").alias("kinds")), f"back{k}")
            share = counts.withColumn("context", context).join(back, ["lang", "context"]).select(
                "lang", "gram", (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).alias("value"))
            shares.append(work.write(_by_gram(share), f"share{k}"))
            backs.append(work.write(_by_gram(back.select("lang", F.col("context").alias("gram"),
                                                         (discount * F.col("kinds") / F.col("total")).alias("value"))),
                                    f"weight{k}"))
            # one order down a gram counts the kinds of characters before it
            counts = work.write(counts.groupBy("lang", _lowest("gram", k - 1).alias("gram")).agg(F.count("*").alias("n")),
                                f"count{k - 1}")
        return cls(work, shares[::-1], backs[::-1], 1.0 / max(alphabet, 2))

    def scores(self, grams: DataFrame, n_langs: int) -> DataFrame:
        """(gram, logs): log probabilities of distinct ``grams`` in all languages."""
        led = grams
        for k in range(1, ORDER + 1):
            for name, table, key in (("share", self.shares[k - 1], _lowest("gram", k)),
                                     ("back", self.backs[k - 1], F.shiftrightunsigned(_lowest("gram", k), 16))):
                own = table.select(F.col("gram").alias("key"), F.struct("langs", "vals").alias(f"{name}{k}"))
                led = led.withColumn("key", key).join(own, "key", "left").drop("key")
        floor = self.floor
        names = [f"{name}{k}" for k in range(1, ORDER + 1) for name in ("share", "back")]

        def dense(column, missing):
            out = np.full((len(column), n_langs), missing)
            for k, x in enumerate(column.to_pylist()):
                if x is not None:
                    out[k, x["langs"]] = x["vals"]
            return out

        def run(batches):
            for batch in batches:
                p = np.full((batch.num_rows, n_langs), floor)
                for k in range(ORDER):
                    p = dense(batch.column(1 + 2 * k), 0.0) + dense(batch.column(2 + 2 * k), 1.0) * p
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(np.log(p)), pa.list_(pa.float64()))],
                                                 ["gram", "logs"])

        return led.select("gram", *names).mapInArrow(run, "gram long, logs array<double>")

    def likelihoods(self, texts: DataFrame, n_langs: int) -> DataFrame:
        """``texts`` (row, text) as (row, size, sums): characters scored and log likelihood in each language."""
        row_type = texts.schema["row"].dataType.simpleString()
        name = uuid.uuid4().hex

        def cut(batches):
            for batch in batches:
                column = batch.column(1).to_pylist()
                chunk = [None] * len(column)
                for a, b in _text_runs(column):
                    chunk[a:b] = [uuid.uuid4().hex] * (b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(chunk, pa.string())],
                                                 ["row", "text", "chunk"])

        # written, so that both sides below see the same chunks
        cuts = self.work.write(texts.select("row", "text").mapInArrow(cut, f"row {row_type}, text string, chunk string"),
                               f"texts{name}")

        def listed(batches):
            for batch in batches:
                chunk, column = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for x in dict.fromkeys(chunk):
                    grams = np.unique(gram_keys([t or "" for t, c in zip(column, chunk) if c == x])[0])
                    yield pa.RecordBatch.from_arrays([pa.array([x] * len(grams), pa.string()), pa.array(signed(grams))],
                                                     ["chunk", "gram"])

        needs = self.work.write(cuts.select("chunk", "text").mapInArrow(listed, "chunk string, gram long"), f"needs{name}")
        scores = self.scores(needs.select("gram").distinct(), n_langs)

        def score(rows, grams):
            column = [t or "" for t in rows.column("text").to_pylist()]
            keys = grams.column("gram").to_numpy().view(np.uint64)
            keys, first = np.unique(keys, return_index=True)
            logs = grams.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, n_langs)[first]
            found, sizes = gram_keys(column)
            at = np.searchsorted(keys, found)
            sums = np.zeros((len(column), n_langs))
            some = np.flatnonzero(sizes)
            if len(some):
                start = (np.cumsum(sizes) - sizes)[some]
                for k in range(n_langs):
                    sums[some, k] = np.add.reduceat(logs[at, k], start)
            return pa.table([rows.column("row"), pa.array(sizes.astype(np.int64)), pa.array(list(sums), pa.list_(pa.float64()))],
                            names=["row", "size", "sums"])

        met = needs.join(scores, "gram").groupBy("chunk")
        return cuts.groupBy("chunk").cogroup(met).applyInArrow(score, f"row {row_type}, size long, sums array<double>")


def _lowest(gram: str, k: int) -> Column:
    """The last ``k`` characters of a 4-gram key."""
    return F.col(gram) if k == ORDER else F.col(gram).bitwiseAND(F.lit((1 << (16 * k)) - 1).cast("long"))


def _by_gram(values: DataFrame) -> DataFrame:
    """(gram, langs, vals): one row a gram with its value in each language that has it."""
    both = F.collect_list(F.struct("lang", "value"))
    return values.groupBy("gram").agg(both.alias("both")).select(
        "gram", F.col("both.lang").alias("langs"), F.col("both.value").alias("vals"))


def fit_language_model(docs: DataFrame) -> LanguageModel:
    """Models of all languages from ``docs`` (doc_id, text, lang)."""
    learn = docs.where(remainder() != 1).select("doc_id", "text", "lang")
    work = Workspace(docs.sparkSession, "languages")
    counts = work.write(gram_counts(learn), "counts")
    n_grams = counts.count()
    if n_grams > SENT_GRAMS:
        langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
        alphabet = counts.select(_lowest("gram", 1).alias("last")).distinct().count() + 1
        numbered = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(langs)), "number int, lang string"))
        numbers = counts.join(numbered, "lang").select(F.col("number").alias("lang"), "gram", "n")
        model = LanguageModel(langs, [], tables=GramTables.fit(work, numbers, langs, alphabet))
        return _calibrated(model, learn, work)
    kept = counts.toPandas()
    alphabet = len(np.unique(kept.gram.to_numpy().view(np.uint64) & np.uint64(0xFFFF))) + 1
    langs = sorted(kept.lang.unique().tolist())
    models = []
    for lang in langs:
        own = kept[kept.lang == lang]
        models.append(KneserNey.fit(own.gram.to_numpy().view(np.uint64), own.n.to_numpy(np.float64), alphabet))
    model = LanguageModel(langs, models)
    if langs:
        _calibrated(model, learn, work)
    work.clear()
    return model


def _calibrated(model: LanguageModel, learn: DataFrame, work: Workspace) -> LanguageModel:
    """Set the softmax's factor and the rejection bound from all of ``learn``; the driver gets 41 numbers."""
    langs = model.langs

    def run(batches):
        for batch in batches:
            sums, sizes = model.likelihoods(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(list(sums), pa.list_(pa.float64()))], ["lang", "size", "sums"])

    def rated(batches):
        # the loss of every factor and the cross-entropy of each document in its own language
        for batch in batches:
            sums = batch.column(2).flatten().to_numpy().reshape(-1, len(langs))
            truth = np.array([langs.index(x) for x in batch.column(0).to_pylist()], np.int64)
            rows = np.arange(len(sums))
            losses = np.stack([-np.log(np.maximum(_softmax(sums * f)[rows, truth], 1e-12)) for f in FACTORS], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([losses.sum(axis=0)], pa.list_(pa.float64())),
                 pa.array([-sums[rows, truth] / batch.column(1).to_numpy()], pa.list_(pa.float64()))], ["losses", "entropies"])

    own = learn.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    if model.tables:
        scored = model.tables.likelihoods(own.withColumnRenamed("lang", "row"), len(langs)).withColumnRenamed("row", "lang")
    else:
        scored = own.mapInArrow(run, "lang string, size long, sums array<double>")
    found = work.write(scored.where("size > 0").select("lang", "size", "sums")
                       .mapInArrow(rated, "losses array<double>, entropies array<double>"), "calibration")
    losses = [r.loss for r in found.select(F.posexplode("losses").alias("place", "loss")).groupBy("place")
              .agg(F.sum("loss").alias("loss")).orderBy("place").collect()]
    if not losses:
        return model
    model.temper = float(FACTORS[int(np.argmin(losses))])
    model.reject_above = float(quantile_table(found.select(F.explode("entropies").alias("entropy")), [], ["entropy"],
                                              [KEPT_SHARE], ["bound"]).first()["bound"])
    return model


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row of ``docs``."""

    def run(batches):
        for batch in batches:
            lang, score, rejected = model.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(), F.col("text").cast("string").alias("text"))
    if model.tables is None:
        return rows.mapInArrow(run, schema)

    langs, temper, reject_above = model.langs, model.temper, model.reject_above

    def decide(batches):
        final = LanguageModel(langs, [], temper, reject_above)
        for batch in batches:
            sums = batch.column(3).flatten().to_numpy().reshape(-1, len(langs))
            lang, score, rejected = final.decide(sums, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    held = rows.columns[1]
    found = model.tables.likelihoods(rows.select(F.struct("doc_id", held).alias("row"), "text"), len(langs))
    return found.select("row.doc_id", f"row.{held}", "size", "sums").mapInArrow(decide, schema)
