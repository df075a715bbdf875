"""Operator 4: line dedup by pairwise alignment.

1. A document is the sequence of its lines without white space at their
   ends; blank lines are passed over.  From each line on, the shortest run of
   lines with at least ``least`` words is a unit.  Two documents that
   share a block of that many words share a unit, whatever its lines' lengths.
2. A unit of several documents pairs each document with the earliest that has
   it, however many they are, so a group of n documents makes n-1 pairs.
3. Each pair is aligned with patience diff.  Aligned blocks of at least
   ``least`` words are deleted from the later document; this repeats on
   what is left.  When an alignment has no such block, all lines in runs of
   ``least`` words that stand in both, in whatever order, are deleted, until
   the pair shares no unit.

What a document loses depends on itself and on earlier documents that hold
its lines, never on how many documents there are.  A line of fewer words goes
as part of a block; alone it stays, however often it occurs.

A word is a run without white space.  In scripts that put no spaces between
words (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every two characters
count as one.

Units that many documents hold are few, so their leads are sent to the tasks;
the others are joined by a shuffle.  The documents of a lead are dealt into
groups, and its lines go to each group once.

Earlier means the smaller ``doc_id``, nulls last, and among equal ids the row
read first.  The earliest document that has a line always keeps it.

Defined results: null and empty texts stay as they are; a document whose
lines all go has the empty text; rows that repeat are later documents; very
long texts are read in segments of about ``CHUNK`` bytes cut at line breaks; an
empty table gives no rows; a column ``n_removed`` is replaced, other columns
stay whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.storage import Workspace
from loanlens.llm.text import CHUNK, _WHITE, mix64, row_runs, signed, span_hashes, text_bytes, word_marks

MIN_WORDS = 10
#: Units with more than one of so many unit rows are joined by a broadcast; there are fewer of them than this.
HOT_UNITS = 100_000
#: Later documents that share one copy of their lead's lines.
LEAD_GROUP = 256
#: Line numbers of all cuts that are sent to every task (about 16 MB); more are joined by a shuffle.
SENT_LINES = 4_000_000

_LINES = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()),
                       T.StructField("hashes", T.BinaryType()), T.StructField("words", T.BinaryType())])
_UNITS = T.StructType([T.StructField("unit", T.LongType()), T.StructField("uid", T.LongType()),
                       T.StructField("doc_id", T.LongType())])
_BREAK = 10
_BLANKS = np.zeros(256, bool)
_BLANKS[[9, 11, 12, 13, 32]] = True


def _unspaced(block: np.ndarray) -> np.ndarray:
    """Running count of characters of scripts without spaces, by their first two bytes in UTF-8."""
    first = np.flatnonzero((block >= 0xE0) & (block <= 0xF0))
    first = first[first < len(block) - 1]
    lead, second = block[first], block[first + 1]
    own = (((lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB))       # Thai, Lao
           | ((lead == 0xE1) & np.isin(second, [0x80, 0x81, 0x82, 0x9E, 0x9F]))   # Burmese, Khmer
           | ((lead == 0xE3) & (second >= 0x81)) | ((lead >= 0xE4) & (lead <= 0xE9))  # kana, Chinese
           | ((lead == 0xEF) & (second >= 0xA4) & (second <= 0xAB))
           | ((lead == 0xF0) & (second >= 0xA0) & (second <= 0xB3)))
    marks = np.zeros(len(block) + 1, np.int64)
    marks[first[own] + 1] = 1
    return np.cumsum(marks)


def document_lines(column: pa.Array):
    """(hash, words) of every line of each text; a blank line has hash 0."""
    data, offsets = text_bytes(column)
    for a, b in row_runs(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        block = data[lo:hi]
        if b - a > 1 or hi - lo <= CHUNK:
            yield from _run_lines(block, offsets[a:b + 1] - lo)
            continue
        # one long text
        parts = [_long_line(block[i:j]) if j - i > CHUNK else next(_run_lines(block[i:j], np.array([0, j - i])))
                 for i, j in _segments(block)]
        yield np.concatenate([h for h, _ in parts]), np.concatenate([w for _, w in parts])


def _segments(block: np.ndarray):
    """Ranges of a long text between line breaks, of ``CHUNK`` bytes or a longer line."""
    at, end = 0, len(block)
    while True:
        to = end
        if end - at > CHUNK:
            breaks = np.flatnonzero(block[at:at + CHUNK] == _BREAK)
            if len(breaks):
                to = at + int(breaks[-1])
            else:
                for c in range(at + CHUNK, end, CHUNK):
                    breaks = np.flatnonzero(block[c:c + CHUNK] == _BREAK)
                    if len(breaks):
                        to = c + int(breaks[0])
                        break
        yield at, to
        if to == end:
            return
        at = to + 1


def _long_line(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_run_lines`` of one line longer than a block, without eight bytes for each of its own."""
    solid = ~_BLANKS[block]
    if not solid.any():
        return np.zeros(1, np.uint64), np.zeros(1, np.int32)
    begin, end = int(solid.argmax()), len(solid) - int(solid[::-1].argmax())
    inside = ~_WHITE[block[begin:end]]
    words = 1 + np.count_nonzero(inside[1:] & ~inside[:-1])
    # a character is known by its first two bytes, so blocks overlap by one
    dense = sum(int(_unspaced(block[c:min(end, c + CHUNK) + (c + CHUNK < end)])[-1]) for c in range(begin, end, CHUNK))
    return span_hashes(block, np.array([begin]), np.array([end])), np.array([max(words, -(-dense // 2))], np.int32)


def _run_lines(block: np.ndarray, rows: np.ndarray):
    """(hash, words) of the lines of each row of a run."""
    breaks = np.flatnonzero(block == _BREAK)
    # a line begins at a row's start and after a break
    begin = np.sort(np.concatenate([rows[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([rows[1:], breaks]), kind="stable")
    lines = np.searchsorted(breaks, rows[1:]) - np.searchsorted(breaks, rows[:-1]) + 1
    solid = np.cumsum(np.concatenate([[0], ~(_BLANKS[block] | (block == _BREAK))]))
    marks = word_marks(block)
    words = marks[end] - marks[begin]
    # a word that runs on from the row before has no start of its own
    for at in np.unique(rows[(rows > 0) & (rows < len(block))]).tolist():
        if marks[at + 1] == marks[at] and solid[at + 1] > solid[at]:
            words[np.searchsorted(begin, at, side="right") - 1] += 1
    place = np.flatnonzero(np.diff(solid))
    first = np.searchsorted(place, begin)
    last = np.searchsorted(place, end) - 1
    full = last >= first
    begin, end = begin.copy(), end.copy()
    begin[full], end[full] = place[first[full]], place[last[full]] + 1
    end[~full] = begin[~full]
    dense = _unspaced(block)
    words = np.maximum(words, -(-(dense[end] - dense[begin]) // 2))
    hashes = span_hashes(block, begin, end)
    at = 0
    for n in lines.tolist():
        yield hashes[at:at + n], words[at:at + n].astype(np.int32)
        at += n


def units(hashes: np.ndarray, words: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """Distinct hashes of the shortest runs of ``least`` words from each line on."""
    solid = hashes != 0
    hashes, total = hashes[solid], np.concatenate([[0], np.cumsum(words[solid])])
    stop = np.searchsorted(total, total[:-1] + least)
    key, at = np.zeros(len(hashes), np.uint64), np.arange(len(hashes))
    inside = stop <= len(hashes)
    at, stop, where = at[inside], stop[inside], np.flatnonzero(inside)
    while len(at):
        key[where] = mix64(key[where] ^ hashes[at])
        at = at + 1
        more = at < stop
        at, stop, where = at[more], stop[more], where[more]
    return np.unique(key[inside])


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, sorted by the first, with rising second."""
    tails, back, ends = [], [], []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(a: list[int], b: list[int], lo: int, hi: int, start: int, stop: int) -> list[tuple[int, int]]:
    """Lines that occur once in either range; else the rarest common line."""
    seen: dict[int, list[int]] = {}
    for i in range(lo, hi):
        seen.setdefault(a[i], [0, 0, i, -1])[0] += 1
    for j in range(start, stop):
        if b[j] in seen:
            entry = seen[b[j]]
            entry[1] += 1
            if entry[3] < 0:
                entry[3] = j
    common = [e for e in seen.values() if e[1]]
    once = [(e[2], e[3]) for e in common if e[0] == 1 == e[1]]
    if once:
        return _rising(sorted(once))
    if not common:
        return []
    rarest = min(common, key=lambda e: (e[0] + e[1], e[2]))
    return [(rarest[2], rarest[3])]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j) of equal lines, both rising."""
    out, open_ranges = [], [(0, len(a), 0, len(b))]
    while open_ranges:
        lo, hi, start, stop = open_ranges.pop()
        while lo < hi and start < stop and a[lo] == b[start]:
            out.append((lo, start))
            lo, start = lo + 1, start + 1
        while lo < hi and start < stop and a[hi - 1] == b[stop - 1]:
            hi, stop = hi - 1, stop - 1
            out.append((hi, stop))
        if lo == hi or start == stop:
            continue
        i, j = lo, start
        anchors = _anchors(a, b, lo, hi, start, stop)
        if not anchors:
            continue
        for x, y in [*anchors, (hi, stop)]:
            # an anchor opens the range behind it, so that its block grows onward
            open_ranges.append((i, x, j, y))
            i, j = x, y
        # each range but the first begins with its anchor
    return sorted(out)


def _least_runs(lines: list[int], size: dict[int, int], least: int) -> list[tuple[int, int]]:
    """(start, stop) of the shortest runs of ``least`` words from each line on and up to each line.

    Lines without a size break a run.  Each run of ``least`` words or more is
    covered by the shortest ones inside it.
    """
    out, base = [], 0
    while base < len(lines):
        total = [0]
        while base + len(total) <= len(lines) and lines[base + len(total) - 1] in size:
            total.append(total[-1] + size[lines[base + len(total) - 1]])
        if total[-1] >= least:
            for k, before in enumerate(total):
                stop = bisect_left(total, before + least)
                if stop < len(total):
                    out.append((base + k, base + stop))
                if before >= least:
                    out.append((base + bisect_right(total, before - least) - 1, base + k))
        base += len(total)
    return out


def shared_runs(a: list[int], b: list[int], words: list[int], least: int = MIN_WORDS) -> set[int]:
    """Positions of ``b`` in runs of at least ``least`` words that ``a`` has at any place."""
    every = set(a)
    size = {line: n for line, n in zip(b, words) if line in every}
    own = _least_runs(b, size, least)
    if not own:
        return set()
    theirs = {tuple(a[i:j]) for i, j in _least_runs(a, size, least)}
    return {x for i, j in own if tuple(b[i:j]) in theirs for x in range(i, j)}


def common_blocks(a: list[int], b: list[int], words: list[int], least: int = MIN_WORDS) -> set[int]:
    """Positions of ``b`` in aligned blocks of at least ``least`` words."""
    gone: set[int] = set()
    whole = shared_runs(a, b, words, least)
    left = list(range(len(b)))
    while left:
        pairs = patience(a, [b[j] for j in left])
        new: set[int] = set()
        run: list[int] = []
        last = (-2, -2)
        for i, j in [*pairs, (-9, -9)]:
            if (i, j) != (last[0] + 1, last[1] + 1):
                if sum(words[x] for x in run) >= least:
                    new.update(run)
                run = []
            if j >= 0:
                run.append(left[j])
            last = (i, j)
        if not new:
            # what moved crosses the alignment; at last, runs that closed up over cut lines
            new = whole - gone or {left[k] for k in shared_runs(a, [b[j] for j in left], [words[j] for j in left], least)}
        if not new:
            break
        gone |= new
        left = [j for j in left if j not in new]
    return gone


def _line_table(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = list(document_lines(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([h.tobytes() for h, _ in found], pa.binary()),
                 pa.array([w.tobytes() for _, w in found], pa.binary())], ["uid", "doc_id", "hashes", "words"])

    return rows.select("uid", "doc_id", "text").mapInArrow(run, _LINES)


def _unit_table(lines: DataFrame, least: int) -> DataFrame:
    """Units of each document, each once."""

    def run(batches):
        for batch in batches:
            keys = [units(np.frombuffer(h, np.uint64), np.frombuffer(w, np.int32), least)
                    for h, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            yield pa.RecordBatch.from_arrays([pa.array(signed(every)), batch.column(0).take(at), batch.column(1).take(at)],
                                             ["unit", "uid", "doc_id"])

    return lines.mapInArrow(run, _UNITS)


def _pairs(found: DataFrame, work: Workspace) -> DataFrame:
    """(first, uid): each document with the earliest holder of each of its units; ``found`` is written."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    led = found.groupBy("unit").agg(F.min(order).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    led = work.write(led.select("unit", F.col("lead.uid").alias("first"), "n"), "leads")
    hot = F.col("n") > found.count() // HOT_UNITS + 1
    both = found.join(led.where(~hot), "unit").unionByName(found.join(F.broadcast(led.where(hot)), "unit"))
    return work.write(both.where("uid <> first").select("first", "uid").distinct(), "pairs")


def _cuts(pairs: DataFrame, lines: DataFrame, least: int) -> DataFrame:
    """(uid, cut): line numbers that the later document of a pair loses."""

    def run(batches):
        lead = None
        for batch in batches:
            uid, cuts = [], []
            for row in batch.to_pylist():
                own = np.frombuffer(row["hashes"], np.uint64)
                place = np.flatnonzero(own)
                if row["words"] is None:
                    # a group begins with its lead
                    lead = own[place].tolist()
                    continue
                size = np.frombuffer(row["words"], np.int32)[place].tolist()
                gone = common_blocks(lead, own[place].tolist(), size, least)
                if gone:
                    uid.append(row["uid"])
                    cuts.append(place[sorted(gone)].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))],
                                             ["uid", "cut"])

    groups = pairs.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / LEAD_GROUP).alias("groups"))
    leads = (groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
             .join(lines.select(F.col("uid").alias("first"), "hashes"), "first")
             .select("first", "part", F.col("first").alias("uid"), "hashes", F.lit(None).cast("binary").alias("words")))
    later = (pairs.join(groups, "first").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("groups")))
             .join(lines.select("uid", "hashes", "words"), "uid").select("first", "part", "uid", "hashes", "words"))
    dealt = leads.unionByName(later).withColumn("later", F.col("words").isNotNull()).repartition("first", "part")
    return (dealt.sortWithinPartitions("first", "part", "later").select("uid", "hashes", "words")
            .mapInArrow(run, "uid long, cut array<int>"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS, sent_lines: int = SENT_LINES) -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_removed``, the number of lines that went.

    Cuts of up to ``sent_lines`` lines are sent to every task.
    """
    work = Workspace(docs.sparkSession, "lines")
    docs = docs.drop("n_removed")
    rows = work.write(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                                  F.monotonically_increasing_id().alias("uid")), "rows")
    lines = work.write(_line_table(rows.select("uid", F.col("row.doc_id").cast("long").alias("doc_id"),
                                               F.col("row.text").cast("string").alias("text"))), "lines")
    pairs = _pairs(work.write(_unit_table(lines, least), "units"), work)
    work.remove("units", "leads")
    cuts = work.write(_cuts(pairs, lines, least).groupBy("uid")
                      .agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cut")), "cuts")
    work.remove("lines", "pairs")
    # lists of lines that go, a few bytes a line: sent to every task while they are few
    if (cuts.agg(F.sum(F.size("cut") + 4)).first()[0] or 0) <= sent_lines:
        cuts = F.broadcast(cuts)
    return _without_lines(rows.join(cuts, "uid", "left"), docs)


def _without_lines(rows: DataFrame, docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts, removed = [], []
            for text, cut in zip(batch.column(1), batch.column(2)):
                text, cut = text.as_py(), set(cut.as_py() or ())
                if cut:
                    text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in cut)
                texts.append(text)
                removed.append(len(cut))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()),
                                              pa.array(removed, pa.int64())], ["rest", "text", "n_removed"])

    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*[F.col(f"row.{c}").alias(c) for c in others]).alias("rest")
    schema = T.StructType([
        T.StructField("rest", T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema if f.name != "text"])),
        T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())])
    done = rows.select(rest, F.col("row.text").cast("string").alias("text"), "cut").mapInArrow(run, schema)
    return done.select(*[F.col("text") if c == "text" else F.col(f"rest.{c}") for c in docs.columns], "n_removed")


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """The query: every document with its remaining text."""
    return dedup_lines(docs.select("doc_id", "text"))
