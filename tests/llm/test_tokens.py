import functools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from loanlens.llm import huffman, packing, token_files
from loanlens.llm.tokens import PieceEncoder
from tests.llm.conftest import make_documents, words


def encoder():
    return PieceEncoder.get(token_files.VOCABULARY)


@functools.cache
def library():
    """A tokenizer that none of our code has touched."""
    import public_tokenizers
    return Tokenizer.from_file(str(public_tokenizers.path(token_files.VOCABULARY)))


def reference_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


ODD = ["a  b", "  a", " a b ", "\n a", "a \n b", "a\n \n b", "a.\nb.,c. d", "x's, don't.", "a.,;", "...", ". .", "é. b",
       " .\n.,a", "x \ny", "a\n\nb", "\na", "a\n", "1. 2, 3", "word,1 a-b (c) \"d\"", "é́ x", "\x00a \x00b",
       "a b c d", "ABC def.GHI", "你好 世界。 ok", "a's's b'", "'s x", "x' y''. z's' w's", "ab*** cd!! e_f_ (g) [h]", "don't' it's.", "\t\tx y", "tail ", "", "x" * 500,
       "<|endoftext|> at the start", "hello <|endoftext|> world", "at the end <|endoftext|>", "<|endoftext|>",
       "a<|endoftext|><|endoftext|>b <|endoftext|>", "<|endoftext|", "<|endoftext |>", "line\n<|endoftext|>\nline",
       "</s> <s> <pad> <unk> [SEP] <|padding|>"]


@pytest.mark.parametrize("text", ODD)
def test_pieces_give_the_library_ids(text):
    for _ in range(2):
        assert encoder().encode(text).tolist() == reference_ids(text)


def test_random_texts_give_the_library_ids():
    rng = random.Random(1)
    marks = [" ", " ", " ", "\n", ". ", ", ", "  ", "\t", "!? ", "'s ", ".\n", "-", " \n"]
    for _ in range(300):
        text = "".join(w + rng.choice(marks) for w in words(rng, rng.randrange(40)))
        assert encoder().encode(text).tolist() == reference_ids(text)


@pytest.mark.parametrize("counts", [[5], [0, 3, 0], [1, 1], [2 ** k for k in range(30)], list(range(1, 300)), [7] * 64])
def test_code_lengths_are_limited_and_round_trip(counts):
    counts = np.array(counts)
    lengths = huffman.limited_lengths(counts)
    used = lengths[lengths > 0].astype(int)
    assert (lengths > 0).tolist() == (counts > 0).tolist() and used.max() <= huffman.LIMIT
    assert sum(2.0 ** -used) <= 1
    code = huffman.Code(lengths)
    ids = np.random.default_rng(0).choice(np.flatnonzero(counts), 5000).astype(np.uint16)
    payload, at = code.encode(ids)
    sizes = np.array([512] * 9 + [392])
    assert (code.decode(payload, at[::512], sizes) == ids).all()


def test_code_is_optimal_where_the_limit_does_not_bind():
    import heapq
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 50, 200)
    heap, total = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    assert int((counts * huffman.limited_lengths(counts)).sum()) == total


def test_token_files_hold_every_document(spark, odd_documents):
    got = token_files.token_digest(spark, odd_documents).collect()
    rows = odd_documents.select("doc_id", "text").collect()
    key = lambda i: (i is not None, i or 0)
    want = sorted(((r.doc_id, np.array(reference_ids(r.text) + [2], "<u4")) for r in rows), key=lambda x: key(x[0]))
    assert len(got) == len(want)
    got.sort(key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in got] == [i for i, _ in want]
    assert sorted((key(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == \
        sorted((key(i), len(x), zlib.crc32(x.tobytes())) for i, x in want)


def test_token_files_of_an_empty_table(spark, no_documents):
    assert token_files.token_digest(spark, no_documents).collect() == []


def test_blocks_decode_alone_and_ascend(spark, tmp_path):
    rng = random.Random(5)
    docs = make_documents(spark, [" ".join(words(rng, rng.randrange(3000))) for _ in range(200)]).repartition(7)
    path = f"file://{tmp_path}/files"
    token_files.write_token_files(docs, path)
    ids = [i for r in spark.read.parquet(f"{path}/blocks").orderBy("part", "block").collect() for i in r.doc_ids]
    assert ids == sorted(ids) and len(ids) == 200
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_token_files(spark, path).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == reference_ids(r.text) + [2]


def test_first_fit_decreasing_is_that():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1025, 500)
    bins, offsets = packing.first_fit_decreasing(sizes)
    fill = []
    for k in np.argsort(-sizes, kind="stable"):
        place = next((b for b, f in enumerate(fill) if f + sizes[k] <= 1024), len(fill))
        if place == len(fill):
            fill.append(0)
        assert (bins[k], offsets[k]) == (place, fill[place])
        fill[place] += sizes[k]


@pytest.mark.parametrize("group_docs", [5, 8192])
def test_pieces_cover_documents_and_sequences(odd_documents, group_docs):
    got = packing.pack_documents(odd_documents, group_docs=group_docs).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        by_doc.setdefault((r.doc_id is None, r.doc_id), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    want = {}
    for r in odd_documents.select("doc_id", "text").collect():
        want.setdefault((r.doc_id is None, r.doc_id), []).append(reference_ids(r.text) + [0])
    for key, texts in want.items():
        pieces = sorted(by_doc[key])
        assert sum(len(p[1]) for p in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            assert [i for p in pieces for i in p[1]] == texts[0]
            assert all(p[2] == len(texts[0]) for p in pieces)


def test_packing_wastes_little(spark):
    rng = random.Random(9)
    docs = make_documents(spark, [" ".join(words(rng, rng.randrange(700))) for _ in range(600)])
    got = packing.packing_digest(spark, docs).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in got) / (1024 * len(got)) > 0.97


def test_packing_of_an_empty_table(spark, no_documents):
    assert packing.packing_digest(spark, no_documents).collect() == []
