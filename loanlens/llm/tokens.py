"""Token ids of whole texts with a byte-level BPE file of the tokenizers library.

The vocabulary file is a parameter (a path on every executor, or the name of
an installed public vocabulary).  Encoding whole texts costs about one CPU
second for 1.7 MB, nearly all of it for words met before.  Byte-level BPE
never merges across its pre-tokens; a space with no white space beside it
starts one, a line break with none beside it is one, and so is a run of stops
after a letter.  So a text is cut there, each piece is encoded by the
library (a word of letters by its model alone, since it is one pre-token),
the pieces met first are kept in a table, and the text's ids are the pieces'
ids in order.  A text with white space in a row or
at an end, with a very long piece, or with the content of one of the file's
added tokens, goes through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Pieces that a worker keeps (about 100 MB); others are encoded each time.
KEPT_PIECES = 400_000
#: Marks of pieces met once, by their hash.
SLOTS = (1 << 22) - 1
#: Words of letters below this go to the model without the pre-tokens' pattern.
SURE_LETTERS = "\u0530"
#: How a byte-level vocabulary writes the space.
SPACE = "\u0120"
#: Marks that at a piece's end are a pre-token of their own behind a letter (no letter follows an apostrophe there).
STOPS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters of the longest piece that is kept.
LONGEST_PIECE = 200


def vocabulary_path(name: str) -> str:
    """The file of a public vocabulary on this machine; a path stays as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others take the
    letters from U+0100 on, in order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class PieceEncoder:
    """Encodes texts through a table of pieces."""

    _loaded: dict[str, PieceEncoder] = {}

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        # the library looks for these before it cuts a text into pre-tokens
        added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()}, key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.tokenize = self.tokenizer.model.tokenize
        self.written = dict(enumerate(_byte_letters()))
        self.pieces: dict[str, bytes] = {}
        self.seen = bytearray(SLOTS + 1)
        self.tails: dict[str, bytes] = {}
        self.newline = self._bytes("\n")

    @classmethod
    def get(cls, name: str) -> PieceEncoder:
        """One encoder for each worker process and vocabulary."""
        if name not in cls._loaded:
            cls._loaded[name] = cls(name)
        return cls._loaded[name]

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one whole text; none for a null."""
        if not text:
            return np.zeros(0, self.dtype)
        if self.added and self.added.search(text):
            return self._array(self.tokenizer.encode(text, add_special_tokens=False).ids)
        # a line's first piece carries the break before it; the text gets one in front
        parts = ("\n" + text).replace("\n", " \n").split(" ")
        found = list(map(self.pieces.get, parts))
        found[0] = b""
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = ids = self._learn(parts[i])
                    if ids is None:
                        return self._array(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return np.frombuffer(b"".join(found), self.dtype)[1:]

    def _learn(self, part: str) -> bytes | None:
        """Ids of a piece with the space or line break before it; None if the cut isn't certain."""
        if part.isascii() and part.isalpha() and len(part) <= LONGEST_PIECE:
            ids = array(self.code, [t.id for t in self.tokenize(SPACE + part)]).tobytes()
        else:
            ids = self._mixed(part)
            if ids is None:
                return None
        # a piece is kept when it comes a second time
        if len(self.pieces) < KEPT_PIECES:
            slot = hash(part) & SLOTS
            if self.seen[slot]:
                self.pieces[part] = ids
            else:
                self.seen[slot] = 1
        return ids

    def _mixed(self, part: str) -> bytes | None:
        """``_learn`` for pieces with a line break before them, stops after them or other characters."""
        body, before = (part[1:], self.newline) if part[:1] == "\n" else (part, b"")
        stem = body.rstrip(STOPS)
        if stem.isalpha() and len(body) <= LONGEST_PIECE and (stem.isascii() or max(stem) < SURE_LETTERS):
            ids = self.pieces.get(stem) if not before and stem != body else None
            if ids is None:
                ids = before + self._word(stem if before else " " + stem)
            return ids + self._tail(body[len(stem):]) if stem != body else ids
        if not body or len(body) > LONGEST_PIECE or body[0].isspace() or body[-1].isspace():
            return None
        return before + self._bytes(body if before else " " + body)

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token: letters, perhaps with a space before them."""
        written = word.encode().decode("latin-1").translate(self.written)
        return array(self.code, [t.id for t in self.tokenize(written)]).tobytes()

    def _tail(self, stops: str) -> bytes:
        if stops not in self.tails:
            if len(self.tails) > KEPT_PIECES // 10:
                self.tails.clear()
            self.tails[stops] = self._bytes(stops)
        return self.tails[stops]

    def _bytes(self, text: str) -> bytes:
        return self._array(self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _array(self, ids: list[int]) -> np.ndarray:
        return np.array(ids, dtype=self.dtype)
