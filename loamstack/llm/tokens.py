"""Exact token ids by the tokenizers library, put together from memorised pre-tokens.

Both vocabularies cut a text into pre-tokens (a word, a run of digits or signs, white
space) by a pattern of their own and merge only inside them.  For texts of ASCII and
Latin letters that pattern is repeated here with plain character classes, and each
distinct pre-token is given to the library's model once per worker.  In any other text
the runs between single spaces that have other characters are encoded whole by the
library; a space between visible characters begins a pre-token in both vocabularies.
"""

from __future__ import annotations

import os
import re
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from . import memory

#: Memorised pieces in each of two generations per worker.  When the young one is
#: full it becomes the old one; pieces met again move back to the young one.
MEMORY_PIECES = 250_000
#: Longer pieces are not memorised.
MEMORY_CHARACTERS = 64

#: Latin letters without U+0130, whose lower case has a combining mark.
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_SIGN = "!-/:-@\\[-`{-~"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
#: Characters for which the patterns below are those of the vocabularies.
_OTHER = re.compile(f"[^ -~\\t\\n\\r{_LETTER}]")
_BYTE_LEVEL = re.compile(f" ?[{_LETTER}]+|{_SHORT}| ?[0-9]+| ?[{_SIGN}]+|[ \\t\\n\\r]+(?![^ \\t\\n\\r])|[ \\t\\n\\r]+")
_WORD_LEVEL = re.compile(f"[{_LETTER}]+|{_SHORT}|[0-9]|[{_SIGN}]+")
_BREAKS = re.compile(r"(?<=\S)(?= \S)")


def _byte_letters() -> list[str]:
    """The visible letter that stands for each byte in a byte-level vocabulary."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in set(visible) else chr(next(extra)) for b in range(256)]


class Memory(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            out = self.encode(piece)
        if len(piece) <= MEMORY_CHARACTERS:
            if len(self) >= MEMORY_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out


class PieceEncoder:
    """Ids of texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, file: str, path: str | None = None):
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(file))
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.normalizer is not None
        self.cut = (_WORD_LEVEL if self.lower else _BYTE_LEVEL).findall
        self.letters = _byte_letters()
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.pre_tokens = Memory(self._merged)

    def _merged(self, piece: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        if piece.isascii():
            mapped = piece.replace(" ", "\u0120").replace("\n", "\u010a").replace("\t", "\u0109").replace("\r", "\u010d")
        else:
            mapped = "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _run(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        plain = text.lower() if self.lower else text
        if _OTHER.search(plain):
            return self.whole(text)
        return b"".join(map(self.pre_tokens.__getitem__, self.cut(plain)))

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self.whole(text)
        return self._run(text) if not _OTHER.search(text) else b"".join(map(self._run, _BREAKS.split(text)))


_encoders: dict[tuple[str, str | None], PieceEncoder] = {}


def encoder(file: str, path: str | None = None) -> PieceEncoder:
    """One encoder for each worker process and file, as long as the worker has no task of another operator."""
    owner = f"tokens {file}"
    memory.begin(owner)
    memory.hold(owner, _encoders.clear)
    if (file, path) not in _encoders:
        _encoders[file, path] = PieceEncoder(file, path)
    return _encoders[file, path]
