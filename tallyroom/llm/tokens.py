"""Token ids of whole texts, equal to the tokenizers library's, at several times its speed.

A BPE tokenizer encodes each pre-token by itself, and no pre-token goes on over the end of a word
(white space follows a character that is none). Texts of plain characters are therefore cut into
words, each different word is encoded once and its ids are looked up from then on. Texts with any
other character, or with a special token's string, go to the library as a whole. The table of known
words is bounded.

Words met for the first time are cut into pre-tokens and merged by tiktoken, which has the same merge
rule and, given the library's vocabulary as ranks, the same ids; ``check_ranks`` holds that against the
library when an encoder is made, and without agreement the library's own model is asked instead.
"""

from __future__ import annotations

import ctypes
import functools
import json
import re
import struct

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

#: Characters on which our patterns and the library's agree (fixed by Unicode): everything else goes
#: to the library. Precomposed Latin-1 letters are unchanged by NFC and lower-case one to one.
_OTHER = re.compile("[^\\t\\n\\r -~À-ÖØ-öø-ÿ]")
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Pre-token patterns of the two public vocabularies, for plain characters only (fixed values).
_PATTERN = {
    "lower": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+"),
    "bytes": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+"),
}
#: Words between sync points: white space that follows another character starts a new one.
WORD = re.compile(r"\s+\S*|\S+")
#: White space next to a blank: the blank is then not a word's own first character.
_WIDE = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")
KNOWN = 500_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)}


#: Packs so many ids as little-endian unsigned 32-bit integers.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """word -> ids as little-endian unsigned 32-bit bytes; the full table becomes the older half.

    Most different words are rare, so most of the time goes into words that are not here yet.
    """

    def __init__(self, encode, merge, blank: bytes, end: bytes):
        super().__init__()
        self.encode, self.merge, self.blank, self.end, self.older = encode, merge, blank, end, {}

    def __missing__(self, word: str) -> bytes:
        older = self.older
        if word in older:
            ids = older[word]
        elif self.merge and word.isalpha():  # one pre-token
            ids = _packed(self.merge(self.blank + word.encode() + self.end))
        else:
            ids = self.encode(word)
        if len(self) >= KNOWN // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """``ids(text)`` gives what ``Tokenizer.encode(text, add_special_tokens=False).ids`` gives."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "lower" if self.tokenizer.normalizer is not None else "bytes"
        self.pattern = _PATTERN[self.kind]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._end = b"\xff" if self.kind == "lower" else b""
        self._letters = _byte_letters()
        self._model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            self._merge = self._ranks(json.load(f)["model"]["vocab"])
        self._blank = "" if self.kind == "lower" else " "
        self._marks = {m: self._encode_word(m) for m in ",.!?;:"}
        self.known = _Known(self._new_word, self._merge, self._blank.encode(), self._end)

    def _ranks(self, vocabulary: dict[str, int]):
        """The vocabulary as byte ranks; a word's end becomes the byte 255, which UTF-8 never uses."""
        back = {c: b for b, c in self._letters.items()}
        ranks = {}
        for token, rank in vocabulary.items():
            end = self._end and token.endswith("</w>") and token != "</w>"
            core = token[:-4] if end else token
            if token not in self.special and all(c in back for c in core):
                ranks[bytes(back[c] for c in core) + (self._end if end else b"")] = rank
        for b in range(256):
            ranks.setdefault(bytes([b]), len(vocabulary) + b)
        merge = tiktoken.Encoding("words", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        piece = merge._core_bpe.encode_single_piece
        return piece if self.check_ranks(piece, ranks) else None

    def check_ranks(self, merge, ranks: dict[bytes, int]) -> bool:
        """Every whole-word entry of the vocabulary, and pairs of entries, by both ways."""
        probe = [t.removesuffix(b"\xff") for t in list(ranks)[256 : 40_000 : 40]]
        words = [w for w in (a + b for a, b in zip(probe, probe[::-1], strict=True)) if w and b"\xff" not in w]
        return all(list(merge(w + self._end)) == self._by_model(w) for w in words)

    def _by_model(self, piece: bytes) -> list[int]:
        return [t.id for t in self._model.tokenize("".join(self._letters[b] for b in piece))]

    def _encode_word(self, word: str) -> bytes:
        """Ids of a word, or of a piece of text between two sync points."""
        if word.isalpha():
            return self._one(word.encode())
        return b"".join([self._one(piece.encode()) for piece in self.pattern.findall(word)])

    def _new_word(self, word: str) -> bytes:
        """Of a word that follows a blank; a mark at its end is a pre-token of its own."""
        if word.isalpha():
            return self._one((self._blank + word).encode())
        if word[-1:] in self._marks and word[:-1].isalpha():
            return self.known[word[:-1]] + self._marks[word[-1]]
        return self._encode_word(self._blank + word)

    def _one(self, piece: bytes) -> bytes:
        ids = self._merge(piece + self._end) if self._merge else self._by_model(piece)
        return _packed(ids)

    def plain(self, text: str) -> bool:
        return _OTHER.search(text) is None and not any(s in text for s in self.special)

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.plain(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if self.kind == "lower":
            return b"".join(map(self.known.__getitem__, text.lower().split()))
        if not text or text[0].isspace() or text[-1].isspace() or any(w in text for w in _WIDE):
            return b"".join(map(self._spaced, WORD.findall(text)))
        first, *words = text.split(" ")
        return self._encode_word(first) + b"".join(map(self.known.__getitem__, words))

    def _spaced(self, word: str) -> bytes:
        if word[0] == " " and len(word) > 1 and not word[1].isspace():
            return self.known[word[1:]]
        return self._encode_word(word)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), dtype="<u4")

    def rest(self) -> None:
        """At the end of a task: forget the older words and give freed memory back, since the worker lives on."""
        self.known.older = {}
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)
