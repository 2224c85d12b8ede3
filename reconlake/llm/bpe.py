"""Byte-level BPE by pre-tokens: a shortcut for whole tokens, merges for the rest.

A text is cut into pre-tokens and each pre-token is merged by itself, so equal pre-tokens have
equal ids wherever they stand. A space before a character that is no white space always starts a
pre-token, so what lies between two such spaces can be looked up as a whole, and only pieces that
were not seen lately are cut and merged.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from dataclasses import dataclass

import numpy as np
import regex

from reconlake.llm import workers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the pre-token pattern of byte-level BPE.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries of a lookup table before its unused half is dropped, and the longest piece it holds.
TABLE_ENTRIES = 300_000
LONGEST_PIECE = 64

_PRE_TOKEN = regex.compile(PRE_TOKEN)
_PIECE_START = re.compile(r"(?= \S)")
_IRREGULAR_SPACE = re.compile(r" (?!\S)")
#: Above these code points the library's Unicode tables may be of another version than regex's.
_NEWER = re.compile("[^\x00-Ԁ]")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next character from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    stand_in = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [stand_in[b] for b in range(256)]


_STAND_INS = dict(enumerate(byte_alphabet()))
_SPACE_STAND_IN = _STAND_INS[0x20]
_LAST_MARKS = frozenset(".,;:!?")


def spelled(piece: str) -> str:
    """A piece of text as the vocabulary spells it."""
    return piece.encode("utf-8").decode("latin-1").translate(_STAND_INS)


@dataclass(frozen=True)
class Vocabulary:
    """What executors need: the tokenizer file, and the vocabulary strings proven to be whole tokens."""

    tokenizer_json: str
    whole: dict[str, int]
    special: tuple[str, ...]
    by_pre_token: bool

    @property
    def key(self) -> int:
        return hash(self.tokenizer_json)


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a tokenizers file and proves, token by token, which strings encode alone as one token.

    A string counts as proven if it is one pre-token and the library encodes it as exactly the
    id that the vocabulary gives it. The size is bounded by the vocabulary.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        text = file.read()
    parts = json.loads(text)
    tokenizer = Tokenizer.from_str(text)
    splitter = parts.get("pre_tokenizer") or {}
    by_pre_token = (
        splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space")
        and parts.get("normalizer") is None
        and parts["model"].get("type") == "BPE"
        and not parts["model"].get("dropout")
    )
    special = tuple(t["content"] for t in parts.get("added_tokens", ()))
    whole: dict[str, int] = {}
    if by_pre_token:
        byte_of = {c: b for b, c in _STAND_INS.items()}
        known = tokenizer.get_vocab(with_added_tokens=False)
        plain = {}
        for name, token in known.items():
            try:
                plain[bytes(byte_of[c] for c in name).decode("utf-8")] = token
            except (KeyError, UnicodeDecodeError):
                continue
        names = [s for s in plain if s not in special and _PRE_TOKEN.findall(s) == [s]]
        for name, encoding in zip(names, tokenizer.encode_batch(names, add_special_tokens=False)):
            if encoding.ids == [plain[name]]:
                whole[name] = plain[name]
    return Vocabulary(text, whole, special, by_pre_token)


class RecentTable(dict):
    """A bounded lookup table; when it is full, what was not used since the last time is dropped."""

    def __init__(self, compute, entries: int = TABLE_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.older = compute, entries, {}

    def drop(self) -> None:
        self.clear()
        self.older = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_PIECE:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class PieceEncoder:
    """Sums or joins a value per pre-token: ``value(ids)`` of its ids, ``total(values)`` of a text's.

    Whole tokens are looked up in the proven set; the library's model merges only the rest. Texts
    with a special token, or with a character on which the two Unicode tables differ, go to the
    library as a whole.
    """

    def __init__(self, vocabulary: Vocabulary, value, total):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.tokenizer_json)
        self.merge = self.tokenizer.model.tokenize
        self.whole, self.by_pre_token = vocabulary.whole, vocabulary.by_pre_token
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or r"(?!)")
        self.value, self.total = value, total
        self.pre_tokens = RecentTable(self._pre_token)
        self.after_space = RecentTable(self._after_space)
        self.at_start = RecentTable(self._piece)
        self.agreed: dict[str, bool] = {}

    def _pre_token(self, pre_token: str):
        known = self.whole.get(pre_token)
        if known is not None:
            return self.value([known])
        return self.value([t.id for t in self.merge(spelled(pre_token))])

    def _after_space(self, piece: str):
        """The value of a space and what follows it."""
        if piece.isalpha():
            # letters are one pre-token
            known = self.whole.get(" " + piece)
            if known is not None:
                return self.value([known])
            name = _SPACE_STAND_IN + piece if piece.isascii() else spelled(" " + piece)
            return self.value([t.id for t in self.merge(name)])
        if piece[-1:] in _LAST_MARKS and piece[:-1].isalpha():
            # so are letters before a mark, and the mark
            return self.total((self.after_space[piece[:-1]], self.pre_tokens[piece[-1]]))
        return self._piece(" " + piece)

    def _piece(self, piece: str):
        return self.total(
            [
                self.after_space[p[1:]] if p[0] == " " and p[1:].isalpha() else self.pre_tokens[p]
                for p in _PRE_TOKEN.findall(piece)
            ]
        )

    def _agree(self, char: str) -> bool:
        found = self.agreed.get(char)
        if found is None:
            probe = f"a{char}1!{char} {char}\n"
            spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)
            found = [probe[s:e] for _, (s, e) in spans] == _PRE_TOKEN.findall(probe)
            if len(self.agreed) < TABLE_ENTRIES:
                self.agreed[char] = found
        return found

    def encode(self, text: str | None):
        if not text:
            return self.total(())
        if (
            not self.by_pre_token
            or self.special.search(text)
            or (_NEWER.search(text) and not all(map(self._agree, set(_NEWER.findall(text)))))
        ):
            return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _IRREGULAR_SPACE.search(text):
            first, *rest = _PIECE_START.split(text)
            pieces = [piece[1:] for piece in rest]
        else:
            first, *pieces = text.split(" ")
        known = list(map(self.after_space.__getitem__, pieces))
        known.insert(0, self.at_start[first])
        return self.total(known)


_ENCODERS: dict[tuple, PieceEncoder] = {}
workers.keeps("bpe", _ENCODERS.clear)


def _encoder(vocabulary: Vocabulary, kind: str, value, total) -> PieceEncoder:
    """One encoder per worker process, kept from task to task."""
    workers.in_use("bpe")
    key = (kind, vocabulary.key)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(vocabulary, value, total)
    return _ENCODERS[key]


def counting_encoder(vocabulary: Vocabulary) -> PieceEncoder:
    return _encoder(vocabulary, "count", len, sum)


def id_encoder(vocabulary: Vocabulary, dtype: str) -> PieceEncoder:
    """Encodes to the little-endian bytes of the ids."""
    return _encoder(vocabulary, dtype, id_bytes(dtype), b"".join)


def id_bytes(dtype: str):
    """A function from ids to their little-endian bytes."""
    code = "H" if dtype == "<u2" else "I"
    if sys.byteorder == "little" and array(code).itemsize == int(dtype[-1]):
        return lambda ids: array(code, ids).tobytes()
    return lambda ids: np.array(ids, dtype).tobytes()
