"""Tokenizing many texts at once: cut into segments, encode each distinct segment once, gather the ids.

Byte-pair encoding never merges across the pieces of a tokenizer's first split. Texts can therefore be cut wherever that
split is certain to cut, whatever stands around, and the ids of a text are those of its segments in order. Cuts are found in
numpy on the bytes of a slice of texts; distinct segments come from a dictionary encoding; each worker remembers the ids of
up to `REMEMBERED` short segments. Where it is not certain (other white space, accents, apostrophes) nothing is cut, and
the longer segment goes through the complete tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

SLICE_BYTES = 4 << 20
REMEMBERED = 1_200_000
SHORT = 48

#: `_WIDE`: first bytes of the characters beyond ASCII that are white space; `_OTHER` and above: beyond ASCII.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER, _WIDE = range(6)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[128:] = _OTHER
_CLASS[[0xC2, 0xE1, 0xE2, 0xE3]] = _WIDE
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASSES = _CLASS.tobytes()


def _kinds(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(_CLASSES), np.uint8)


def _class_cuts(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Cuts between letters, digits and marks, all ASCII; none behind an apostrophe, which may start a contraction."""
    before, after = kinds[:-1], kinds[1:]
    plain = (before != after) & (before != _SPACE) & (after != _SPACE) & (before < _OTHER) & (after < _OTHER)
    cuts = np.zeros(len(data), bool)
    cuts[1:] = plain & (data[:-1] != ord("'"))
    return cuts


def word_cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For tokenizers that drop white space: cuts before white space that follows something else."""
    kinds = _kinds(data)
    cuts = _class_cuts(data, kinds)
    cuts[1:] |= (kinds[1:] == _SPACE) & (kinds[:-1] != _SPACE)
    return cuts


def byte_cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For byte-level tokenizers that join one space to the piece behind it.

    Certain cuts: before a space that something else than white space follows; around a single other white space character.
    """
    kinds = _kinds(data)
    cuts = _class_cuts(data, kinds)
    solid = (kinds != _SPACE) & (kinds < _OTHER)
    follows = np.zeros(len(data), bool)
    follows[:-1] = solid[1:] | (kinds[1:] == _OTHER)
    follows[ends - 1] = False
    cuts |= (data == 32) & follows
    line = (kinds == _SPACE) & (data != 32)
    cuts[1:] |= line[1:] & solid[:-1]
    cuts[2:] |= solid[2:] & line[1:-1] & solid[:-2]
    return cuts


@dataclass(frozen=True)
class Pieces:
    """Distinct segments of a slice of texts (`codes` into `values`), and where each text's segments begin."""

    values: list[bytes]
    codes: np.ndarray
    starts: np.ndarray


def segment(texts: Sequence[bytes], cut: Callable, specials: Sequence[bytes]) -> Pieces:
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    if not len(data):
        return Pieces([], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    filled = bounds[1:][lengths > 0]
    cuts = cut(data, filled)
    if any(s in joined for s in specials):
        # The strings of special tokens are found in the raw text, so such a text stays in one piece.
        for i, t in enumerate(texts):
            if any(s in t for s in specials):
                cuts[bounds[i] : bounds[i + 1]] = False
    cuts[bounds[:-1][lengths > 0]] = True
    at = np.flatnonzero(cuts)
    offsets = np.append(at, len(data)).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    coded = whole.dictionary_encode()
    return Pieces(_byte_strings(coded.dictionary), coded.indices.to_numpy(), np.searchsorted(at, bounds))


def _byte_strings(values: pa.Array) -> list[bytes]:
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1].tolist()
    held = data.to_pybytes()
    return [held[a:b] for a, b in zip(at, at[1:], strict=False)]


def slices(texts: Sequence[bytes | None]) -> Iterator[list[bytes]]:
    """Consecutive texts of about `SLICE_BYTES`; null counts as empty. A longer text is a slice of its own."""
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append(t or b"")
        size += len(part[-1])
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


#: Letters whose lower case and normal form are plain: no rule looks beyond the single character.
PLAIN_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


@cache
def byte_alphabet() -> dict[int, int]:
    """Printable stand-ins for bytes: visible Latin-1 characters for themselves, the others numbered from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in visible)
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(others)}


def spelled(text: str) -> str:
    """A word in the vocabulary's byte alphabet."""
    return text if text.isascii() else text.encode().decode("latin-1").translate(byte_alphabet())


def packed(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


def gather(found: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, from the packed ids of distinct segments; where each text's ids begin."""
    pool = np.frombuffer(b"".join(found), np.uint32)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
    begins = np.cumsum(sizes) - sizes
    each = sizes[pieces.codes]
    ends = np.concatenate(([0], np.cumsum(each)))
    at = np.arange(ends[-1])
    at += np.repeat(begins[pieces.codes] - ends[:-1], each)
    return pool[at], ends[pieces.starts]


class Memo:
    """Remembers what `find` gives for short segments: `most` of them, else `REMEMBERED`."""

    def __init__(self, find: Callable[[bytes], object], most: int | None = None):
        self.find, self.known, self.most = find, {}, most

    def all(self, segments: list[bytes]) -> list:
        """What `find` gives for segments that differ from each other."""
        known, find = self.known, self.find
        out = list(map(known.get, segments))
        for i in [i for i, v in enumerate(out) if v is None]:
            s = segments[i]
            out[i] = v = find(s)
            if len(s) <= SHORT:
                known[s] = v
        if len(known) > (self.most or REMEMBERED):
            known.clear()
        return out


class LibraryEncoder:
    """Ids of texts by the tokenizers library, for files whose first split is one of the two kinds above."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.drops_space = self.tokenizer.normalizer is not None
        self.cut = word_cuts if self.drops_space else byte_cuts
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(self._ids)

    def _ids(self, piece: bytes) -> bytes:
        if not self.drops_space:
            # As below for letters of ASCII, most of what is new; one space at most stands before them.
            spaced = piece[:1] == b" "
            if (piece[1:] if spaced else piece).isalpha():
                return packed([t.id for t in self.model.tokenize(f"Ġ{piece[1:].decode()}" if spaced else piece.decode())])
        text = piece.decode("utf-8", "replace")
        body = text.strip(" \t\n\x0b\x0c\r") if self.drops_space else text.removeprefix(" ")
        if PLAIN_LETTERS.fullmatch(body):
            # One piece of letters: only the model is left to apply.
            word = spelled(body.lower()) if self.drops_space else ("Ġ" if len(body) < len(text) else "") + spelled(body)
            return packed([t.id for t in self.model.tokenize(word)])
        if not body and self.drops_space:
            return b""
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: Sequence[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Slices of consecutive texts: their ids in a row, and where each text's ids begin (one bound more than texts)."""
        for part in slices(texts):
            pieces = segment(part, self.cut, self.specials)
            yield gather(self.memo.all(pieces.values), pieces)


@cache
def library_encoder(path: str) -> LibraryEncoder:
    """One per worker process."""
    return LibraryEncoder(path)
