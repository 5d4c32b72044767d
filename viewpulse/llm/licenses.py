"""Licence scans: phrases and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

A text is lower-cased (A-Z) and read as a sequence of words. One automaton holds all notice phrases and the words of the
identifier tag; a pass over the words finds every place of every phrase. Where a tag stands, the rest of its line is parsed
as an expression of identifiers with AND, OR and WITH. One narrow pass without a shuffle; the patterns are a fixed list.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.shipping import in_arrow

#: The base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notice phrases with label and weight of evidence.
NOTICE_PHRASES = {
    "apache license": ("apache", 0.9),
    "apache license version 2 0": ("apache-2.0", 0.95),
    "mit license": ("mit", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "bsd license": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "neither the name of": ("bsd-3-clause", 0.6),
    "isc license": ("isc", 0.9),
    "permission to use copy modify and or distribute this software": ("isc", 0.9),
    "zlib license": ("zlib", 0.9),
    "this software is provided as is without any express or implied warranty": ("zlib", 0.7),
    "boost software license": ("bsl", 0.9),
    "artistic license": ("artistic", 0.9),
    "the unlicense": ("unlicense", 0.7),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.95),
    "do what the fuck you want to public license": ("wtfpl", 0.95),
    "python software foundation license": ("psf", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "mozilla public license version 2 0": ("mpl-2.0", 0.95),
    "subject to the terms of the mozilla public license": ("mpl", 0.95),
    "eclipse public license": ("epl", 0.9),
    "common development and distribution license": ("cddl", 0.9),
    "european union public licence": ("eupl", 0.9),
    "gnu general public license": ("gpl", 0.95),
    "general public license version 2": ("gpl-2.0", 0.95),
    "general public license version 3": ("gpl-3.0", 0.95),
    "lesser general public license": ("lgpl", 0.9),
    "library general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "either version 2 of the license or at your option any later version": ("or-later", 0.8),
    "either version 3 of the license or at your option any later version": ("or-later", 0.8),
    "gnu free documentation license": ("gfdl", 0.9),
    "open database license": ("odbl", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc0 1 0": ("cc0", 0.9),
    "creative commons zero": ("cc0", 0.9),
    "creative commons": ("creative-commons", 0.7),
    "creative commons attribution": ("cc-by", 0.8),
    "public domain": ("public-domain", 0.6),
    "proprietary and confidential": ("proprietary", 0.8),
}
BASE_WEIGHTS = {"cc-by": 0.8, "gpl": 0.9, "reserved": 0.5}
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)", re.IGNORECASE)
#: Identifiers (lower case, without a trailing + or -only / -or-later) that ask for no more than attribution.
PERMISSIVE = frozenset("0bsd apache-2.0 bsd-2-clause bsd-3-clause cc-by-4.0 cc0-1.0 isc mit unlicense zlib".split())

#: Usual licence identifiers in lower case, without a trailing + or -only / -or-later.
IDENTIFIERS = frozenset("""
    0bsd aal afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-1.0-perl artistic-2.0 beerware
    blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 bzip2-1.0.6 cc-by-1.0
    cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0
    cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1
    cecill-b cecill-c cpl-1.0 curl ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0
    gpl-3.0 hpnd icu ijg imlib2 intel ipl-1.0 isc json lgpl-2.0 lgpl-2.1 lgpl-3.0 libpng libtiff lppl-1.3c mit mit-0 mit-cmu mpl-1.0 mpl-1.1
    mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa nist-pd odbl-1.0 ofl-1.1 openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0
    ruby sgi-b-2.0 sissl sleepycat sspl-1.0 tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zlib zpl-2.1
""".split())  # fmt: skip
_REFERENCE = re.compile(r"(documentref-[a-z0-9.\-]+:)?licenseref-[a-z0-9.\-]+")
#: Exceptions bear the word in their name; this one does not.
_EXCEPTION = re.compile(r"[a-z0-9.+\-]*exception[a-z0-9.\-]*|linux-syscall-note")

_SEPARATORS = {c: " " for c in range(128) if not (chr(c).isdigit() or chr(c).isalpha())}
_WORDS = bytes(ord(_SEPARATORS.get(c, chr(c).lower())) if c < 128 else c for c in range(256))
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:\-]+")
_STRENGTH = {"or": 1, "and": 2, "with": 3}


@dataclass
class Expression:
    """Value of a licence expression: the identifiers in it, whether one can comply with permissive terms only, and its own
    words, as written."""

    ids: list[str] = field(default_factory=list)
    permissive: bool = False
    words: list[str] = field(default_factory=list)


def _plain(name: str) -> str:
    return re.sub(r"(\+|-only|-or-later)$", "", name)


def _operand(written: str) -> str | None:
    """The identifier a word is, with marks of prose behind it dropped; None if it is none."""
    word = written.rstrip(".:") or written
    name = word.lower()
    return word if _plain(name) in IDENTIFIERS or _REFERENCE.fullmatch(name) else None


def _apply(op: str, a: Expression, b: Expression) -> Expression:
    if op == "with":
        # An exception only relaxes its licence; the two are kept as one name.
        return Expression([f"{a.ids[0]} with {b.ids[0]}"], a.permissive)
    both = a.permissive and b.permissive if op == "and" else a.permissive or b.permissive
    return Expression([*a.ids, *b.ids], both)


def _words(text: str) -> list[str] | None:
    """The words of the longest expression at the start of a line; None if it is broken.

    Prose ends an expression: it is cut behind the last word at which it was complete. WITH stands between a single licence
    and an exception; after a bracket or before one the line is broken, as it is if it ends in an operator or in a bracket.
    """
    found = _TOKEN.findall(text)
    words: list[str] = []
    whole, depth, operand_next = 0, 0, True
    for at, written in enumerate(found):
        token, before = written.lower(), found[at - 1].lower() if at else ""
        if operand_next and before == "with":
            if token in "()" or len(words) < 2 or words[-2] == ")":
                return None
            word = written.rstrip(".:")
            if not _EXCEPTION.fullmatch(word.lower()):
                break
        elif operand_next:
            if token == "(":
                words.append(token)
                depth += 1
                continue
            if token in _STRENGTH or token == ")":
                return None
            if (word := _operand(written)) is None:
                break
        elif token in _STRENGTH:
            words.append(written)
            operand_next = True
            continue
        elif token == ")" and depth:
            word = token
            depth -= 1
        else:
            break
        words.append(word)
        operand_next = False
        whole = whole if depth else len(words)
    else:
        if operand_next or depth:
            return None
    return words[:whole] or None


def parse_expression(text: str) -> Expression | None:
    """Shunting-yard over AND / OR / WITH and brackets (WITH binds closest, then AND). None if it is not an expression.

    Operands are known licence identifiers or references to own ones (LicenseRef-...).
    """
    out: list[Expression] = []
    ops: list[str] = []

    def reduce_top() -> None:
        op, b, a = ops.pop(), out.pop(), out.pop()
        out.append(_apply(op, a, b))

    words = _words(text)
    for token in map(str.lower, words or ()):
        if token == "(":
            ops.append(token)
        elif token == ")":
            while ops[-1] != "(":
                reduce_top()
            ops.pop()
        elif token in _STRENGTH:
            while ops and ops[-1] != "(" and _STRENGTH[ops[-1]] >= _STRENGTH[token]:
                reduce_top()
            ops.append(token)
        else:
            out.append(Expression([token], _plain(token) in PERMISSIVE))
    while ops:
        reduce_top()
    return Expression(out[0].ids, out[0].permissive, words) if out else None


@cache
def automaton() -> ahocorasick.Automaton:
    found: dict[str, list[tuple[str, float, bool]]] = {}
    for phrase, label in BASE_PHRASES.items():
        found.setdefault(phrase, []).append((label, BASE_WEIGHTS[label], True))
    for phrase, (label, weight) in NOTICE_PHRASES.items():
        found.setdefault(phrase, []).append((label, weight, False))
    found[TAG] = [("", 0.0, False)]
    built = ahocorasick.Automaton()
    for phrase, what in found.items():
        built.add_word(f" {phrase} ", (phrase.count(" "), what))
    built.make_automaton()
    return built


@dataclass
class Scan:
    n_words: int = 0
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base_labels: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    score: float = 0.0
    expressions: list[str] = field(default_factory=list)
    permissive: bool | None = None


def scan_text(text: bytes | None) -> Scan:
    scan = Scan()
    words = (text or b"").translate(_WORDS).split()
    scan.n_words = len(words)
    joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
    tagged, index, seen = False, -1, 0
    for end, (spaces, what) in automaton().iter(joined):
        index += joined.count(" ", seen, end)
        seen = end
        for label, weight, base in what:
            if not label:
                tagged = True
                continue
            scan.labels.add(label)
            scan.score = max(scan.score, weight)
            if base:
                start = index - spaces
                scan.n_base += 1
                scan.base_labels.add(label)
                scan.first_word = start if scan.first_word is None else min(start, scan.first_word)
                scan.last_word = start if scan.last_word is None else max(start, scan.last_word)
    if tagged:
        for m in TAG_LINE.finditer(text.decode("utf-8", "replace")):
            value = parse_expression(m[1])
            if value:
                scan.labels.update(f"spdx:{i}" for i in value.ids)
                scan.expressions.append(" ".join(value.words))
                scan.permissive = value.permissive if scan.permissive is None else scan.permissive and value.permissive
                scan.score = 1.0
    return scan


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_()),
])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scans = [scan_text(t.as_py()) for t in batch.column("text").cast(pa.binary())]
        columns = [
            batch.column("doc_id"),
            *[pa.array([getattr(s, c) for s in scans], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
            *[pa.array([",".join(sorted(getattr(s, c))) for s in scans], pa.string()) for c in ("base_labels", "labels")],
            pa.array([s.score for s in scans], pa.float64()),
            pa.array([s.expressions for s in scans], pa.list_(pa.string())),
            pa.array([s.permissive for s in scans], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per document with the places of base phrases, labels, score, expressions and whether they are permissive.

    A null or empty text has no words, null places, empty labels and score 0. Rows without `doc_id` and repeated rows each
    get their row. `expressions` lists the parsed tags; `permissive` is null without one, else true if all of them can be
    complied with on permissive terms. `score` is the strongest evidence: 1 for a parsed tag, less for phrases. Other columns
    are ignored. An empty table gives no rows.
    """
    return in_arrow(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), _scan, SCHEMA)
