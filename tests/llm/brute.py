"""Plain versions of what the operators compute, and tables of awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE = " \t\n\x0b\x0c\r"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def awkward_documents(spark):
    """Null, empty, blank, repeated and very long texts; missing and repeated ids; columns named like internal ones."""
    line = "A line that many documents share, longer than forty characters."
    long = "\n".join(" ".join(f"w{(12 * i + j) * 7919 % 99991}" for j in range(12)) for i in range(6000))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, f"{line}\nOne."), (5, f"  {line.upper()} \nTwo."), (6, f"{line}\nThree.\n"), (7, f"{line}\n{line}"),
        (8, f"x\n{line}"), (9, long), (10, long), (None, f"{line}\nNobody's."), (None, "Nobody's other."), (11, "same row"), (11, "same row"),
        (12, "İstanbul ΑΣ é 日本   <|endoftext|> it's 12!"), (13, "\x00 \x1c odd"), (14, "one"), (15, "a b c d e " * 400),
    ]
    made = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)
    return made.selectExpr("*", *[f"'x' AS {c}" for c in ("fp", "h1", "line", "pos", "key", "text_hash", "n", "_id", "_d", "part", "score", "ids", "start", "node")])


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def fingerprint(text: str | None) -> int:
    words = words_of(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def link_components(nodes: list[int], max_bits: int) -> dict[int, int]:
    """Smallest linked node of each node, comparing all pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def components(rows: list[tuple]) -> dict:
    """doc_id: smallest doc_id of its component. rows: (doc_id, text)."""
    fps = {i: fingerprint(t) for i, t in rows}
    of = link_components(sorted(set(fps.values())), 2)
    least: dict[int, int] = {}
    for i, f in fps.items():
        least[of[f]] = min(i, least.get(of[f], i))
    return {i: least[of[f]] for i, f in fps.items()}


def similar(rows: list[tuple], least: float = 0.8) -> dict:
    """doc_id: smallest doc_id of its group by the Jaccard similarity of five-word shingles, comparing all pairs."""
    grams = {}
    for i, t in rows:
        words = words_of(lower(t or ""))
        grams[i] = frozenset(" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    root = {i: i for i, _ in rows}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ids = sorted(root)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(grams[a] & grams[b])
            if grams[a] == grams[b] or shared >= least * (len(grams[a]) + len(grams[b]) - shared) > 0:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def dedup_lines(rows: list[tuple]) -> dict:
    """doc_id: (lines, dropped, what is left). rows: (doc_id, text) with distinct ids."""
    key = lambda line: lower(line.strip(SPACE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not (len(key(x)) >= 40 and len(holders[key(x)]) >= 5 and max(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def repetition(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = words_of(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(inside), failed


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
