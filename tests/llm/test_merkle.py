"""The Merkle manifest: against SQL, against a plain tree over several levels of superblocks, and on awkward rows."""

from __future__ import annotations

import random
import zlib
from itertools import groupby

import brute
import compare
import pytest

from viewpulse.llm import merkle, oracles, queries

SF = "/root/testdata/sf0.001"


def test_query_matches_sql(spark):
    found = compare.differences(queries.op13_merkle(spark, SF), compare.connect(SF), oracles.ORACLES["op13_merkle"])
    assert found == []


def leaf(doc_id, source, lang, n_chars, text) -> str:
    given = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return brute.sha("".join(given))


def tree(level: list[str]) -> list[list[str]]:
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([brute.sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain(rows: list[tuple]) -> list[tuple]:
    """rows: doc_id, text, lang, source, n_chars."""
    own = [(r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1]), r) for r in rows]
    trees = [list(g) for _, g in groupby(sorted(own, key=lambda t: t[:5]), key=lambda t: t[:2])]
    levels = [tree([t[4] for t in g]) for g in trees]
    last = tree([x[-1][0] for x in levels])
    out = []
    for k, g in enumerate(trees):
        for i, (*_, digest, (doc_id, text, lang, source, n)) in enumerate(g):
            changed = doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            folded = leaf(doc_id, source, lang, n + 1, text) if changed else digest
            proof = ""
            for up, at in ((levels[k], i), (last, k)):
                for level in up[:-1]:
                    beside = level[at ^ 1] if at ^ 1 < len(level) else ""
                    proof += beside
                    folded = brute.sha(beside + folded if at & 1 else folded + beside)
                    at >>= 1
            root = last[-1][0]
            out.append((doc_id, digest, levels[k][-1][0], root, brute.sha(proof), folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_is_the_plain_tree(spark, bits):
    r = random.Random(5)
    langs = [None, "", "a", "Ω", "z", "é"]
    rows = [(i, f"text {r.random()}", r.choice(langs[:4]) if i % 3 else "z", r.choice(["s", None]), r.choice([None, i])) for i in range(83)] + [(500, None, "é", None, None)]
    r.shuffle(rows)
    found = merkle.manifest(spark.createDataFrame(rows, brute.DOCS), bits).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows)
    assert {f.verified for f in found} == {True, False}


def test_manifest_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    rows = [tuple(d) for d in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    most = (1 << 63) - 1
    rows += [(i, "greatest size", "en", "s", most) for i in range(40)]
    more = spark.createDataFrame(rows[-40:], brute.DOCS)
    found = merkle.manifest(docs.select("doc_id", "text", "lang", "source", "n_chars").union(more)).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows)
    assert merkle.manifest(docs).count() == docs.count()
    assert merkle.manifest(brute.empty_documents(spark)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(None, None, None, None, None)], brute.DOCS)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root == brute.sha("-----") and one.proof_sha256 == brute.sha("")
