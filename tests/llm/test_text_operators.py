"""Line deduplication, SimHash, repetition rules, licence scans, toxicity: against brute force, and on awkward rows."""

from __future__ import annotations

import random
import re
import time
import zlib

import brute
import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from viewpulse.llm import licenses, line_dedup, oracles, queries, repetition, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.connect(SF), oracles.ORACLES[name]) == []


def test_lines_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = out.collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [known[i].text for i in (1, 2)] == ["", ""] and known[1].n_lines == 1
    # Six documents hold the line; the largest id among them keeps it, those without an id never do.
    assert known[8].text.count("\n") == 1 and known[8].n_dropped == 0
    assert known[7].text == "" and known[7].n_dropped == 2
    assert known[5].text == "Two." and known[6].text == "Three.\n"
    assert sorted(r.text for r in rows if r.doc_id is None) == ["Nobody's other.", "Nobody's."]
    assert line_dedup.dedup_lines(brute.empty_documents(spark)).count() == 0


def test_lines_only_nobody_holds_stay(spark):
    line = "x" * 50
    docs = spark.createDataFrame([(None, f"{line}\n{i}") for i in range(9)], "doc_id bigint, text string")
    assert all(r.n_dropped == 0 for r in line_dedup.dedup_lines(docs, min_docs=1).collect())


def test_very_long_texts_lose_lines_in_linear_time(spark):
    """100,000 lines each, every second one shared: what grew with the square of the lines took ten minutes a document."""
    shared = [f"line {i} that all of the six documents hold, over forty" for i in range(50_000)]
    rows = [(d, "\n".join(x for i, s in enumerate(shared) for x in (s, f"{d} {i}"))) for d in range(6)]
    began = time.monotonic()
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert time.monotonic() - began < 40
    for d, text in rows:
        want = (100_000, 50_000, "\n".join(f"{d} {i}" for i in range(50_000))) if d < 5 else (100_000, 0, text)
        assert (out[d].n_lines, out[d].n_dropped, out[d].text) == want


def test_columns_named_like_the_counts_stay_in_the_pipeline(spark):
    docs = spark.createDataFrame([(1, "a", "own", "mine")], "doc_id bigint, text string, n_lines string, n_dropped string")
    assert corpus_pipeline.line_deduplication(spark, docs, SF).collect() == docs.collect()


def test_simhash_against_all_pairs(spark, given):
    out = {r.doc_id: r for r in queries.op9_simhash(spark, SF).collect()}
    want = brute.components(given)
    assert {i: r.component_id for i, r in out.items()} == want
    assert all(out[i].fingerprint == f"{brute.fingerprint(t):016x}" for i, t in given)


def test_crowded_blocks_lose_no_link(spark):
    """Chains and clouds of fingerprints that share blocks, some far beyond the number for which pairs are made."""
    r = random.Random(5)
    nodes = {0}
    for _ in range(4):
        centre = r.getrandbits(64)
        nodes |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(20, 34)} | {centre}
        step = r.getrandbits(64)
        for _ in range(30):
            step ^= (1 << r.randrange(64)) ^ (1 << r.randrange(64))
            nodes.add(step)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = spark.createDataFrame([(signed(n),) for n in nodes], "fp bigint")
    want = brute.link_components(sorted(nodes), 2)
    for pair_rows in (2, 64):
        got = {x.node: x.root for x in simhash.components(simhash.links(fps, pair_rows=pair_rows)).collect()}
        groups = lambda of: sorted(sorted(n for n in of if of[n] == g) for g in set(of.values()))
        full = {signed(n): got.get(signed(n), signed(n)) for n in nodes}
        assert groups(full) == groups({signed(n): signed(g) for n, g in want.items()})


def test_simhash_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert {by[i].fp for i in (1, 2, 3)} == {0} and {by[i].keeper.doc_id for i in (1, 2, 3)} == {1}
    assert by[10].keeper.doc_id == 9
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    want = brute.similar(sorted(texts.items()))
    assert sorted(i for i in ids if i is not None) == sorted({g for g in want.values()})
    assert ids.count(11) == 1 and 10 not in ids and {2, 3}.isdisjoint(ids)
    assert simhash.near_duplicates(brute.empty_documents(spark)).count() == 0


def test_similar_documents_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    # Long chains of edits and a crowd of copies that each differ from their original in a word.
    r = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    for k in range(300):
        edited = list(words)
        edited[r.randrange(200)] = f"x{k}"
        rows.append((10_000 + k, " ".join(edited)))
        if k % 10 == 0:
            words[r.randrange(200)] = f"y{k}"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.similar(rows)
    for pair_rows in (4, 64):
        got = {x.doc_id: x.keeper.doc_id for x in simhash.similar_documents(docs, pair_rows=pair_rows).collect()}
        wrong = {i for i in want if got[i] != want[i]}
        assert len(wrong) <= 0.002 * len(want), wrong
        assert all(want[got[i]] == want[i] for i in want)


def test_near_dedup_of_the_pipeline_holds_the_links_of_fingerprints(spark):
    """A phrase said thirty times makes the fingerprint, whatever follows; by their sets of shingles such texts are unlike."""
    phrase = " ".join(f"w{k}" for k in range(13))
    said = " ".join([phrase] * 30)
    tail, far = " ".join(f"x{k}" for k in range(16)), " ".join(f"y{k}" for k in range(16))
    whole = " ".join(f"v{k}" for k in range(300))
    texts = {1: said, 2: f"{said} {tail}", 3: f"{said} {far}", 4: whole, 5: f"{whole} z", 6: f"{whole} z", 7: " ".join(f"u{k}" for k in range(50))}
    docs = spark.createDataFrame([*texts.items(), (None, said), (None, f"{said} {tail}")], "doc_id bigint, text string")
    bits = [simhash.fingerprint(texts[i].encode()) for i in (1, 2, 3)]
    assert all(((bits[0] ^ b) & (2**64 - 1)).bit_count() <= 2 for b in bits) and brute.similar(list(texts.items()))[2] == 2
    assert sorted(r.doc_id for r in corpus_pipeline.near_deduplication(spark, docs, SF).collect()) == [1, 4, 7]


def test_similar_pairs_in_a_crowd_of_template_pages(spark, monkeypatch):
    """Pages alike by 0.6 to 0.7 crowd the blocks; pairs of 0.86 among them are found nevertheless, in one chunk or many."""
    r = random.Random(21)
    template = [f"t{k}" for k in range(160)]
    rows = [(i, " ".join([*template, *[f"p{i}x{k}" for k in range(40)]])) for i in range(400)]
    for i in range(50):
        twin = rows[i][1].split()
        twin[185 + r.randrange(5) : 200] = [f"q{i}x{k}" for k in range(12)]
        rows.append((10_000 + i, " ".join(twin)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.similar(rows)
    assert sum(i != k for i, k in want.items()) == 50
    for nodes in (512, 16):
        monkeypatch.setattr(simhash, "CHUNK_NODES", nodes)
        got = {x.doc_id: x.keeper.doc_id for x in simhash.similar_documents(docs).collect()}
        assert sum(got[10_000 + i] == i for i in range(50)) >= 48
        assert all(want[got[i]] == want[i] for i in want)


def test_repetition_against_plain_counts(spark, given):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    out = {r.doc_id: r for r in queries.op7_repetition_rules(spark, SF).collect()}
    for i, t in given:
        assert tuple(out[i][n] for n in names) == brute.repetition(t), i
        assert not (out[i].kept and out[i].base_failed)


def test_repetition_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    out = repetition.measure_repetition(docs).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[9].kept and not by[15].kept
    kept = repetition.keep_by_rules(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in by.items() if r.kept} | ({None} if any(r.kept for r in out if r.doc_id is None) else set())
    assert repetition.measure_repetition(brute.empty_documents(spark)).count() == 0


def test_verdict_on_labelled_rows(spark):
    """Of documents labelled as good nearly all that pass the base rules stay; of the others few do."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = repetition.measure_repetition(docs).join(labels, "doc_id").groupBy("quality").agg(
        F.count_if(~F.col("base_failed")).alias("passed"), F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    by = {r.quality: r for r in rows.collect()}
    assert by[1].kept >= 0.99 * by[1].passed and by[0].kept <= 0.15 * by[0].n


def test_licence_places(spark):
    docs = spark.createDataFrame(
        [
            (1, "Licensed under CC BY-NC 4.0. All rights\nreserved! all rights reserved"),
            (2, "GENERAL public, license; spdx-license-identifier: MIT OR (Apache-2.0 WITH LLVM-exception AND GPL-2.0-only)"),
            (3, "ccby all rights, unreserved"), (4, "SPDX-License-Identifier: AND ("), (5, None),
        ],
        "doc_id bigint, text string",
    )
    a, b, c, d, e = sorted(licenses.scan_licenses(docs).collect())
    assert (a.n_words, a.n_base, a.first_word, a.last_word, a.base_labels) == (13, 3, 2, 10, "cc-by,reserved")
    assert a.labels == "cc-by,cc-by-nc,reserved"
    assert b.n_base == 1 and b.first_word == 0 and b.permissive and b.score == 1.0
    assert b.labels == "gpl,spdx:apache-2.0 with llvm-exception,spdx:gpl-2.0-only,spdx:mit"
    assert c.n_base == 0 and c.first_word is None and c.labels == "" and c.score == 0
    assert d.expressions == [] and d.permissive is None
    assert e.n_words == 0 and e.last_word is None


@pytest.mark.parametrize(
    ("text", "ids", "permissive"),
    [
        ("MIT", ["mit"], True), ("GPL-2.0-only OR MIT", ["gpl-2.0-only", "mit"], True), ("GPL-2.0+ AND MIT", ["gpl-2.0+", "mit"], False),
        ("MIT OR GPL-2.0-only AND ISC", ["mit", "gpl-2.0-only", "isc"], True), ("(MIT OR GPL-2.0-only) AND LGPL-3.0-only", ["mit", "gpl-2.0-only", "lgpl-3.0-only"], False),
        ("GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2.0-only with classpath-exception-2.0"], False), ("MIT */ int x;", ["mit"], True),
        ("MIT and see the file", ["mit"], True), ("Apache-2.0 or later", ["apache-2.0"], True), ("GPL-2.0 with modifications", ["gpl-2.0"], False),
        ("DocumentRef-a:LicenseRef-b OR (MIT AND see", ["documentref-a:licenseref-b"], False), ("GPL-2.0 WITH Linux-syscall-note OR MIT.", ["gpl-2.0 with linux-syscall-note", "mit"], True),
    ],
)
def test_expressions(text, ids, permissive):
    value = licenses.parse_expression(text)
    assert (value.ids, value.permissive) == (ids, permissive)


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "MIT OR", "OR", "GPL-2.0 WITH (A OR B)", "(MIT OR GPL-2.0) WITH Classpath-exception-2.0", "see the file", "(see MIT)", "()", "MIT WITH"])
def test_what_is_no_expression(text):
    assert licenses.parse_expression(text) is None


def test_expressions_are_kept_whole_and_without_prose(spark):
    long = "( " + " OR ".join(f"( LicenseRef-{k}.0 AND MIT )" for k in range(60)) + " )"
    docs = spark.createDataFrame([(1, f"SPDX-License-Identifier: {long} */ int x;\n// spdx-license-identifier: (MIT OR ISC) see the file COPYING\n# SPDX-License-Identifier: Zlib. More")], "doc_id bigint, text string")
    (row,) = licenses.scan_licenses(docs).collect()
    assert row.expressions == [long, "( MIT OR ISC )", "Zlib"]


def test_base_places_against_looking_at_every_word(spark, given):
    """The places of the base phrases by comparing them at every word, on the given texts and on short made ones."""
    r = random.Random(9)
    bits = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "CC", "é", "x\x7fy", "By"]
    rows = given + [(10**6 + i, "".join(r.choice(bits) + r.choice([" ", "-", "\n", ", ", "\x7f"]) for _ in range(r.randint(0, 25)))) for i in range(300)]
    found = {x.doc_id: x for x in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    phrases = {tuple(p.split()): label for p, label in licenses.BASE_PHRASES.items()}
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text or ""))
        places = [(at, label) for at in range(len(words)) for p, label in phrases.items() if tuple(words[at : at + len(p)]) == p]
        starts = [at for at, _ in places]
        want = (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert (found[i].n_words, found[i].n_base, found[i].first_word, found[i].last_word, found[i].base_labels) == want, text


def test_licences_of_awkward_rows(spark, given):
    docs = brute.awkward_documents(spark)
    assert licenses.scan_licenses(docs).count() == docs.count()
    assert licenses.scan_licenses(brute.empty_documents(spark)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op1_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    hits = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.97
    assert hits / sum(r.predicted for r in rows) > 0.95 and hits / sum(r.toxic for r in rows) > 0.85


def test_toxicity_does_not_see_held_out_labels(spark, make, given):
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(docs, x.filter(~toxicity.held_out(F.col("doc_id")))) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights)


def test_toxicity_scores_are_sums_over_ngrams():
    model = toxicity.fit([["idiot", "you"], ["idiot", "the"], ["hello"], ["the", "you"], ["idiot"]], [1, 1, 0, 0, 1])
    for text in ("You IDIOT, you", "hello\x00 the", "", "!!", "日本 idiotic"):
        words = {w for w in brute.re.findall(r"[^\W_]+", text.lower())}
        buckets, _ = toxicity.ngram_buckets(sorted(words), model.ngrams, len(model.weights)) if words else (np.zeros(0, int), None)
        want = 1 / (1 + np.exp(-(model.weights[buckets].sum() + model.bias)))
        assert np.allclose(np.concatenate(list(toxicity.scores([text.encode()], model))), want)


def test_toxicity_without_labels_and_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    out = toxicity.score_documents(docs, model).collect()
    assert len(out) == docs.count() and all(r.score < 1e-9 and r.predicted == 0 for r in out)
    assert toxicity.drop_toxic(docs, model).count() == docs.count()
    assert toxicity.score_documents(brute.empty_documents(spark), model).count() == 0
    odd = spark.createDataFrame([(None, 1), (9, None), (9, 1), (9, 0), (14, 0), (99, 1)], "doc_id bigint, toxic int")
    assert 0 <= toxicity.score_documents(docs, toxicity.train(docs, odd)).agg(F.max("score")).first()[0] <= 1
