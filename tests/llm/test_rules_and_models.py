import math
import random
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_model, quality_rules as qr, toxicity
from tidemark.llm.labels import fold, labelled_sample
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_counts(text):
    w = cases.WORD.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(bool(cases.WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines[:2000]))
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(repeated))


def test_counts_match_brute_force():
    for t in cases.texts() + ["a b c a b c a", "x #*$%&|<> x", "l\nl\n\n\nl", "aaa " * 50]:
        assert qr.text_counts(t)[:5] == brute_counts(t)


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.5), (10, 0.3), (400, 0.01), (900, 0.05)):
        for k in {0, 1, n // 20, n // 2, n - 1}:
            exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
            assert qr.binomial_tail(k, n, p) == pytest.approx(exact, abs=1e-11)
    assert qr.binomial_tail(5, 5, 0.1) == 1 and qr.binomial_tail(-1, 5, 0.1) == 0


def test_cutoff_is_certified_or_absent():
    levels = np.arange(10)
    good, bad = np.array([500, 300, 5, 0, 0, 0, 0, 0, 0, 0]), np.array([0, 0, 0, 4, 0, 30, 0, 9, 9, 9])
    assert qr.certified_cutoff(levels, good, bad, good, 0.01, 0.001) == 3  # at 2 good documents would go
    assert qr.certified_cutoff(levels, good // 50, bad, good // 50, 0.01, 0.001) is None  # too few to certify
    assert qr.certified_cutoff(levels, good, bad * 0, good, 0.01, 0.001) is None  # nothing to refuse
    # a cutoff that refuses many certifying documents stops the sequence, though proposing ones look clean
    assert qr.certified_cutoff(levels, good, bad, np.full(10, 100), 0.01, 0.001) is None


def brute_kept(docs, labels):
    """The whole method over plain Python rows."""
    known = {}
    for i, q in labels:
        if i is not None and q is not None:
            known[i] = min(q, known.get(i, 1))
    counts = {k: qr.text_counts(t) for k, (_, t, _) in enumerate(docs)}
    named = {k: dict(zip(qr.COUNTS, c)) for k, c in counts.items()}
    failed = {k: c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for k, c in named.items()}

    def level(k, rule):
        above, below = (named[k][c] for c in qr.RULES[rule])
        return min(qr.STEPS * above // below, qr.TOP) if below else 0
    from zlib import crc32
    used = [(k, s, known[i]) for k, (i, _, s) in enumerate(docs) if i in known and not failed[k]]
    tests = len({s for _, s, _ in used}) * len(qr.RULES)
    cut = {}
    for s in {s for _, s, _ in used}:
        for rule in qr.RULES:
            tally = {}
            for k, own, q in used:
                if own == s:
                    t = tally.setdefault(level(k, rule), [0, 0, 0])
                    certify = crc32(str(docs[k][0]).encode()) % 2 == 0
                    t[2 if certify and q == 1 else 0 if q == 1 else 1] += 1 if q == 1 or not certify else 0
            ordered = sorted(tally)
            cut[s, rule] = qr.certified_cutoff(np.array(ordered), *[np.array([tally[x][c] for x in ordered]) for c in range(3)],
                                               qr.ALPHA / len(qr.RULES), qr.DELTA / tests)
    out = []
    for k, (i, _, s) in enumerate(docs):
        refused = any(cut.get((s, r)) is not None and level(k, r) >= cut[s, r] for r in qr.RULES)
        out.append((i, *counts[k][:5], failed[k], not failed[k] and not refused))
    return out


def test_rules_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.1"  # labels enough to certify
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op5_quality_rules"](spark, sf).collect())
    assert got == sorted(brute_kept(docs, labels))
    marks = dict(labels)
    verdict = {r[0]: r[-1] for r in got if not r[-2]}
    assert sum(not verdict[i] for i in verdict if marks.get(i) == 0) > 50  # the rules do refuse
    assert sum(not verdict[i] for i in verdict if marks.get(i) == 1) <= 0.05 * sum(marks.get(i) == 1 for i in verdict)


@pytest.mark.parametrize("clash", [False, True])
def test_rules_on_awkward_documents(spark, clash):
    docs = cases.documents(spark, clash)
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (8, 1, 0), (8, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    counted = qr.count_texts(docs)
    judged = qr.judge(counted, qr.choose_cutoffs(counted, labels))
    assert judged.count() == docs.count() and judged.filter("base_failed is null or kept is null").count() == 0
    none = qr.count_texts(cases.no_documents(spark))
    assert qr.judge(none, qr.choose_cutoffs(none, labels.limit(0))).count() == 0


def test_machine_learns_an_interaction():
    """Two terms that are harmless alone: no sum of weights tells them apart, their product does."""
    rng = random.Random(4)
    docs, marks = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(toxicity.terms(" ".join(["people"] * a + ["vermin"] * b + rng.choices(["filler", "words", "here"], k=2))))
        marks.append(float(a and b))
    machine = toxicity.fit(docs, np.array(marks))
    assert machine.score("people are vermin") > 0.7
    assert max(machine.score(t) for t in ("people here", "vermin here", "words", "", None)) < 0.3


def test_machine_learns_either_but_not_both():
    """Each term is as common in either class: only their pair tells them apart."""
    rng = random.Random(7)
    docs, marks = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(toxicity.terms(" ".join(["people"] * a + ["vermin"] * b + rng.choices([f"filler{c}" for c in "abcdefgh"], k=4))))
        marks.append(float(a != b))
    machine = toxicity.fit(docs, np.array(marks))
    wrong = sum((machine.score(t) >= 0.5) != m for t, m in (("people fillera", 1), ("vermin fillerb", 1), ("people vermin fillerc", 0), ("fillerd", 0)))
    assert len(machine.keys) < 12 and wrong == 0


def test_rows_of_a_repeated_id_come_once(spark):
    texts = [(k, f"{'vile' if k % 2 else 'kind'} words number {'abcdefghij'[k % 10]}") for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    many = docs.unionAll(spark.createDataFrame([texts[3]] * 500, "doc_id long, text string"))
    one, other = (toxicity.train(d, labels, F.lit(True)) for d in (docs, many))
    assert np.array_equal(one.keys, other.keys) and np.allclose(one.weights, other.weights)


def test_folds_never_overlap(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    train = {r["_id"] for r in labelled_sample(ids, "toxic", fold("doc_id", 4) != 2, 1000).collect()}
    from zlib import crc32
    assert train == {i for i in range(200) if crc32(str(i).encode()) % 4 != 2}
    assert labelled_sample(ids, "toxic", fold("doc_id", 4) != 2, 17).count() == 17


@pytest.mark.parametrize("name,mark,folds,rest,least", [("op2_toxicity", "toxic", 4, 2, 0.9), ("op6_quality_model", "quality", 5, 0, 0.98)])
def test_held_out_accuracy(spark, name, mark, folds, rest, least):
    from zlib import crc32
    sf = "/root/testdata/sf0.1"
    got = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % folds == rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.score, r[mark]) for r in got if r.held_out and r[mark] is not None]
    yes, no = np.array([s for s, m in held if m == 1]), np.array([s for s, m in held if m == 0])
    assert (yes[:, None] > no[None]).mean() > least
    assert ((np.array([s for s, _ in held]) >= 0.3) == np.array([m for _, m in held])).mean() > 0.95


@pytest.mark.parametrize("clash", [False, True])
def test_models_on_awkward_documents(spark, clash):
    docs = cases.documents(spark, clash)
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (8, 1, 0), (8, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for module, mark in ((toxicity, "toxic"), (quality_model, "quality")):
        for told in (labels, labels.limit(0)):
            model = module.train(docs, told, F.lit(True), mark)
            got = module.score(docs, model)
            assert set(docs.columns) <= set(got.columns)
            assert got.count() == docs.count() and got.filter("score is null or isnan(score) or score < 0 or score > 1").count() == 0
        none = cases.no_documents(spark)
        assert module.score(none, module.train(none, labels, F.lit(True), mark)).count() == 0


def test_context_cells_cover_every_document(spark):
    docs = cases.documents(spark).select("text")
    cells = {r.cell: r.total for r in quality_model.context_cells(docs).collect()}
    words = [quality_model.buckets(r.text) for r in docs.collect()]
    seen = {c // (quality_model.WIDTH + 1): n for c, n in cells.items() if c % (quality_model.WIDTH + 1) == quality_model.WIDTH}
    assert seen == dict(Counter(np.concatenate(words).tolist()))
