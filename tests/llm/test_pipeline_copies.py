"""Groups of ten or more copies through the line and near-duplicate stages of the pipeline."""

import random

import cases

import corpus_pipeline
from tidemark.llm import jaccard_join


def both_stages(spark, docs):
    for name in ("line_dedup", "jaccard_join"):
        docs = corpus_pipeline.stage(dict(corpus_pipeline.STAGES)[name](spark, docs, None), f"copies-{name}")
    return sorted((r.doc_id, r.text) for r in docs.collect())


def test_groups_of_copies_leave_one_document(spark):
    rng = random.Random(17)
    exact, near = ([cases.prose(rng, 20) for _ in range(8)] for _ in range(2))
    rows = [(100 + i, "\n".join(exact)) for i in range(12)]
    rows += [(200 + i, "\n".join(near[:3] + [f"own{i} {near[3]}"] + near[4:])) for i in range(12)]
    rows += [(300, " \n"), (301, ""), (302, None), (303, " \t\n" + exact[2].upper() + "\n\n")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], cases.SCHEMA).repartition(3)
    got = both_stages(spark, docs)
    assert [r for r in got if r[0] < 200] == [rows[0]]
    # near copies: the first stays whole, what the others have left is too short
    assert [r for r in got if 200 <= r[0] < 300] == [rows[12]]
    assert [r for r in got if r[0] >= 300] == [(300, " \n"), (301, ""), (302, None)]


def test_one_row_of_each_class(spark):
    rng = random.Random(23)
    a, b, c, d = (cases.prose(rng, 60) for _ in range(4))
    rows = [(4, a, "en")] * 9 + [(4, a, "de"), (7, a, "en"), (7, b, "en"), (8, a.upper() + " x", "en"), (None, a, "en")]  # 7: copy and own text
    rows += [(None, c, "fr"), (None, c, "en"), (9, d, "en"), (None, d, "en"), (10, "", "en"), (10, "", "en"), (11, None, "en"), (12, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for frame in (docs, docs.selectExpr("*", "1 AS _own", "2 AS _number", "3 AS _may", "4 AS _id")):
        kept = jaccard_join.one_of_each(frame)
        assert kept.columns == frame.columns
        got = sorted((tuple(r)[:3] for r in kept.collect()), key=repr)
        assert got == sorted([(4, a, "de"), (7, b, "en"), (None, c, "en"), (9, d, "en"), (10, "", "en"), (11, None, "en"), (12, "", "en")], key=repr)


def test_repeated_rows_with_plain_ids(spark):
    rows = [(i % 3, f"text number {i % 3} with some words more") for i in range(30)] + [(5, "TEXT number 0 with some words more")]
    kept = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == rows[:3]


def test_columns_keep_their_values_in_every_stage(spark):
    rng = random.Random(31)
    rows = [(i, "\n".join([cases.prose(rng, 30), "One common line of all", cases.prose(rng, 40)]), "en", "s", 5) for i in range(14)]
    rows += [(50, rows[3][1], "en", "s", 5), (51, rows[4][1].replace("a", "b", 1), None, "s", 5)]
    names = [*cases.CLASHING, "_rest", "_place", "_target", "n_dropped", "base_failed", "n_tokens", "n_symbols", "Number"]
    names = list({n.lower(): n for n in names}.values())
    docs = spark.createDataFrame(rows, cases.SCHEMA).selectExpr("*", *[f"{7 + k} AS `{n}`" for k, n in enumerate(names)]).repartition(3)
    own = {n: 7 + k for k, n in enumerate(names)}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stage(step(spark, before, "/root/testdata/sf0.001"), f"clash-{name}")
        found = docs.collect()
        assert found, name
        if name == "byte_pairs":
            kept = [n for n in names if n not in ("n_tokens", "token_ids")]
            assert set(docs.columns) == set(before.columns) and all(r.n_tokens == len(r.token_ids) // 4 for r in found)
        else:
            kept = names
            assert docs.columns == before.columns
        assert all(r[n] == own[n] for r in found for n in kept) and all(r.n_chars == 5 for r in found)
    assert sorted(r.doc_id for r in found) == list(range(14))
    assert sum("One common line" in r.text for r in found) == 1
