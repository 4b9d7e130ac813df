import hashlib
from collections import defaultdict

import cases
import pytest

from tidemark.llm import line_dedup


def key(line):
    return line.strip("\x20\x09\x0A\x0B\x0C\x0D").translate(cases.LOWER)


def brute(rows, min_docs):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add((i, t or ""))
    return sorted(((i, len((t or "").split("\n")), sum(bool(key(x)) and len(holders[key(x)]) >= min_docs for x in (t or "").split("\n")),
                    "\n".join(x for x in (t or "").split("\n") if not key(x) or len(holders[key(x)]) < min_docs)) for i, t in rows), key=repr)


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("min_docs", [2, 10])
def test_matches_brute_force(spark, clash, min_docs):
    docs = cases.documents(spark, clash)
    got = line_dedup.dedup_lines(docs, min_docs)
    assert set(docs.columns) <= set(got.columns)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()),
                  key=repr) == brute(rows, min_docs)


def test_first_occurrence_stays(spark):
    docs = spark.createDataFrame([(2, "a\nB "), (1, "x\nb\nb"), (3, "b\ny")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, 2, keep_first=True).collect()}
    assert got == {1: "x\nb", 2: "a", 3: "y"}


def test_bitmap_holds_the_dropped_positions(spark):
    docs = spark.createDataFrame([(i, "\n".join(["u%d" % i] * 70 + ["same"] + [str(i * 1000 + k) for k in range(100)])) for i in range(3)], "doc_id long, text string")
    maps = line_dedup.drop_bitmaps(line_dedup.repeated_lines(docs, 3)).collect()
    assert [r["_drop"] for r in maps] == [[0, 1 << 6]] * 3


def test_only_dataframe_functions(spark):
    plan = line_dedup.dedup_lines(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_empty(spark):
    assert line_dedup.dedup_lines(cases.no_documents(spark)).count() == 0


def test_query_digests_the_kept_text(spark):
    from tidemark.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, dropped, hashlib.sha256(kept.encode()).hexdigest()) for i, n, dropped, kept in brute(texts, 10)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op3_line_dedup"](spark, sf).collect()} == want
