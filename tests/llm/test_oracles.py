"""The queries that SQL can express, against DuckDB; and the pipeline, stage by stage."""

import re

import oracle
import pytest

import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF), QUERIES[name], ORACLES[name], SF) is None


def test_stages(spark):
    from test_near_copies import brute, leaks
    from test_rules_and_models import brute_kept
    from test_tokens import expected
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for name, step in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.stage(step(spark, frames[-1], SF), f"test-{name}"))
    before, ruled, lines, single, clean, ids = [{r.doc_id: r for r in f.collect()} for f in frames]
    assert all(f.columns == columns for f in frames[:-1])
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert set(ruled) == {r[0] for r in brute_kept([(i, r.text, r.lang) for i, r in before.items()], labels) if r[-1]}
    assert all(r == before[i] for i, r in ruled.items())

    def key(line):
        return line.strip("\x20\x09\x0A\x0B\x0C\x0D").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, r in sorted(ruled.items()):
        for line in (r.text or "").split("\n"):
            holders.setdefault(key(line), []).append(i)
    common = {k for k, own in holders.items() if k and len(set(own)) >= corpus_pipeline.COMMON_LINE_DOCS}
    remnants = set()
    for i, r in ruled.items():
        kept, first = [], set()
        for line in (r.text or "").split("\n"):
            k = key(line)
            if k not in common or (holders[k][0] == i and k not in first):
                kept.append(line)
            first.add(k)
        text = "\n".join(kept)
        if text != (r.text or "") and len(re.findall("[^\x20\x09-\x0D]+", text)) < 50:
            remnants.add(i)
        else:
            assert (lines[i].text or "") == text
    assert set(lines) == set(ruled) - remnants
    classes = brute([(i, r.text) for i, r in lines.items()])
    assert set(single) == {i for i, (_, c) in classes.items() if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(clean) == set(single) - {x[0] for x in leaks([(i, r.text) for i, r in single.items()], items)}
    assert {i: bytes(r.token_ids) for i, r in ids.items()} == {i: expected(r.text) for i, r in clean.items()}
    assert all(r.text == clean[i].text for i, r in ids.items()) and 0 < len(ids) < len(before)


def test_run_is_all_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, sf), f"test-{name}")
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    assert all(len(re.findall("[^\x20\x09-\x0D]+", r.text)) >= 50 for r in got.collect())


def test_pipeline_on_awkward_documents(spark):
    import cases
    from test_tokens import expected
    for docs in (cases.documents(spark), cases.no_documents(spark)):
        whole = {r.text for r in docs.collect()}
        for name, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        got = docs.collect()
        assert bool(got) == bool(whole) and len({r.text for r in got}) == len(got)
        assert all(bytes(r.token_ids) == expected(r.text) and len(r.text.split()) >= 50 for r in got)
