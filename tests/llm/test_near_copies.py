from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from tidemark.llm import decontaminate, jaccard_join
from tidemark.llm.batches import shingle_set, word_hashes
from tidemark.llm.components import components


def brute(rows):
    sets = {i: cases.shingles(t) for i, t in rows}
    holders, parent = defaultdict(list), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in holders[s]).items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_hashes_follow_words():
    for t in cases.texts():
        assert len(shingle_set(t)) == len(cases.shingles(t))
    assert (word_hashes("A bC\x0bd") == word_hashes("\n a  Bc d ")).all() and len(word_hashes(None)) == 0
    long = "word other " * 300_000
    assert (word_hashes(long) == np.tile(word_hashes("word other"), 300_000)).all()


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("sets", [2048, 3])
def test_classes_match_brute_force(spark, clash, sets, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", sets)  # 3: clusters are cut into blocks
    docs = cases.documents(spark, clash).filter("doc_id IS NULL OR text <> 'another text with a used id' OR text IS NULL")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    got = jaccard_join.classify(docs).collect()
    assert len(got) == len(rows) + 1
    want = brute(set(rows))
    assert all((r.n_shingles, r.component_id) == want[r["_id"]] for r in got if r["_id"] is not None)
    assert [r.component_id for r in got if r["_id"] is None] == [None]
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, (_, c) in want.items() if i == c} | {None}


def test_star_of_near_copies(spark):
    """Copies that are linked through their common base only, in one component without all pairs."""
    import random
    rng = random.Random(5)
    words = cases.prose(rng, 130, "abcdefghijkl").split()
    rows = [(1000, " ".join(words))]
    for i in range(60):
        own = list(words)
        for k in rng.sample(range(0, 130, 6), 3):
            own[k] = f"x{i}y{k}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_id"]: (r.n_shingles, r.component_id) for r in jaccard_join.classify(docs).collect()}
    assert got == brute(rows)


def test_tree_never_loses_a_link():
    rng = np.random.Generator(np.random.PCG64(2))
    pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(150)]
    counts, sizes = np.array([jaccard_join.group_counts(s) for s in sets]), np.array([len(s) for s in sets])
    tree = jaccard_join.Tree(counts, sizes)
    for i, s in enumerate(sets):
        found = set(tree.search(counts[i], len(s)).tolist())
        for j, t in enumerate(sets):
            n = len(np.intersect1d(s, t))
            if 100 * n >= 75 * (len(s) + len(t) - n):
                assert j in found


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def leaks(docs, items):
    sets = [(i, cases.shingles(t)) for i, t in items]
    return sorted((d, i, len(s & own), len(s)) for d, t in docs for own in [cases.shingles(t)] for i, s in sets
                  if s and 4 * len(s & own) >= 3 * len(s))


@pytest.mark.parametrize("slice_bytes", [1 << 20, 300])
def test_items_in_documents(spark, slice_bytes):
    docs = cases.documents(spark, clash=True).filter("doc_id is not null")
    base = cases.texts()[8].split()
    items = [(1, " ".join(base[10:40])), (1, " ".join(base[20:36]).upper()), (2, None), (3, ""), (4, "one two three"), (None, " ".join(base[50:80])),
             (5, " ".join(base[5:20] + ["other"] * 30)), (6, " ".join(base[40:52] + ["q"])), (7, cases.texts()[-1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_items(docs, bench, slice_bytes=slice_bytes)
    assert set(found.columns) == set(docs.columns)
    got = sorted(((r.doc_id, x.item_id, x.n_shared, x.n_item) for r in found.collect() for x in r.found_items), key=repr)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(leaks(rows, [x for x in items if x[0] is not None]) + [(d, None, n, m) for d, _, n, m in leaks(rows, [(0, items[5][1])])], key=repr)
    assert got == want and got
    clean = decontaminate.without_items(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len([r for r in rows if r[0] not in {g[0] for g in got}
                                                                   or not leaks([r], [(0, t) for _, t in items])])


def test_empty(spark):
    none = cases.no_documents(spark)
    assert jaccard_join.classify(none).count() == 0 and jaccard_join.one_of_each(none).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.without_items(none, bench).count() == 0
    docs = cases.documents(spark)
    assert decontaminate.without_items(docs, bench).count() == docs.count()
