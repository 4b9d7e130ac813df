"""The operators of curve packing, token alignment and collocation mining against the libraries and brute force."""

import hashlib
import json
import pathlib
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import blobs, collocations, curve_packing, queries, token_alignment
from tidemark.llm.byte_letters import byte_letters

WORDS, BYTES, PIECES = (P.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
word_library = Tokenizer.from_file(WORDS)
byte_library = Tokenizer.from_file(BYTES)
byte_library.encode_special_tokens = True
piece_library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
encoder = curve_packing.WordEncoder(WORDS)
pair = token_alignment.Pair(BYTES, PIECES, P.PATTERN)
AWKWARD = ["", " ", "it's 12 o'clock", "<|endoftext|> A", "x<|startoftext|>b <|ENDOFTEXT|>", "日本 語 ΑΣ ς Σας", "ä İx \x1c\x85 y", "▁ a▁b", "  two  spaces ",
           "á É ﬁ", "<s>a</s> <unk>", "\n\n\t", "a" * 3000, "ab " * 500, "😀😀 x", "՘ Ᲊ 𐵐x", "\r\n. ,"]


def word_ids(text):
    return word_library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text_has_the_ids_of_the_library(texts):
    assert [np.frombuffer(x, dtype=encoder.width).tolist() for x in encoder.encode([*texts, *AWKWARD])] == [word_ids(x) for x in [*texts, *AWKWARD]]


def test_word_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(curve_packing, "KNOWN_BYTES", 2000)
    coder, rng = curve_packing.WordEncoder(WORDS), random.Random(1)
    for _ in range(20):
        texts = [cases.prose(rng, 30) for _ in range(3)]
        assert [np.frombuffer(x, dtype=coder.width).tolist() for x in coder.encode(texts)] == [word_ids(x) for x in texts]
    assert len(coder.known) < 200


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 3), (4, 2)])
def test_hilbert_keys_lead_from_neighbour_to_neighbour(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = curve_packing.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_sequences_end_at_powers_of_two():
    for total in (0, 1, 7, 2048, 2049, 6143, 10_000):
        ends = curve_packing.sequence_ends(total, 2048)
        assert [0, *ends][-1] == total or total % 2048 == 0
        sizes = np.diff([total // 2048 * 2048, *ends]).tolist()
        assert all(s & (s - 1) == 0 and s < 2048 for s in sizes) and sizes == sorted(set(sizes), reverse=True)


def check_pieces(pieces, docs, length):
    """Every id of every document once, sequences without gaps, full or a power of two long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0 and zlib.crc32(p.ids) >= 0 and len(p.ids) == 4 * p.length
        by_doc[p.tag].append(p)
        by_sequence[p.sequence_id].append(p)
    for tag, text in docs:
        parts = sorted(by_doc.pop(tag), key=lambda p: p.start)
        ids = np.frombuffer(b"".join(p.ids for p in parts), dtype="<u4").tolist()
        assert ids == [*word_ids(text), 1] and {p.doc_tokens for p in parts} == {len(ids)}
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
    assert not by_doc
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
        size = sum(p.length for p in parts)
        assert size == length or size < length and size & (size - 1) == 0


@pytest.mark.parametrize("length", [64, 2048])
def test_packing_keeps_every_id(spark, length):
    docs = cases.documents(spark, clash=True).withColumns({"tag": F.monotonically_increasing_id(), "offset": F.lit(7), "_row": F.lit(7)})
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    packed = curve_packing.pack(docs, WORDS, length=length)
    assert packed.columns == [c for c in docs.columns if c not in ("text", "start", "offset")] + list(curve_packing.RESULT)
    pieces = packed.collect()
    check_pieces(pieces, [(d.tag, d.text) for d in docs.collect()], length)
    assert all(p._row == 7 and p.kept == 7 for p in pieces)
    whole = {r.sequence_id: r for r in curve_packing.sequences(packed).collect()}
    assert sum(r.n_tokens for r in whole.values()) == sum(p.length for p in pieces)
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole.values())


def test_neighbours_share_sequences(spark):
    rng = random.Random(5)
    kinds = [[cases.prose(rng, 1, alphabet) for _ in range(40)] for alphabet in ("abc", "xyz", "mnop")]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(kinds[i % 3], k=60))) for i in range(300)], "doc_id long, text string")
    placed = defaultdict(set)
    for p in curve_packing.pack(docs, WORDS, length=1024).collect():
        placed[p.sequence_id].add(p.doc_id % 3)
    assert sum(len(x) for x in placed.values()) / len(placed) < 1.6  # 3 if the order were by chance


def test_no_documents_to_pack(spark):
    assert curve_packing.pack(cases.no_documents(spark), WORDS).count() == 0


def test_arrays_come_back():
    arrays = [np.array([0, 1, 2**64 - 1], dtype=np.uint64), np.array([], dtype=np.int64), np.zeros(5, dtype=np.int64), np.arange(70_000)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, blobs.expand(blobs.squeeze(*arrays))))


# ---- alignment

letters = byte_letters()
spelled_a = {i: bytes(letters[c] for c in token) for token, i in byte_library.get_vocab().items() if token != "<|endoftext|>"}


def spell_b(i):
    return bytes([int(piece_library.id_to_piece(i)[3:5], 16)]) if piece_library.is_byte(i) else piece_library.id_to_piece(i).replace("▁", " ").encode()


def brute_links(text):
    """(groups, link occurrences) by walking over the bytes."""
    if not text:
        return None
    a, b = byte_library.encode(" " + text, add_special_tokens=False).ids, piece_library.encode(text)
    raw = (" " + text).encode()
    if b"".join(spelled_a[i] for i in a) != raw or b"".join(map(spell_b, b)) != raw:
        return None
    def owners(ids, spell):
        return [k for k, i in enumerate(ids) for _ in spell(i)]
    at_a, at_b = owners(a, spelled_a.get), owners(b, spell_b)
    links = list(dict.fromkeys(zip(at_a, at_b)))
    ends = sorted({n for n in range(1, len(raw) + 1) if n == len(raw) or at_a[n] != at_a[n - 1] and at_b[n] != at_b[n - 1]})
    groups, begin = [], 0
    for end in ends:
        groups.append((sorted(set(at_a[begin:end])), sorted(set(at_b[begin:end]))))
        begin = end
    shown = ";".join(f"{','.join(str(a[k]) for k in x)}|{','.join(str(b[k]) for k in y)}" for x, y in groups)
    return a, b, len(groups), shown, [(a[x], b[y]) for x, y in links]


def brute_alignment(texts):
    found = [brute_links(t) for t in texts]
    count = Counter(pair for f in found if f for pair in set(f[4]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (len(f[0]), len(f[1]), f[2], len(f[4]), sum(count[x] == best[x[0]] for x in f[4]), sum(count[x] for x in f[4]),
             hashlib.sha256(f[3].encode()).hexdigest()) for f in found]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80), st.integers(4, 20))
def test_any_text_is_aligned_as_by_bytes(text, long):
    for t in (text, *AWKWARD[:12]):
        aligned, expected = pair.align(t, long), brute_links(t)
        if expected is None:
            assert aligned is None
            continue
        assert aligned.groups() == expected[3] and aligned.numbers() == (len(expected[0]), len(expected[1]), expected[2], len(expected[4]))
        keys, times = aligned.pairs()
        assert dict(zip([(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in keys], times.tolist())) == Counter(expected[4])


@pytest.mark.parametrize("links,docs_a_block", [(1 << 21, 4096), (50, 2)])
def test_alignment_matches_brute_force(spark, links, docs_a_block):
    texts = [t if t is None or len(t) < 20_000 else t[:20_000] for t in [*cases.texts(), *AWKWARD]] + ["the same text, twice"] * 5
    rows = [(i, t, 7, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a long, _block long").repartition(4)
    aligned = token_alignment.align(docs, BYTES, PIECES, P.PATTERN, block_links=links, block_docs=docs_a_block)
    assert aligned.columns == ["doc_id", "_block", *token_alignment.RESULT]
    got = sorted(aligned.collect())
    assert [tuple(r)[2:] for r in got] == brute_alignment(texts)
    assert [r.doc_id for r in got] == list(range(len(texts))) and {r._block for r in got} == {7}


def test_no_documents_to_align(spark):
    assert token_alignment.align(cases.no_documents(spark), BYTES, PIECES, P.PATTERN).count() == 0


def test_merging_runs_counts_and_finds_the_highest():
    rng = np.random.default_rng(3)
    runs, total = [], Counter()
    for _ in range(20):
        keys = np.unique(rng.integers(0, 6, 15).astype(np.uint64) << np.uint64(32) | rng.integers(0, 5, 15).astype(np.uint64))
        held = rng.integers(1, 9, len(keys))
        runs.append((keys, held))
        total.update(dict(zip(keys.tolist(), held.tolist())))
    highest = {a: max(n for k, n in total.items() if k >> 32 == a) for a in {k >> 32 for k in total}}
    for (keys, _), (counts, best) in zip(runs, token_alignment.merge_runs(runs)):
        assert counts.tolist() == [total[k] for k in keys.tolist()]
        assert best.tolist() == [total[k] == highest[k >> 32] for k in keys.tolist()]


# ---- collocations

def brute_collocations(rows, least, top=2000):
    """rows of (lang, text)."""
    out = []
    for lang in {x or "und" if x is None else x for x, _ in rows}:
        counts, n = Counter(), 0
        for text in [t for x, t in rows if ("und" if x is None else x) == lang]:
            lower = (text or "").translate(cases.LOWER)
            for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
                w = re.findall("[^\x20\x09]+", piece)
                n += len(w)
                counts.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    some = "der die das of course new york city In spite of the fact ñandú Éa b\x00c 😀 x-y".split(" ")
    rows = [(rng.choice(["en", "de", None, "und", ""]), " ".join(rng.choices(some, k=rng.randint(0, 60))).replace(" city", rng.choice([" city", ", city", "\tcity"])))
            for _ in range(120)]
    rows += [("en", "New York City in spite of the fact. " * 40), ("de", "a a a a a a a a"), ("en", None), ("en", ""), ("en", " .\n,\x0b"), ("xx", "once only")]
    return rows + rows[:9]


@pytest.mark.parametrize("least,head,bounds", [
    (30, 1 << 20, collocations.Bounds()), (5, 1 << 20, collocations.Bounds(100, 40, 50)), (5, 3, collocations.Bounds(50, 1 << 20, 20)),
    (2, 0, collocations.Bounds(300, 64, 50))])
def test_collocations_match_brute_force(spark, least, head, bounds):
    rows = phrase_rows()
    docs = spark.createDataFrame([(lang, text, 7, 7) for lang, text in rows], "lang string, text string, h int, f int").repartition(5)
    got = collocations.mine(docs, least=least, head_words=head, bounds=bounds)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, least)


@pytest.mark.parametrize("first", ["curve_packing", "collocations"])
def test_hashes_do_not_depend_on_what_a_worker_imported_first(first):
    code = f"import tidemark.llm.{first}; from tidemark.llm import collocations, curve_packing; " \
           "print(collocations._VALUES.tolist() + curve_packing._PARTS.tolist())"
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=pathlib.Path(collocations.__file__).parents[2])
    assert json.loads(told.stdout) == collocations._VALUES.tolist() + curve_packing._PARTS.tolist()


def test_top_collocations(spark):
    rows = phrase_rows()
    got = collocations.mine(spark.createDataFrame(rows, "lang string, text string"), least=3, top=4)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 3, 4)


def test_no_documents_to_mine(spark):
    assert collocations.mine(cases.no_documents(spark)).count() == 0


def test_scores_of_large_counts_are_exact(spark):
    big = 9_000_000_000_000_000_000
    counts = spark.createDataFrame([([1], big), ([2], big - 1), ([1, 2], big - 3)], "key array<long>, f long")
    assert [tuple(r) for r in collocations.scored(counts).collect()] == [([1, 2], big - 3, big, big - 1, 2_000_000 * (big - 3) // (2 * big - 1))]


def test_count_joins_are_merge_joins(spark):
    counts = spark.createDataFrame([([1], 5)], "key array<long>, f long")
    plan = collocations.independent(collocations.scored(counts))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 3 and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" not in plan


# ---- queries

def test_queries_match_brute_force_on_a_table(spark, tmp_path):
    rows = [(i, t if t is None or len(t) < 20_000 else t[:20_000], ("en", "de", None)[i % 3]) for i, t in enumerate(cases.texts())]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    pieces = queries.QUERIES["op11_curve_packing"](spark, str(tmp_path)).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == {i: len(word_ids(t)) + 1 for i, t, _ in rows}
    ids = {i: np.array([*word_ids(t), 1], dtype="<u4") for i, t, _ in rows}
    assert all(p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes()) for p in pieces)
    aligned = sorted(queries.QUERIES["op12_token_alignment"](spark, str(tmp_path)).collect())
    assert [tuple(r)[1:] for r in aligned] == brute_alignment([t for _, t, _ in rows])
    mined = queries.QUERIES["op13_collocations"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, mined)) == brute_collocations([(lang, t) for _, t, lang in rows], 30)
