import base64
import random

import cases
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings, strategies as st

from tidemark.llm import byte_pairs, piece_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
MODEL = P.path("piece_bpe_32k.model")
ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
encoder = byte_pairs.Encoder(RANKS, P.PATTERN)
counter = piece_counts.Counter(MODEL)
pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(text):
    return np.array(library.encode_ordinary(text or ""), dtype="<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text_as_the_library(text):
    assert encoder.encode([text]) == [expected(text)]
    for chunk, overlap in ((8, 2), (50, 20)):
        assert counter.count(text, chunk, overlap) == len(pieces.encode(text))


@pytest.mark.parametrize("alphabet", ["ab", "aab ", "xyxy", "eaea ieio", "ñéü", "0123", " \n\t", "▁ a", "😀a", "<s>"])
def test_repetitive_texts_as_the_library(alphabet):
    rng = random.Random(alphabet)
    for n in (3, 40, 900):
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert encoder.encode([text]) == [expected(text)]
        for chunk, overlap in ((40, 4), (64, 16), (100, 99)):
            assert counter.count(text, chunk, overlap) == len(pieces.encode(text))


def test_small_segments_and_replays_change_nothing(monkeypatch):
    monkeypatch.setattr(byte_pairs, "SEGMENT", 7)
    texts = [t for t in cases.texts() if t is None or len(t) < 100_000]
    assert encoder.encode(texts) == [expected(t) for t in texts]
    words = sorted({w for t in texts for w in encoder.pattern.findall(t or "")})
    for most in (1, 50, 1 << 20):
        counts, ids = byte_pairs.replay_all([w.encode() for w in words], encoder.vocabulary, most)
        assert np.array_equal(ids, [i for w in words for i in library.encode_ordinary(w)]) and counts.sum() == len(ids)


def test_every_token_is_itself():
    some = sorted(ranks)[::7]
    counts, ids = byte_pairs.replay(some, encoder.vocabulary)
    assert (counts == 1).all() and ids.tolist() == [ranks[w] for w in some]


def test_a_vocabulary_that_turns_back(tmp_path):
    """Pairs of a lower rank than the merge that brings them up: one merge at a time, as the library does."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bcd", b"cda", b"ab", b"bc", b"cd", b"abcd", b"da", b"aa", b"aaa"]
    file = tmp_path / "ranks"
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(tokens)))
    own = byte_pairs.Encoder(str(file), P.PATTERN)
    assert own.vocabulary.turning
    theirs = tiktoken.Encoding("turning", pat_str=P.PATTERN, mergeable_ranks={t: r for r, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd") for _ in range(n)) for n in (2, 3, 4, 5, 9, 30, 200) for _ in range(40)]
    assert own.encode(texts) == [np.array(theirs.encode_ordinary(t), dtype="<u4").tobytes() for t in texts]


@pytest.mark.parametrize("bounds", [(50, 4096, 4 << 20), (1 << 20, 2, 100)])
def test_small_blocks_change_nothing(spark, bounds):
    docs = cases.documents(spark)
    words, rows, most = bounds
    got = byte_pairs.encode(docs, RANKS, P.PATTERN, block_words=words, block_docs=rows, replay_bytes=most).collect()
    assert len(got) == docs.count() and all(bytes(r.token_ids) == expected(r.text) for r in got)


def test_texts_are_split_once(spark):
    encoded = byte_pairs.encode(cases.documents(spark), RANKS, P.PATTERN)
    encoded.collect()
    plan = encoded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("MapInArrow split") == 1


@pytest.mark.parametrize("clash", [False, True])
def test_encode_and_decode_documents(spark, clash):
    docs = cases.documents(spark, clash)
    encoded = byte_pairs.encode(docs, RANKS, P.PATTERN)
    back = byte_pairs.decode(encoded, RANKS)
    at_once = byte_pairs.encode(docs, RANKS, P.PATTERN, decoded="decoded")
    assert sorted(at_once.columns) == sorted(back.columns)
    assert sorted(map(repr, at_once.select(back.columns).collect())) == sorted(map(repr, back.collect()))
    assert set(docs.columns) <= set(back.columns)
    got = back.select("text", "token_ids", "decoded").collect()
    assert len(got) == docs.count()
    for r in got:
        assert bytes(r.token_ids) == expected(r.text) and bytes(r.decoded) == (r.text or "").encode()


@pytest.mark.parametrize("clash", [False, True])
def test_count_documents(spark, clash):
    docs = cases.documents(spark, clash)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").filter("doc_id > 5").collect()}
    got = piece_counts.count_tokens(docs, MODEL, chunk=1000, overlap=50).filter("doc_id > 5").collect()
    assert all(r.n_tokens == len(pieces.encode(texts[r.doc_id] or "")) for r in got) and len(got) >= len(texts)


def test_no_stable_boundary_widens_to_the_whole_text():
    text = "a" * 3000
    assert counter.count(text, 100, 10) == len(pieces.encode(text))


def test_empty(spark):
    docs = cases.no_documents(spark)
    assert byte_pairs.decode(byte_pairs.encode(docs, RANKS, P.PATTERN), RANKS).count() == 0
    assert piece_counts.count_tokens(docs, MODEL).count() == 0


def test_queries_on_whole_table(spark):
    from hashlib import sha256

    from tidemark.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    four = QUERIES["op4_byte_pairs"](spark, sf).collect()
    assert len(four) == len(texts)
    for r in four:
        ids = expected(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, sha256(ids).hexdigest(), sha256(texts[r.doc_id].encode()).hexdigest())
    eight = QUERIES["op8_piece_counts"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in eight} == {
        i: (len(t.encode()), n := len(pieces.encode(t)), n > 4096) for i, t in texts.items()}
