"""Phrase collocations from count streams in prefix and suffix order.

1. Words are counted by language (64-bit hashes of language and word, which are checked to be different).  Only words with
   ``least`` occurrences can stand in a candidate; the others end a piece.
2. Every phrase of 2 to 4 such words is counted: blocks of texts number their own words, sort their phrases in prefix order
   and write one run an order and radix digit of the phrase.  Runs of a digit meet in one task, are merged by sorting and
   give the phrases with ``least`` occurrences.  As a block counts a phrase before it is shuffled and digits are those of
   whole phrases, no task gets more for a common word or phrase than one record a block.
3. The phrases' counts, with those of single words, are one stream.  In prefix order (sorted by a phrase's first words)
   and in suffix order (by its last words) it is joined with itself by sort-merge joins, in lockstep and without hash tables:
   the left and right counts of every cut, and the longer candidates that hold a phrase.
4. Scores are whole numbers of decimals of 38 digits.

Numbers of the ``HEAD`` most frequent words are sent to the tasks (8 bytes each, 8 MB at most).  If more words are frequent,
the others go by their hashes and none ends a piece, which gives the same result with larger runs.

Null and empty texts have no words; a null language is ``und``.  Repeated rows count as often as they stand there; an empty
table gives no rows.  Long texts are taken in blocks that look ahead as far as a phrase reaches.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.batches import in_batches, mix
from tidemark.llm.blobs import expand, squeeze
from tidemark.llm.word_arrays import table, words
from tidemark.workspace import new_folder, stage

LEAST, LONGEST, TOP = 30, 4, 2000
HEAD = 1 << 20
LEAST_DIGITS, MOST_DIGITS = 4, 1024
WORDS_A_DIGIT = 1 << 19
NO_LANGUAGE = "und"
SALTS = 8

@dataclass(frozen=True)
class Bounds:
    """What is held at a time; none of it changes the result."""

    block_words: int = 1 << 19
    text_bytes: int = 1 << 20  # a longer text is taken in parts
    phrases: int = 1 << 20  # phrases of one digit and order before they are summed up


_VALUES = table(b" \t.,;:!?\n\x0b\x0c\r")
_BREAKS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_SEPARATOR = re.compile(rb"[ \t.,;:!?\n-\r]")
_WORD = re.compile(rb"[^ \t.,;:!?\n-\r]+")
_PLACE = np.random.Generator(np.random.PCG64(20240613)).integers(1, 2**64, LONGEST, dtype=np.uint64) | np.uint64(1)
_TAIL = np.uint64(1 << 63)  # marks the hash of a word outside the head; hashes have 63 bits


def parts_of(text: str | None, most: int, longest: int = LONGEST) -> Iterator[tuple[bytes, int]]:
    """Bytes of a text, and how many of them are the part's own; the rest shows the next words."""
    raw = (text or "").encode()
    at = 0
    while at < len(raw):
        cut = _SEPARATOR.search(raw, at + most)
        stop = seen = cut.end() if cut else len(raw)
        for _, word in zip(range(longest - 1), _WORD.finditer(raw, stop)):
            seen = word.end()
        yield raw[at:seen], stop - at
        at = stop


class Block:
    """Words of one language: hashes, piece numbers, whether they are the block's own, and where they stand."""

    def __init__(self):
        self.raw, self.columns, self.pieces, self.held = [], [], 0, 0

    def add(self, texts: list[tuple[bytes, int]], salt: int) -> None:
        """Parts of texts, one behind the other; a line feed between them ends a piece."""
        raw = b"\n".join([t for t, _ in texts])
        hashes, starts, ends = words(raw, _VALUES, _SEPARATOR)
        begins = np.cumsum([0, *[len(t) + 1 for t, _ in texts]])
        part = np.searchsorted(begins, starts, side="right") - 1
        own = starts < (begins[:-1] + [n for _, n in texts])[part]
        breaks = np.flatnonzero(_BREAKS[np.frombuffer(raw, dtype=np.uint8)])
        piece = np.searchsorted(breaks, starts) + self.pieces
        self.pieces += len(breaks) + 1
        self.raw.append(raw)
        self.columns.append((mix(hashes ^ np.uint64(salt)) >> np.uint64(1), piece, own, starts, ends))
        self.held += len(hashes)

    def words(self) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(c) for c in zip(*[c[:3] for c in self.columns]))

    def spelled(self, places: np.ndarray) -> list[str]:
        """The words at some places, A-Z lower-cased."""
        firsts = np.cumsum([0, *[len(c[0]) for c in self.columns]])
        out = []
        for at, k in zip(places.tolist(), (np.searchsorted(firsts, places, side="right") - 1).tolist()):
            _, _, _, starts, ends = self.columns[k]
            i = at - firsts[k]
            out.append(self.raw[k][starts[i]:ends[i]].lower().decode())
        return out


def _blocks(batches, salt: int, bounds: Bounds) -> Iterator[tuple[str, Block]]:
    """Blocks of about ``block_words`` words by language; at most four times as many words wait."""
    waiting: dict[str, Block] = {}
    texts: dict[str, list] = {}

    def take(lang: str) -> None:
        seed = int.from_bytes(hashlib.blake2b(f"{salt} {lang}".encode(), digest_size=8).digest(), "little")
        waiting.setdefault(lang, Block()).add(texts.pop(lang), seed)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lang = NO_LANGUAGE if lang is None else lang
            for part in parts_of(text, bounds.text_bytes):
                texts.setdefault(lang, []).append(part)
                if len(part[0]) >= bounds.text_bytes:
                    take(lang)
                    if waiting[lang].held >= bounds.block_words:
                        yield lang, waiting.pop(lang)
        for lang in list(texts):
            take(lang)
            if waiting[lang].held >= bounds.block_words:
                yield lang, waiting.pop(lang)
        while sum(b.held for b in waiting.values()) > 4 * bounds.block_words:
            most = max(waiting, key=lambda x: waiting[x].held)
            yield most, waiting.pop(most)
    yield from waiting.items()


def count_words(docs: DataFrame, salt: int = 0, bounds: Bounds = Bounds()) -> DataFrame:
    """``h`` (hash), ``lang``, ``word`` and ``f`` (occurrences) of every word of frame (lang, text)."""
    def run(batches):
        for lang, block in _blocks(batches, salt, bounds):
            hashes, _, own = block.words()
            places = np.flatnonzero(own)
            different, first, counts = np.unique(hashes[places], return_index=True, return_counts=True)
            spelled = block.spelled(places[first])
            yield pa.RecordBatch.from_arrays([pa.array(different.astype(np.int64)), pa.array([lang] * len(spelled), type=pa.string()),
                                              pa.array(spelled, type=pa.string()), pa.array(counts.astype(np.int64))], ["h", "lang", "word", "f"])

    counted = in_batches(docs).mapInArrow(run, "h bigint, lang string, word string, f bigint")
    # a block's words are counted already: grouping by the shuffled key alone needs no second exchange
    return counted.repartition("h").groupBy("h", "lang", "word").agg(F.sum("f").alias("f"))


def _vocabulary(docs: DataFrame, bounds: Bounds) -> tuple[DataFrame, int]:
    """Counted words, written once, and the salt by which no two of them share a hash."""
    for salt in range(SALTS):
        vocabulary = stage(count_words(docs, salt, bounds), "collocation-words")
        if vocabulary.groupBy("h").count().filter("count > 1").isEmpty():
            return vocabulary, salt
    raise RuntimeError(f"words share a hash under each of {SALTS} salts")


def phrases_of(numbers: np.ndarray, piece: np.ndarray, own: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order from 2 on: different phrases (a row of word numbers each, in prefix order) and their counts.

    Words follow each other if they are neighbours in one piece; a phrase is counted where its first word is the block's own.
    """
    places = np.arange(len(numbers))
    named, local = np.unique(numbers, return_inverse=True)
    joined = np.zeros(len(numbers), dtype=bool)
    joined[:-1] = piece[:-1] == piece[1:]
    starts, shorter = places, local.astype(np.uint64)  # of the order before: where it begins, and its number there
    number_at = np.zeros(len(numbers), dtype=np.uint64)
    for order in range(2, longest + 1):
        number_at[starts] = shorter
        last = starts + order - 1
        fits = last < len(numbers)
        starts, last = starts[fits], last[fits]
        starts = starts[joined[last - 1]]
        keys = number_at[starts] << np.uint64(32) | local[starts + order - 1].astype(np.uint64)
        different, first, which = np.unique(keys, return_index=True, return_inverse=True)
        counts = np.bincount(which[own[starts]], minlength=len(different))
        shorter = which.astype(np.uint64)
        begins = starts[first]
        counted = counts > 0
        yield named[local[begins[counted][:, None] + np.arange(order)]], counts[counted]


def _runs(docs: DataFrame, head: np.ndarray, complete: bool, salt: int, digits: int, bounds: Bounds) -> DataFrame:
    """(digit, order, blob) of every block: phrases in prefix order with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        known = shared.value
        for _, block in _blocks(batches, salt, bounds):
            hashes, piece, own = block.words()
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            inside = known[at] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
            numbers = np.where(inside, at.astype(np.uint64), hashes | _TAIL)
            if complete:  # others are too rare: they stay as places that end a piece
                piece = piece + np.cumsum(~inside)
                numbers, piece, own = numbers[inside], piece[inside], own[inside]
            for phrases, counts in phrases_of(numbers, piece, own):
                order = phrases.shape[1]
                digit = mix((phrases * _PLACE[:order]).sum(axis=1, dtype=np.uint64)) % np.uint64(digits)
                by_digit = np.argsort(digit, kind="stable")
                found, cuts = np.unique(digit[by_digit], return_index=True)
                rows = np.split(by_digit, cuts[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int32)), pa.array([order] * len(found), type=pa.int32()),
                     pa.array([squeeze(*phrases[r].T, counts[r]) for r in rows] if len(found) else [], type=pa.binary())], ["digit", "order", "blob"])

    return in_batches(docs).mapInArrow(run, "digit int, order int, blob binary")


def summed(phrases: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different phrases in prefix order with the sums of their counts."""
    if not len(phrases):
        return phrases, counts
    columns = list(phrases.T)
    if int(phrases.max()) < 1 << 21:  # three numbers fit in one
        packed = [np.zeros(len(phrases), dtype=np.uint64) for _ in range(0, len(columns), 3)]
        for k, column in enumerate(columns):
            packed[k // 3] = packed[k // 3] << np.uint64(21) | column
        columns = packed
    order = np.argsort(columns[0]) if len(columns) == 1 else np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for column in columns:
        sorted_column = column[order]
        new[1:] |= sorted_column[1:] != sorted_column[:-1]
    first = np.flatnonzero(new)
    return phrases[order[first]], np.add.reduceat(counts[order], first)


def _frequent(runs: DataFrame, head: np.ndarray, least: int, bounds: Bounds) -> DataFrame:
    """Phrases (hashes of their words) with ``least`` occurrences and their counts."""
    shared = runs.sparkSession.sparkContext.broadcast(head)

    def found(blobs: list) -> pa.RecordBatch:
        phrases, counts = summed(*_joined(blobs))
        phrases, counts = phrases[counts >= least], counts[counts >= least]
        known, inner = shared.value, phrases < _TAIL
        hashes = np.where(inner, known[np.where(inner, phrases, 0).astype(np.int64)] if len(known) else 0, phrases & ~_TAIL).astype(np.int64)
        order = hashes.shape[1]
        key = pa.ListArray.from_arrays(pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * order), pa.array(hashes.reshape(-1)))
        return pa.RecordBatch.from_arrays([key, pa.array(counts.astype(np.int64))], ["key", "f"])

    def run(batches):
        group, blobs, held = None, [], 0
        for batch in batches:
            for digit, order, blob in zip(*[c.to_pylist() for c in batch.columns]):
                if (digit, order) != group:
                    if blobs:
                        yield found(blobs)
                    group, blobs, held = (digit, order), [], 0
                *columns, counts = expand(blob)
                blobs.append((np.stack(columns, axis=1), counts))
                held += len(counts)
                if held > bounds.phrases:
                    blobs = [summed(*_joined(blobs))]
                    held = len(blobs[0][1]) // 2  # what stays is summed up again after as much more
        if blobs:
            yield found(blobs)

    sorted_runs = runs.repartition("digit").sortWithinPartitions("digit", "order")
    return in_batches(sorted_runs).mapInArrow(run, "key array<bigint>, f bigint")


def _joined(blobs: list) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate(c) for c in zip(*blobs))


def count_phrases(docs: DataFrame, vocabulary: DataFrame, salt: int, least: int = LEAST, head_words: int = HEAD,
                  bounds: Bounds = Bounds()) -> DataFrame:
    """(key, f): every word and phrase of up to ``LONGEST`` words with ``least`` occurrences; a key is its words' hashes."""
    spark = docs.sparkSession
    frequent = vocabulary.filter(F.col("f") >= least)
    complete = frequent.count() <= head_words
    picked = frequent if complete else frequent.orderBy(F.desc("f"), "h").limit(head_words)
    head = np.sort(picked.select("h").toPandas()["h"].to_numpy(dtype=np.int64).astype(np.uint64))  # 8 bytes a word, head_words at most
    total = vocabulary.agg(F.sum("f")).first()[0] or 0
    digits = min(MOST_DIGITS, max(LEAST_DIGITS, -(-total // WORDS_A_DIGIT)))  # a block writes as many runs an order, at most
    phrases = stage(_frequent(_runs(docs, head, complete, salt, digits, bounds), head, least, bounds), "collocation-phrases")
    return phrases.unionByName(frequent.select(F.array("h").alias("key"), "f"))


def scored(counts: DataFrame) -> DataFrame:
    """(key, a, l, r, score) of each candidate, by its lowest-scoring cut."""
    size = F.size("key")
    cuts = counts.filter(size > 1).select("key", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("key", F.lit(1), F.col("k")).alias("first"), F.slice("key", F.col("k") + 1, F.size("key")).alias("rest"))
    left = counts.select(F.col("key").alias("first"), F.col("f").alias("l")).hint("merge")
    right = counts.select(F.col("key").alias("rest"), F.col("f").alias("r")).hint("merge")
    whole = T.DecimalType(20, 0)
    score = F.expr("(cast(2000000 as decimal(7,0)) * a20) div (l20 + r20)")
    rated = (cuts.join(left, "first").join(right, "rest")
             .withColumns({f"{c}20": F.col(c).cast(whole) for c in "alr"}).withColumn("score", score))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return rated.groupBy("key", "a").agg(lowest).select("key", "a", "cut.l", "cut.r", "cut.score")


def independent(candidates: DataFrame) -> DataFrame:
    """Candidates without those that a longer one holds and nearly always extends."""
    inner = F.expr("""flatten(transform(sequence(2, size(key) - 1), n ->
        transform(sequence(1, size(key) - n + 1), i -> slice(key, i, n))))""")
    extended = (candidates.filter(F.size("key") > 2).select(F.explode(inner).alias("key"), "a")
                .groupBy("key").agg(F.max("a").alias("longer")))
    share = (F.col("longer").cast("decimal(20,0)") * 100) >= (F.col("a").cast("decimal(20,0)") * 80)
    return candidates.join(extended.hint("merge"), "key", "left").filter(F.col("longer").isNull() | ~share).drop("longer")


def mine(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, head_words: int = HEAD,
         bounds: Bounds = Bounds()) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    docs = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    vocabulary, salt = _vocabulary(docs, bounds)
    candidates = stage(scored(count_phrases(docs, vocabulary, salt, least, head_words, bounds)), "collocation-candidates")
    kept = independent(candidates)
    spelled = vocabulary.filter(F.col("f") >= least).select("h", "lang", "word").hint("merge")
    words_at = kept.select("key", "a", "l", "r", "score", F.posexplode("key").alias("at", "h")).join(spelled, "h")
    phrases = words_at.groupBy("key", "a", "l", "r", "score").agg(
        F.min("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    sizes = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    best = phrases.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
