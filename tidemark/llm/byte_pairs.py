"""Byte-level BPE by corpus-level merge replay.

1. Texts are split into words by the pattern, in blocks of documents.  A block numbers its own distinct words; its documents'
   word numbers (the body) and its distinct words, one run a radix digit of the word, are shuffled as zstd blobs.
2. The runs of a digit meet in one task, so every distinct word of the corpus is replayed once.  The words lie one behind
   the other as a list of byte tokens with links to their live neighbours.  An inverted index leads from the rank of a
   token pair to the positions where that pair stands; ranks are taken in order, and all merges of a rank are one step that
   touches its neighbours only.  Ids go back to the block of each run.
3. Blocks meet the ids of their words and put the documents' ids together.

Within a word the order is that of the usual encoder: lowest rank first, leftmost among equals, and a word that is a token as
a whole is that token.  Where a merge can bring up a pair of a lower rank, a word makes one merge at a time.

Words are combined per block before they are shuffled, so a word that makes up a third of all text is one record a block.
Memory: a block, the distinct words of a task's digits (as many as the session has shuffle partitions, 1,024 at most) and
``REPLAY_BYTES`` of words at a time.  The shuffle of step 1 is read twice, by steps 2 and 3; a task of step 1 that runs again
must see its documents in the same order, as a scan of files gives them (write documents that come from a shuffle first).

Null texts are empty; an empty text has no ids.  Texts of any length work, also one single long word; an empty table gives no
rows.  Repeated rows are encoded like any other; all further columns pass through unchanged.
"""

from __future__ import annotations

import base64
import functools
import heapq
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.batches import in_batches, slices
from tidemark.llm.blobs import expand, squeeze

BLOCK_WORDS, BLOCK_DOCS = 1 << 19, 4096
REPLAY_BYTES = 1 << 20
LEAST_DIGITS, MOST_DIGITS = 8, 1024
SEGMENT = 1024  # ranks that are sorted into the index at a time
NO_PAIR = np.int32(2**31 - 1)
DOC, BODY, RUN, ANSWER = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: one base64 text and one number a line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


class Vocabulary:
    """Ranks of a rank file, with the rank of every pair of tokens that make up a token."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        found = sorted((left << 32 | right, r) for token, r in self.ranks.items() for cut in range(1, len(token))
                       if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None)
        self.pairs = np.array([key for key, _ in found], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in found], dtype=np.int32)
        # ranks whose token may stand in a pair of a lower rank
        parts = np.maximum(self.pairs >> 32, self.pairs & 0xFFFFFFFF)
        self.turning = frozenset(parts[self.pair_ranks < parts].tolist())

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of token pairs, ``NO_PAIR`` for those that are no token."""
        if not len(self.pairs):
            return np.full(len(left), NO_PAIR)
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], NO_PAIR)


class Index:
    """Positions by the rank of the pair that begins there.  Ranks below ``until`` are sorted, the others wait."""

    def __init__(self, ranks: np.ndarray, places: np.ndarray):
        self.until, self.waiting = 0, [(ranks, places)]
        self.places: dict[int, list[np.ndarray]] = {}
        self.order: list[int] = []

    def add(self, ranks: np.ndarray, places: np.ndarray) -> None:
        near = ranks < self.until
        if near.any():
            self._sort(ranks[near], places[near])
            ranks, places = ranks[~near], places[~near]
        if len(ranks):
            self.waiting.append((ranks, places))

    def _sort(self, ranks: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        for begin, end in zip(cuts, cuts[1:]):
            r = int(ranks[begin])
            if r not in self.places:
                self.places[r] = []
                heapq.heappush(self.order, r)
            self.places[r].append(places[begin:end])

    def lowest(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions, in order, which leave the index."""
        while not self.order:
            if not self.waiting:
                return None
            ranks, places = (np.concatenate(c) for c in zip(*self.waiting))
            self.until = int(ranks.min()) + SEGMENT
            near = ranks < self.until
            self.waiting = [] if near.all() else [(ranks[~near], places[~near])]
            self._sort(ranks[near], places[near])
        r = heapq.heappop(self.order)
        found = self.places.pop(r)
        return r, np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])


def replay(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and all ids one behind the other."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    token = vocabulary.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    n = len(token)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    # place n stands for "none" on either side
    left, right = np.arange(-1, n, dtype=np.int32), np.arange(1, n + 2, dtype=np.int32)
    some = lengths > 0
    left[(ends - lengths)[some]] = n
    right[ends[some] - 1] = n
    rank = np.full(n + 1, NO_PAIR)
    inner = np.flatnonzero(right[:n] < n)
    rank[inner] = vocabulary.rank(token[inner], token[right[inner]])
    whole = [k for k, w in enumerate(words) if w in vocabulary.ranks]
    for k in whole:  # the first byte's place takes the token, the others go
        begin, end = int(ends[k] - lengths[k]), int(ends[k])
        token[begin], token[begin + 1:end] = vocabulary.ranks[words[k]], -1
        rank[begin:end] = NO_PAIR
    begins = np.flatnonzero(rank < NO_PAIR).astype(np.int32)
    if not len(begins):
        alive = token >= 0
        return np.bincount(owner[alive], minlength=len(words)), token[alive]
    index = Index(rank[begins], begins)
    while (lowest := index.lowest()) is not None:
        r, at = lowest
        at = at[rank[at] == r]  # others have changed since
        if not len(at):
            continue
        if r in vocabulary.turning:
            first = np.diff(owner[at], prepend=-1) != 0
            if not first.all():
                index.add(np.full(int((~first).sum()), r, dtype=np.int32), at[~first])
                at = at[first]
        elif len(at) > 1:
            chained = right[at[:-1]] == at[1:]  # a a a: of pairs that share a token every other one merges
            if chained.any():
                number = np.arange(len(at))
                number -= np.maximum.accumulate(np.where(np.concatenate([[False], chained]), 0, number))
                at = at[number % 2 == 0]
        gone = right[at]
        after, before = right[gone], left[at]
        token[at], token[gone] = r, -1
        rank[gone] = NO_PAIR
        right[at], left[after] = after, at
        rank[at] = NO_PAIR
        begins = np.concatenate([at[after < n], before[before < n]])
        if len(begins):
            new = vocabulary.rank(token[begins], token[right[begins]])
            rank[begins] = new
            pair = new < NO_PAIR
            if pair.any():
                index.add(new[pair], begins[pair])
    alive = token >= 0
    return np.bincount(owner[alive], minlength=len(words)), token[alive]


def replay_all(words: list[bytes], vocabulary: Vocabulary, most: int = REPLAY_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """``replay`` of ``most`` bytes of words at a time (or of one word)."""
    until = np.cumsum([len(w) for w in words])
    parts, at = [], 0
    while at < len(words):
        end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + most, side="right")))
        parts.append(replay(words[at:end], vocabulary))
        at = end
    if not parts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
    return tuple(np.concatenate(c) for c in zip(*parts))


class Numbers(dict):
    """Gives every new word the next number."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def gather(counts: np.ndarray, ids: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a sequence of words given by number, and where each word's end."""
    begins, sizes = (np.cumsum(counts) - counts)[words], counts[words]
    until = np.cumsum(sizes)
    return ids[np.repeat(begins - until + sizes, sizes) + np.arange(until[-1] if len(until) else 0)], until


class Encoder:
    """Encodes texts in one process, with one replay of their distinct words."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.pattern = vocabulary_of(path), regex.compile(pattern)

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers."""
        numbers = Numbers()
        split = [list(map(numbers.__getitem__, self.pattern.findall(t or ""))) for t in texts]
        counts, ids = replay_all([w.encode() for w in numbers], self.vocabulary)
        return [gather(counts, ids, np.array(words, dtype=np.int64))[0].astype("<u4").tobytes() for words in split]


@functools.lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    """Kept by a Python worker for its next task."""
    return Vocabulary(path)


class Block:
    """Documents of a task and their words, until there are enough of them."""

    def __init__(self, names: list[str], digits: int, most_words: int, most_docs: int):
        self.names, self.digits, self.most_words, self.most_docs, self.written = names, digits, most_words, most_docs, 0
        self.clear()

    def clear(self) -> None:
        self.docs, self.lengths, self.words, self.numbers, self.held = [], [], [], Numbers(), 0

    def add(self, docs: pa.Array, texts: list[list[str]]) -> None:
        self.docs.append(docs)
        for words in texts:
            self.lengths.append(len(words))
            self.words.append(np.array(list(map(self.numbers.__getitem__, words)), dtype=np.int64))
            self.held += len(words)

    def full(self) -> bool:
        return self.held >= self.most_words or len(self.lengths) >= self.most_docs

    def write(self) -> pa.RecordBatch:
        """Rows of the documents, the body and the runs; targets of runs are negative."""
        name = TaskContext.get().partitionId() << 32 | self.written
        words = [w.encode() for w in self.numbers]
        digit = np.array([zlib.crc32(w) % self.digits for w in words], dtype=np.int64)
        order = np.argsort(digit, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        found, cuts = np.unique(digit[order], return_index=True)
        runs = [[words[i] for i in part] for part in np.split(order, cuts[1:])] if len(found) else []
        pack = zstandard.ZstdCompressor(level=1).compress
        body = squeeze(np.array(self.lengths, dtype=np.int64), place[np.concatenate(self.words)] if self.held else place)
        n = len(self.lengths)
        columns = [
            pa.array([name] * (n + 1) + (-1 - found).tolist(), type=pa.int64()),
            pa.array([DOC] * n + [BODY] + [RUN] * len(runs), type=pa.int32()),
            pa.array([*range(n), 0] + [name] * len(runs), type=pa.int64()),
            pa.concat_arrays([*self.docs, pa.nulls(1 + len(runs), self.docs[0].type)]),
            pa.array([None] * n + [body] + [squeeze(np.array([len(w) for w in run])) for run in runs], type=pa.binary()),
            pa.array([None] * (n + 1) + [pack(b"".join(run)) for run in runs], type=pa.binary())]
        self.written += 1
        self.clear()
        return pa.RecordBatch.from_arrays(columns, self.names)


def _replayed(path: str, replay_bytes: int):
    """Ids of the words of each run, from one replay a digit."""
    def run(batches):
        digits: dict[int, tuple[Numbers, list]] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            kinds = batch.column(1).to_pylist()
            for i in (i for i, kind in enumerate(kinds) if kind == RUN):
                target, _, block, _, lengths, text = (batch.column(c)[i].as_py() for c in range(6))
                numbers, runs = digits.setdefault(target, (Numbers(), []))
                text, ends = unpack(text), np.cumsum(expand(lengths)[0].astype(np.int64)).tolist()
                words = [text[a:b] for a, b in zip([0, *ends], ends)]
                runs.append((block, np.array(list(map(numbers.__getitem__, words)), dtype=np.int64)))
        for target in sorted(digits):
            numbers, runs = digits.pop(target)
            counts, ids = replay_all(list(numbers), vocabulary_of(path), replay_bytes)
            for block, words in runs:
                own, _ = gather(counts, ids, words)
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([-target], type=pa.int64()),
                                                  pa.array([squeeze(counts[words], own)], type=pa.binary())], ["_target", "_place", "_blob"])
    return run


@functools.lru_cache(maxsize=1)
def spelling_of(path: str) -> dict[int, bytes]:
    """The bytes of every token; kept by a Python worker for its next group."""
    return {r: token for token, r in read_ranks(path).items()}


def spelled(path: str, texts: list[bytes | None]) -> pa.Array:
    """The bytes that ids (little-endian 32-bit numbers; null: none) spell."""
    spell = spelling_of(path).__getitem__
    return pa.array([b"".join(map(spell, np.frombuffer(x or b"", dtype="<u4").tolist())) for x in texts], type=pa.binary())


def _put_together(schema: pa.Schema, path: str, decoded: bool):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        kind = np.asarray(block.column("_kind"))
        if not (kind == BODY).any():  # a digit's runs
            return schema.empty_table()
        (at,) = np.flatnonzero(kind == BODY).tolist()
        lengths, words = (x.astype(np.int64) for x in expand(block.column("_blob")[at].as_py()))
        order = np.argsort(np.asarray(answers.column("_place"))).tolist()
        known = [expand(answers.column("_blob")[i].as_py()) for i in order]
        counts, ids = (np.concatenate([x[k] for x in known]).astype(np.int64) if known else np.empty(0, dtype=np.int64) for k in (0, 1))
        ids, until = gather(counts, ids, words)
        raw = ids.astype("<u4").tobytes()
        ends = (4 * np.concatenate([[0], until])[np.cumsum(lengths)]).tolist()
        texts = [raw[a:b] for a, b in zip([0, *ends], ends)]
        docs = block.filter(pa.array(kind == DOC))
        own = [texts[i] for i in docs.column("_place").to_pylist()]
        return pa.table([docs.column("_doc"), pa.array(own, type=pa.binary()), *([spelled(path, own)] if decoded else [])], schema=schema)
    return run


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", drop_text: bool = False,
           decoded: str | None = None, block_words: int = BLOCK_WORDS, block_docs: int = BLOCK_DOCS, replay_bytes: int = REPLAY_BYTES) -> DataFrame:
    """The documents with a binary column ``ids`` (an existing column of that name is replaced).

    ``path`` must be readable on every executor; ``drop_text`` leaves the text out of the result (and out of the shuffle).
    ``decoded`` names a further column with the bytes that the ids spell, as ``decode`` gives them, made where the ids are.
    The bounds of blocks and replays do not change the result.
    """
    made = [ids, *([decoded] if decoded else [])]
    kept = [c for c in docs.columns if c.lower() not in [m.lower() for m in made] and not (drop_text and c == text)]
    read = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("_none")]).alias("_doc"), F.col(f"`{text}`").alias("_text"))
    digits = min(MOST_DIGITS, max(LEAST_DIGITS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = T.StructType([T.StructField("_target", T.LongType()), T.StructField("_kind", T.IntegerType()), T.StructField("_place", T.LongType()),
                         T.StructField("_doc", read.schema["_doc"].dataType), T.StructField("_blob", T.BinaryType()), T.StructField("_words", T.BinaryType())])
    names = rows.names

    def split(batches):
        find, block = regex.compile(pattern).findall, Block(names, digits, block_words, block_docs)
        for batch in batches:
            for part in slices(batch):
                block.add(part.column(0), [find(x) if x else [] for x in part.column(1).to_pylist()])
                if block.full():
                    yield block.write()
        if block.lengths:
            yield block.write()

    blocks = in_batches(read).mapInArrow(split, rows).repartition("_target")
    answers = in_batches(blocks).mapInArrow(_replayed(path, replay_bytes), "_target bigint, _place bigint, _blob binary")
    out = T.StructType([rows["_doc"], *[T.StructField(f"_made{k}", T.BinaryType()) for k in range(len(made))]])
    met = blocks.groupBy("_target").cogroup(answers.groupBy("_target")).applyInArrow(
        _put_together(to_arrow_schema(out), path, decoded is not None), out)
    return met.select(*[F.col(f"_doc.`{c}`") for c in kept], *[F.col(f"_made{k}").alias(m) for k, m in enumerate(made)])


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The frame with a binary column ``out``: the bytes that the ids spell (null ids: none)."""
    kept = [f for f in df.schema.fields if f.name.lower() != out.lower()]
    at = df.columns.index(ids)
    picked = [df.columns.index(f.name) for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in picked], spelled(path, part.column(at).to_pylist())],
                                                 [f.name for f in schema.fields])

    return in_batches(df).mapInArrow(run, schema)
