"""Alignment of two tokenizers' tokens, with corpus-wide counts of the pairs they link.

Tokens of A (byte-level BPE, of a space and the text) and of B (pieces of the text, which put that space themselves) tile
the same bytes.  Their common ends cut both into groups; between two neighbouring ends of either, one token of A and one of
B overlap, so the links of a document are as many as different ends.

Counting is external, by radix-partitioned runs:

1. documents are tokenised in blocks of at most ``BLOCK_LINKS`` different pairs a document in sum (or one document).  The
   pairs of a block are numbered side-major (A id within radix digits of A ids); a block's body, its documents' pair numbers
   and multiplicities, and one run a digit, its pairs with the number of documents that hold them, are written as zstd blobs;
2. runs are shuffled by digit.  A digit's runs are merged by a heap of their next A ids; the pairs of one A id are counted
   together, so its highest count is known when it is passed, and counts are streamed back, in run order, to each run's block;
3. blocks meet their counts again and sum them up by document.

As pairs are counted per block before they are shuffled, a pair that stands in every document is one record a block.
Memory: a block, or one digit's runs, of which every block has one: a record per different pair of the digit.

Texts that are null or empty, or whose tokens do not spell the text with a space before it, have no tokens: zeros and ''.
Repeated rows are documents of their own.  An empty table gives no rows.  Long texts are cut for B at spaces after a
character that no piece joins to a space, where nothing can merge across.  Further columns pass through; one that has the
name of a result column is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from tidemark.llm.batches import in_batches, mix, slices
from tidemark.llm.blobs import expand, squeeze
from tidemark.llm.byte_letters import byte_letters
from tidemark.workspace import new_folder

BLOCK_LINKS = 1 << 21
BLOCK_DOCS = 4096
DIGITS_PER_PARTITION, MOST_DIGITS = 4, 256  # a block writes as many runs, at most
LONG = 16_384  # characters given to B at once
SPACE = "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = (*COUNTS, "n_best", "count_sum", "groups_sha256")
DOC, RUN, BODY, ANSWER = range(4)


class Pair:
    """Both tokenizers: ids of a text, and the bytes that ids stand for."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        with open(path_a, encoding="utf-8") as file:
            settings = json.load(file)
        model, letters = settings["model"], byte_letters()
        added = {x["id"] for x in settings["added_tokens"]}
        spelled = {token: rank for token, rank in model["vocab"].items() if rank not in added}
        ranks = {bytes(letters[c] for c in token): rank for token, rank in spelled.items()}
        merged = [model["vocab"]["".join(x.split(" ") if isinstance(x, str) else x)] for x in model["merges"]]
        if merged == sorted(merged):  # ids are ranks, and the two libraries agree
            coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.ids_a = coder.encode_ordinary
        else:
            library = Tokenizer.from_file(path_a)
            library.encode_special_tokens = True
            self.ids_a = lambda text: library.encode(text, add_special_tokens=False).ids
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.before_space = {p[i] for p in pieces for i in range(len(p) - 1) if p[i + 1] == SPACE}
        self.width_a, self.width_b = (np.array([len(x) for x in side]) for side in (self.bytes_a, self.bytes_b))
        # decimal ids with what may follow them: within a group, at its end
        self.shown_a = [np.array([f"{i}{x}" for i in range(len(self.bytes_a))], dtype=object) for x in ",|"]
        self.shown_b = [np.array([f"{i}{x}" for i in range(len(self.bytes_b))], dtype=object) for x in ",;"]

    def ids_b(self, text: str, long: int = LONG) -> list[int]:
        if len(text) <= long:
            return self.model.encode(text, num_threads=1)
        parts, begin, at = [], 0, long
        while (at := text.find(" ", at)) >= 0 and at + 1 < len(text):
            if text[at - 1] != " " and text[at - 1] not in self.before_space:
                parts.append(text[begin:at])  # the model puts the space that is left out before the next part
                begin = at + 1
                at += long
            at += 1
        return [i for ids in self.model.encode([*parts, text[begin:]], num_threads=1) for i in ids]

    def align(self, text: str | None, long: int = LONG) -> Alignment | None:
        """None where the tokens do not spell the text."""
        if not text:
            return None
        raw = b" " + text.encode()
        b = self.ids_b(text, long)
        if b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        a = self.ids_a(" " + text)
        if b"".join([self.bytes_a[i] for i in a]) != raw:
            return None
        return Alignment(self, np.array(a), np.array(b), len(raw))


class Alignment:
    """Groups and links of one text."""

    def __init__(self, pair: Pair, a: np.ndarray, b: np.ndarray, size: int):
        self.pair, self.a, self.b = pair, a, b
        ends_a, ends_b = (np.zeros(size, dtype=bool) for _ in range(2))
        ends_a[np.cumsum(pair.width_a[a]) - 1] = True
        ends_b[np.cumsum(pair.width_b[b]) - 1] = True
        ends = np.flatnonzero(ends_a | ends_b)
        self.last_a, self.last_b = ends_a[ends], ends_b[ends]
        self.both = self.last_a & self.last_b
        self.of_a, self.of_b = (np.cumsum(last) - last for last in (self.last_a, self.last_b))  # token of either on each link

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Different linked id pairs, A's in the upper half, and how often each is linked."""
        keys = self.a[self.of_a].astype(np.uint64) << np.uint64(32) | self.b[self.of_b].astype(np.uint64)
        return np.unique(keys, return_counts=True)

    def groups(self) -> str:
        closes_a, closes_b = self.both[self.last_a], self.both[self.last_b]
        group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
        sizes_a, sizes_b = (np.bincount(g) for g in (group_a, group_b))
        shown = np.empty(len(self.a) + len(self.b), dtype=object)
        shown[np.arange(len(self.a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]] = np.where(
            closes_a, self.pair.shown_a[1][self.a], self.pair.shown_a[0][self.a])
        shown[np.arange(len(self.b)) + np.cumsum(sizes_a)[group_b]] = np.where(
            closes_b, self.pair.shown_b[1][self.b], self.pair.shown_b[0][self.b])
        return "".join(shown.tolist())[:-1]

    def numbers(self) -> tuple[int, int, int, int]:
        return len(self.a), len(self.b), int(self.both.sum()), len(self.both)


@functools.lru_cache(maxsize=1)
def pair_of(path_a: str, path_b: str, pattern: str) -> Pair:
    """Kept by a Python worker for its next task."""
    return Pair(path_a, path_b, pattern)


def number_pairs(keys: np.ndarray, digits: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Number of the pair of each record of a block, side-major within digits, and (digit, pairs, documents) of each run."""
    different, which, held = np.unique(keys, return_inverse=True, return_counts=True)
    digit = mix(different >> np.uint64(32)) % np.uint64(digits)
    order = np.argsort(digit, kind="stable")
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    digit = digit[order]
    cuts = np.flatnonzero(np.diff(digit)) + 1
    runs = zip(np.split(different[order], cuts), np.split(held[order], cuts))
    return number[which], [(int(digit[at]), p, n) for at, (p, n) in zip([0, *cuts.tolist()], runs) if len(p)]


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sum of each pair's counts over all runs, and whether it is the highest of its A id, in the order of each run.

    Runs are sorted by pair; a heap leads through their A ids, so that the pairs of one A id meet and no others.
    """
    spans = []  # of every run: A ids, and where their pairs begin and end
    for pairs, _ in runs:
        a = pairs >> np.uint64(32)
        begins = np.flatnonzero(np.diff(a, prepend=np.uint64(2**64 - 1)))
        spans.append((a[begins].tolist(), [*begins.tolist(), len(pairs)]))
    answers = [(np.empty(len(pairs), dtype=np.uint64), np.empty(len(pairs), dtype=np.uint64)) for pairs, _ in runs]
    waiting = [(spans[r][0][0], r, 0) for r in range(len(runs)) if spans[r][0]]
    heapq.heapify(waiting)
    while waiting:
        a, met = waiting[0][0], []
        while waiting and waiting[0][0] == a:
            _, r, k = waiting[0]
            met.append((r, spans[r][1][k], spans[r][1][k + 1]))
            if k + 1 < len(spans[r][0]):
                heapq.heapreplace(waiting, (spans[r][0][k + 1], r, k + 1))
            else:
                heapq.heappop(waiting)
        pairs, which = np.unique(np.concatenate([runs[r][0][i:j] for r, i, j in met]), return_inverse=True)
        held = np.concatenate([runs[r][1][i:j] for r, i, j in met]).astype(np.uint64)
        total = np.zeros(len(pairs), dtype=np.uint64)
        np.add.at(total, which, held)
        counts = total[which]
        best = counts == total.max()
        at = 0
        for r, i, j in met:
            answers[r][0][i:j], answers[r][1][i:j] = counts[at:at + j - i], best[at:at + j - i]
            at += j - i
    return answers


class Block:
    """Documents of a task until there are enough of them."""

    def __init__(self, schema: T.StructType, digits: int, most_links: int, most_docs: int):
        self.schema, self.digits, self.most_links, self.most_docs, self.number = schema, digits, most_links, most_docs, 0
        self.clear()

    def clear(self) -> None:
        self.docs, self.rows, self.keys, self.times, self.links = [], [], [], [], 0

    def add(self, docs: pa.Array, alignments: list[tuple]) -> None:
        self.docs.append(docs)
        for numbers, shown, (keys, times) in alignments:
            self.rows.append((*numbers, shown))
            self.keys.append(keys)
            self.times.append(times)
            self.links += len(keys)

    def full(self) -> bool:
        return self.links >= self.most_links or len(self.rows) >= self.most_docs

    def write(self) -> pa.RecordBatch:
        """Rows of documents, the block's body and its runs."""
        name = TaskContext.get().partitionId() << 32 | self.number
        lengths = np.array([len(k) for k in self.keys], dtype=np.int64)
        numbers, runs = number_pairs(np.concatenate(self.keys), self.digits)
        times, owner = np.concatenate(self.times), np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(owner << 32 | numbers)
        numbers, times = numbers[order], times[order]
        steps = np.diff(numbers, prepend=0)
        first = (np.cumsum(lengths) - lengths)[lengths > 0]
        steps[first] = numbers[first]
        n, others = len(self.rows), 1 + len(runs)
        columns = [[name] * (n + others), [DOC] * n + [BODY] + [RUN] * len(runs), [*range(n), 0, *[d for d, _, _ in runs]],
                   pa.concat_arrays([*self.docs, pa.nulls(others, self.docs[0].type)]),
                   *[[*column, *[None] * others] for column in zip(*self.rows)],
                   [None] * n + [squeeze(lengths, steps, times)] + [squeeze(np.diff(p, prepend=np.uint64(0)), c) for _, p, c in runs]]
        types = [pa.int64(), pa.int32(), pa.int64(), None, *[pa.int64()] * len(COUNTS), pa.string(), pa.binary()]
        batch = pa.RecordBatch.from_arrays([c if t is None else pa.array(c, type=t) for c, t in zip(columns, types)], self.schema.names)
        self.number += 1
        self.clear()
        return batch


def _blocks(docs: DataFrame, path_a: str, path_b: str, pattern: str, text: str, carried: list[str], digits: int,
            most_links: int, most_docs: int) -> DataFrame:
    read = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried] or [F.lit(0).alias("_none")]).alias("_doc"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_kind", T.IntegerType()), T.StructField("_place", T.LongType()),
                           T.StructField("_doc", read.schema["_doc"].dataType), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("_blob", T.BinaryType())])
    nothing = ((0, 0, 0, 0), "", (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)))

    def digest(aligned: Alignment | None) -> tuple:
        if aligned is None:
            return nothing
        return aligned.numbers(), hashlib.sha256(aligned.groups().encode()).hexdigest(), aligned.pairs()

    def run(batches):
        pair, block = pair_of(path_a, path_b, pattern), Block(schema, digits, most_links, most_docs)
        for batch in batches:
            for part in slices(batch, 64):
                block.add(part.column(0), [digest(pair.align(x.as_py())) for x in part.column(1)])
                if block.full():
                    yield block.write()
        if block.rows:
            yield block.write()

    return in_batches(read).mapInArrow(run, schema)


def _answers(batches):
    """Counts for each run of a digit; the rows of a digit follow each other."""
    digit, runs = None, []
    for batch in batches:
        for d, block, blob in zip(*[column.to_pylist() for column in batch.columns]):
            if d != digit and runs:
                yield _answer(digit, runs)
                runs = []
            digit = d
            runs.append((block, blob))
    if runs:
        yield _answer(digit, runs)


def _answer(digit: int, runs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    held = [(np.cumsum(pairs, dtype=np.uint64), counts) for pairs, counts in (expand(blob) for _, blob in runs)]
    blobs = [squeeze(counts, best) for counts, best in merge_runs(held)]
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in runs], type=pa.int64()), pa.array([ANSWER] * len(runs), type=pa.int32()),
                                       pa.array([digit] * len(runs), type=pa.int64()), pa.array(blobs, type=pa.binary())],
                                      ["_block", "_kind", "_place", "_blob"])


def _summed(table: pa.Table, names: list[str]) -> pa.Table:
    """Documents of one block with the sums over their links."""
    kind, place = (np.asarray(table.column(c)) for c in ("_kind", "_place"))

    def blobs(of: int) -> list[list[np.ndarray]]:
        at = np.flatnonzero(kind == of)
        return [expand(table.column("_blob")[int(i)].as_py()) for i in at[np.argsort(place[at])]]
    answers = blobs(ANSWER)
    counts, best = (np.concatenate([x[k] for x in answers]).astype(np.int64) if answers else np.empty(0, dtype=np.int64) for k in (0, 1))
    lengths, steps, times = (x.astype(np.int64) for x in blobs(BODY)[0])
    until = np.cumsum(lengths)
    total = np.cumsum(steps)
    before = np.concatenate([[0], total])[until - lengths]
    numbers = total - np.repeat(before, lengths)
    sums = []
    for value in (best[numbers] * times, counts[numbers] * times):
        line = np.concatenate([[0], np.cumsum(value)])
        sums.append(line[until] - line[until - lengths])
    docs = table.filter(pa.array(kind == DOC))
    at = np.asarray(docs.column("_place"))
    columns = {c: docs.column(c) for c in docs.column_names} | {"n_best": pa.array(sums[0][at]), "count_sum": pa.array(sums[1][at])}
    return pa.table({c: columns[c] for c in names})


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, text: str = "text",
          block_links: int = BLOCK_LINKS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The documents' other columns with the columns ``RESULT``.

    ``path_a`` is a byte-level tokenizers file with ``pattern`` as its words, ``path_b`` a sentencepiece model; both are
    read on every executor.  The bounds of a block do not change the result.
    """
    spark = docs.sparkSession
    carried = [c for c in docs.columns if c != text and c.lower() not in RESULT]
    digits = min(MOST_DIGITS, DIGITS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = new_folder(spark, "link-blocks")
    _blocks(docs, path_a, path_b, pattern, text, carried, digits, block_links, block_docs).write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.parquet(folder)
    runs = blocks.filter(F.col("_kind") == RUN).select(F.col("_place").alias("_digit"), "_block", "_blob")
    answers = in_batches(runs.repartition("_digit").sortWithinPartitions("_digit", "_block")).mapInArrow(
        _answers, "_block bigint, _kind int, _place bigint, _blob binary")
    rows = blocks.filter(F.col("_kind") != RUN).unionByName(answers, allowMissingColumns=True)
    schema = T.StructType([blocks.schema["_doc"], *[T.StructField(c, T.StringType() if c == "groups_sha256" else T.LongType()) for c in RESULT]])
    names = schema.names
    summed = rows.groupBy("_block").applyInArrow(lambda table: _summed(table, names), schema)
    return summed.select(*[F.col(f"_doc.`{c}`") for c in carried], *RESULT)
