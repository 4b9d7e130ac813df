"""Packing of documents into token sequences along a Hilbert curve.

A document's token counts are hashed into ``BUCKETS`` buckets, damped by a square root, scaled to length one and projected
to ``DIMENSIONS`` numbers by a fixed random matrix.  Mean and spread of these numbers over all documents turn each into a
cell of a grid whose cells hold about equally many documents per axis, and the cell's place on a Hilbert curve is the
document's key.  Keys (ties: the row's own number) are range-partitioned and sorted; running sums of token counts within
the ranges, with one total a range, give every document the place of its first token in one long line, which is cut every
``length`` tokens.  So neighbours on the curve share sequences, no sequence but those at the very end is short, and the end
is cut at powers of two, which need no padding.

Texts are encoded once; ids and keys are written to the shared folder and only keys and counts are sorted.  The ids are then
shuffled once, to meet their documents' places.  Driver: one total per range partition, eight statistics.

Null and empty texts are a document of its end id alone, whose key is that of the zero vector.  Ties of the key (copies)
follow each other in the order of their rows, and are spread over ranges, however many there are.  Repeated rows are
documents of their own.  An empty table gives no pieces.  Very long texts give many pieces, made a few hundred at a time.
Further columns are carried to each piece; one that has the name of a result column is replaced by it.
"""

from __future__ import annotations

import functools
import json
import math
import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer

from tidemark.llm.batches import SPACES, in_batches, slices
from tidemark.llm.byte_letters import byte_letters
from tidemark.llm.word_arrays import table, words
from tidemark.workspace import new_folder

DIMENSIONS, BITS, BUCKETS = 4, 8, 256
LENGTH = 2048
END_ID = 1
KNOWN_BYTES = 48 << 20
LEARNED = 4096  # parts encoded at a time
ROWS = 1000  # documents encoded at a time
PIECES = 256  # pieces handed on at a time
RESULT = ("start", "length", "doc_tokens", "sequence_id", "offset", "ids")
WORD_END = "</w>"
# characters whose class and lower case no version of Unicode changes: Latin, Cyrillic, punctuation, kana, Han, Hangul
SETTLED = r"\x00-\u024F\u0300-\u036F\u0400-\u052F\u2000-\u2064\u3000-\u303F\u3041-\u3096\u30A1-\u30FE\u4E00-\u9FA5\uAC00-\uD7A3"
_COST = 150  # bytes that an entry of the word table takes besides its texts

_random = np.random.Generator(np.random.PCG64(20240611))
_PARTS, _SPACE = table(SPACES), re.compile(rb"[\x20\x09-\x0D]")
_AXES = _random.standard_normal((BUCKETS, DIMENSIONS))


class WordEncoder:
    """Ids of texts as the tokenizers library gives them without added special tokens.

    Where a model drops white space and joins nothing across it, a text's ids are those of its parts between ASCII white
    space.  So the different parts of a batch, told apart by 64-bit hashes, are encoded once and kept, in two generations of
    ``KNOWN_BYTES`` each.  A part of ``SETTLED`` characters is encoded by its merge ranks, the end of a word being a space
    in them; others, and texts that may hold a special string, go to the library.  Models of another kind go to the library
    altogether.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.specials = [x["content"].encode() for x in settings["added_tokens"]]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        self.ranks = self._ranks(settings)

    def _ranks(self, settings: dict) -> tiktoken.Encoding | None:
        model, steps = settings["model"], (settings.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        kinds = [x["type"] for x in (settings.get("normalizer") or {}).get("normalizers", [])]
        pattern = (steps[0].get("pattern") or {}).get("Regex")
        merged = ["".join(x.split(" ") if isinstance(x, str) else x) for x in model.get("merges", [])]
        by_rank = [model["vocab"].get(x, -1) for x in merged]
        if (model.get("end_of_word_suffix") != WORD_END or kinds != ["NFC", "Replace", "Lowercase"] or pattern is None
                or not (steps[0].get("behavior"), steps[0].get("invert")) == ("Removed", True) or by_rank != sorted(by_rank)):
            return None
        letters = byte_letters()
        added = {x["id"] for x in settings["added_tokens"]}
        ranks = {}
        for token, rank in model["vocab"].items():
            if rank not in added:
                ended = token.endswith(WORD_END)
                spelled = bytes(letters[c] for c in (token[:-len(WORD_END)] if ended else token))
                ranks[spelled + b" " if ended else spelled] = rank
        self.pattern = regex.compile(f"{pattern}|\n")
        self.between = ranks[b"\n "]
        self.foreign = regex.compile(f"[^{SETTLED}]")
        return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def _by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.width).tobytes()

    def _learn(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts that are not known yet: one pass over all of them, a line feed being a word between them."""
        text = b"\n".join([*parts, b""]).decode()
        if not text.isascii():
            if self.foreign.search(text):
                return [self._by_library(x) if self.foreign.search(x) else self._learn([x.encode()])[0] for x in text.split("\n")[:-1]]
            text = unicodedata.normalize("NFC", text).lower()
        ids = np.array(self.ranks.encode_ordinary(" ".join(self.pattern.findall(text)) + " "), dtype=self.width)
        raw, size = ids.tobytes(), ids.itemsize
        ends = (np.flatnonzero(ids == self.between) * size).tolist()
        return [raw[i:j] for i, j in zip([0, *[end + size for end in ends]], ends)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``width``."""
        raw = [(x or "").encode() for x in texts]
        whole = [self.ranks is None or any(x in r for x in self.specials) for r in raw]
        lower = [b"" if w else r.lower() for r, w in zip(raw, whole)]  # ASCII letters only
        joined = b"\n".join(lower)
        stops = np.cumsum([len(x) + 1 for x in lower])
        hashes, starts, ends = words(joined, _PARTS, _SPACE)
        different, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        ids = self._ids([joined[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())])
        size = np.dtype(self.width).itemsize
        lengths = np.array([len(x) for x in ids], dtype=np.int64) // size
        begins, counts = (np.cumsum(lengths) - lengths)[which], lengths[which]
        until = np.cumsum(counts)
        places = np.repeat(begins - until + counts, counts) + np.arange(until[-1] if len(until) else 0)
        flat = np.frombuffer(b"".join(ids), dtype=self.width)[places].tobytes()
        bounds = (np.concatenate([[0], until])[np.searchsorted(starts, stops)] * size).tolist()
        return [self._by_library(x) if w and x else flat[i:j] for x, w, i, j in zip(texts, whole, [0, *bounds], bounds)]

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """Ids of different parts, from the word table or learned."""
        if self.held > KNOWN_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        found = list(map(self.known.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i in missing:
            found[i] = self.older.get(parts[i])
        fresh = [i for i in missing if found[i] is None]
        for at in range(0, len(fresh), LEARNED):
            some = fresh[at:at + LEARNED]
            for i, ids in zip(some, self._learn([parts[i] for i in some])):
                found[i] = ids
        for i in missing:
            self.known[parts[i]] = found[i]
            self.held += len(parts[i]) + len(found[i]) + _COST
        return found


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """Kept by a Python worker for its next task."""
    return WordEncoder(path)


def projections(documents: list[np.ndarray]) -> np.ndarray:
    """A point of ``DIMENSIONS`` numbers for the ids of each document."""
    vectors = np.zeros((len(documents), BUCKETS))
    for row, ids in zip(vectors, documents):
        if len(ids):
            hashed = (ids.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            row += np.sqrt(np.bincount(hashed, minlength=BUCKETS))
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths, lengths, 1) @ _AXES


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (rows of numbers below 2^bits), by the transposed-axes method."""
    x = [np.ascontiguousarray(axis).astype(np.uint64) for axis in cells.T]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = np.uint64((1 << level) - 1)
        for i in range(len(x)):
            high = (x[i] >> np.uint64(level) & one).astype(bool)
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint64(level) & one, np.uint64((1 << level) - 1), np.uint64(0))
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << one | (axis ^ turn) >> np.uint64(level) & one
    return key


def sequence_ends(total: int, length: int) -> list[int]:
    """Where the sequences at the end of the line stop, after all whole ones: the rest is cut at powers of two."""
    at, ends = total // length * length, []
    while at < total:
        at += 1 << (total - at).bit_length() - 1
        ends.append(at)
    return ends


def _encoded(docs: DataFrame, path: str, text: str, carried: list[str], end_id: int) -> DataFrame:
    """Ids, their number and the projections of each document; its further columns as one."""
    read = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried] or [F.lit(0).alias("_none")]).alias("_doc"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([read.schema["_doc"], T.StructField("_ids", T.BinaryType()), T.StructField("_n", T.LongType()),
                           *[T.StructField(f"_p{k}", T.DoubleType()) for k in range(DIMENSIONS)]])

    def run(batches):
        coder = word_encoder(path)
        end = np.array([end_id], dtype=coder.width).tobytes()
        for batch in batches:
            for part in slices(batch, ROWS):
                ids = coder.encode(part.column(1).to_pylist())
                points = projections([np.frombuffer(x, dtype=coder.width) for x in ids])
                counts = np.array([len(x) for x in ids], dtype=np.int64) // np.dtype(coder.width).itemsize + 1
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x + end for x in ids], type=pa.binary()), pa.array(counts),
                                                  *[pa.array(axis) for axis in points.T]], schema.names)

    return in_batches(read).mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id())


def _keyed(encoded: DataFrame) -> DataFrame:
    """Row, number of ids and curve key of each document."""
    axes = [f"_p{k}" for k in range(DIMENSIONS)]
    stats = encoded.select([f(F.col(a)).alias(f"{f.__name__}{a}") for a in axes for f in (F.mean, F.stddev_pop)]).first()
    centre = [stats[2 * k] or 0.0 for k in range(DIMENSIONS)]
    spread = [stats[2 * k + 1] or 1.0 for k in range(DIMENSIONS)]
    cells = 1 << BITS

    @F.pandas_udf(T.LongType())
    def key(*points: pd.Series) -> pd.Series:
        below = [np.array([0.5 * math.erfc((c - v) / s / math.sqrt(2)) for v in axis]) for axis, c, s in zip(points, centre, spread)]
        grid = np.minimum((np.stack(below, axis=1) * cells).astype(np.int64), cells - 1)
        return pd.Series(hilbert_keys(grid).astype(np.int64))

    return encoded.select("_row", "_n", key(*axes).alias("_key"))


def pack(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens: the documents' other columns, ``start`` (ids of the document
    before the piece), ``length``, ``ids`` (little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset``.

    ``path`` names a tokenizers file on every executor; ``end_id`` ends each document.
    """
    spark = docs.sparkSession
    carried = [c for c in docs.columns if c != text and c.lower() not in RESULT]
    folder = new_folder(spark, "curve-ids")
    _encoded(docs, path, text, carried, end_id).write.option("compression", "zstd").parquet(folder)
    encoded = spark.read.parquet(folder)
    folder = new_folder(spark, "curve-order")
    _keyed(encoded).repartitionByRange("_key", "_row").withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    ordered = spark.read.parquet(folder)

    totals = sorted(ordered.groupBy("_range").agg(F.sum("_n")).collect())  # one row a range partition
    before = np.cumsum([0, *[n for _, n in totals]]).tolist()
    firsts = spark.createDataFrame([(r, at) for (r, _), at in zip(totals, before)], "_range int, _first bigint")
    earlier = Window.partitionBy("_range").orderBy("_key", "_row").rowsBetween(Window.unboundedPreceding, -1)
    places = (ordered.withColumn("_at", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
              .join(F.broadcast(firsts), "_range").select("_row", (F.col("_at") + F.col("_first")).alias("_at")))
    placed = encoded.select("_row", "_doc", "_ids").join(places.hint("shuffle_hash"), "_row").select("_doc", "_ids", "_at")
    pieces = _cut(placed, path, length, before[-1])
    return pieces.select(*[F.col(f"_doc.`{c}`") for c in carried], *RESULT)


def _cut(placed: DataFrame, path: str, length: int, total: int) -> DataFrame:
    whole, ends = total // length, sequence_ends(total, length)
    begins = [whole * length, *ends[:-1]]
    schema = T.StructType([placed.schema["_doc"], *[T.StructField(c, T.LongType()) for c in RESULT[:-1]], T.StructField("ids", T.BinaryType())])

    def sequence(at: int) -> tuple[int, int, int]:
        """Number, begin and end of the sequence that holds a place."""
        if at < whole * length:
            return at // length, at // length * length, at // length * length + length
        k = next(i for i, end in enumerate(ends) if at < end)
        return whole + k, begins[k], ends[k]

    def run(batches):
        width = word_encoder(path).width
        for batch in batches:
            rows, numbers, ids = [], [], []
            for r in range(batch.num_rows):
                tokens = np.frombuffer(batch.column(1)[r].as_py(), dtype=width)
                first = at = batch.column(2)[r].as_py()
                while at < first + len(tokens):
                    k, begin, end = sequence(at)
                    end = min(end, first + len(tokens))
                    rows.append(r)
                    numbers.append((at - first, end - at, len(tokens), k, at - begin))
                    ids.append(tokens[at - first:end - first].astype("<u4").tobytes())
                    at = end
                    if len(rows) == PIECES:
                        yield _pieces(batch, rows, numbers, ids, schema)
                        rows, numbers, ids = [], [], []
            if rows:
                yield _pieces(batch, rows, numbers, ids, schema)

    return in_batches(placed).mapInArrow(run, schema)


def _pieces(batch: pa.RecordBatch, rows: list[int], numbers: list[tuple], ids: list[bytes], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *[pa.array(c, type=pa.int64()) for c in zip(*numbers)],
                                       pa.array(ids, type=pa.binary())], schema.names)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences: ``sequence_id``, ``n_tokens`` and ``ids``; a group is at most one sequence long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts"))
    return joined.select("sequence_id", "n_tokens", F.expr("aggregate(_parts, X'', (x, p) -> concat(x, p.ids))").alias("ids"))
