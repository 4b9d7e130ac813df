"""N-gram Jaccard join with a count-vector R-tree.

Two documents are linked if their sets of word shingles have a Jaccard similarity of at least ``SHARE``.  A set's
shingles are hashed into ``GROUPS`` groups; the counts per group are a point.  Two sets share at most the sum of the
smaller counts of each group, so a subtree of an R-tree is passed over when the summed minima of the query and of
the subtree's upper corner stay below the overlap the sizes call for.  Survivors are verified by exact intersection.

How it is spread:

* Documents with the same set are one class, told by a 128-bit digest; the rest works on one document per class.
* In many dimensions the corners of large nodes tell nothing apart, so the tree's upper levels are not boxes: classes
  meet in a cluster if they agree in one of ``BANDS`` bands of ``ROWS`` MinHashes.  A pair at the threshold misses
  all of them with a probability of (1 - 0.75^3)^48 < 4e-12, and is then usually linked through others.
* A cluster is cut into blocks of similar size, of at most ``BLOCK_SETS`` sets and ``BLOCK_SHINGLES`` shingles.  Blocks
  have corners as well: pairs of blocks whose corners rule a link out are left out.  Every other pair of blocks is one
  task: an R-tree over one side, queried by the other.  What is already connected is not verified again.
* Links come back as at most one per set and task, never as all pairs of a group.

Words are runs of anything but ASCII white space, A-Z lower-cased; a text of fewer than five words is one shingle; null
and empty texts have no shingles and are linked with nothing.  Documents are told by ``doc_id``: rows that repeat id
and text are one document, rows of one id with different texts share that id's place, a null id is linked with nothing and has no class.
``one_of_each`` tells documents by id and text.  Further columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.batches import in_batches, mix, shingle_set, slices, unused_name
from tidemark.llm.bloom import with_flag
from tidemark.llm.components import components
from tidemark.workspace import stage

SHARE = (75, 100)
GROUPS = 64
BANDS, ROWS = 48, 3
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 19
LEAF, FANOUT = 32, 16
STRIP = 1.1  # sizes of a block's sets differ by this factor at most
AT_A_TIME = 4096  # shingles hashed at a time

_draw = np.random.Generator(np.random.PCG64(31))
_XOR = _draw.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_TIMES = _draw.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key per band from the set's MinHashes."""
    lowest = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), AT_A_TIME):
        mixed = (hashes[at:at + AT_A_TIME, None] ^ _XOR) * _TIMES
        lowest = np.minimum(lowest, (mixed ^ (mixed >> np.uint64(32))).min(0))
    rows = mix(lowest).reshape(BANDS, ROWS)
    return mix(rows[:, 0] * np.uint64(3) + mix(rows[:, 1] * np.uint64(5) + mix(rows[:, 2] + np.arange(BANDS, dtype=np.uint64)))).view(np.int64)


def group_counts(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(58)).astype(np.int64), minlength=GROUPS)


def needed(a, b):
    """Least overlap of sets of sizes a and b at the threshold."""
    whole, part = SHARE[1], SHARE[0]
    return -(-part * (a + b) // (whole + part))


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``_id``, ``n_shingles``, ``_set`` (digest of the set) and ``_bands``; the latter two null without shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_set(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], type=pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], type=pa.binary()),
                     pa.array([bands(s) if len(s) else None for s in sets], type=pa.list_(pa.int64()))],
                    ["_id", "n_shingles", "_set", "_bands"])
    return in_batches(docs.select(F.col(doc_id).cast("long").alias("_id"), text)).mapInArrow(
        run, "_id long, n_shingles long, _set binary, _bands array<long>")


def clusters(classes: DataFrame) -> DataFrame:
    """Classes that agree with another in a band: ``_rep``, ``_cluster``."""
    keys = classes.select("_rep", F.explode("_bands").alias("_key"))
    shared = keys.groupBy("_key").agg(F.min("_rep").alias("_low"), F.max("_rep").alias("_high")).filter("_low < _high")
    meeting = keys.join(shared.select("_key", "_low"), "_key").filter("_rep <> _low").select(F.col("_rep").alias("a"), F.col("_low").alias("b"))
    return components(meeting).select(F.col("node").alias("_rep"), F.col("component").alias("_cluster"))


def members(docs: DataFrame, clustered: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The clustered classes with their sets (little-endian 64-bit hashes), sizes and group counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_set(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], type=pa.int64()),
                     pa.array([s.tobytes() for s in sets], type=pa.binary()),
                     pa.array([group_counts(s) for s in sets], type=pa.list_(pa.int64()))], ["_rep", "_cluster", "_n", "_hashes", "_counts"])
    texts = docs.select(F.col(doc_id).cast("long").alias("_rep"), F.col(text).alias("_t"), F.xxhash64(text).alias("_x"))
    # most documents are in no cluster; a Bloom filter keeps their texts out of the shuffle
    likely = with_flag(texts, "_rep", clustered, "_rep", "_may").filter("_may").drop("_may")
    joined = likely.join(clustered, "_rep").dropDuplicates(["_rep", "_x"]).select("_rep", "_cluster", "_t")
    return in_batches(joined).mapInArrow(run, "_rep long, _cluster long, _n long, _hashes binary, _counts array<long>")


def with_blocks(found: DataFrame) -> DataFrame:
    """Members with ``_block``: 0 where a cluster fits one block, else its size strip and a part of it."""
    strip = F.floor(F.log(F.greatest("_n", F.lit(1))) / np.log(STRIP)).cast("long")
    load = lambda: [F.count("*").alias("_sets"), F.sum("_n").alias("_shingles")]
    parts = F.ceil(F.greatest(F.col("_sets") / BLOCK_SETS, F.col("_shingles") / BLOCK_SHINGLES))
    large = found.groupBy("_cluster").agg(*load()).filter(parts > 1).select("_cluster")
    strips = found.join(large, "_cluster", "left_semi").groupBy("_cluster", strip.alias("_strip")).agg(*load()).select(
        "_cluster", "_strip", parts.cast("long").alias("_parts"))
    numbered = found.withColumn("_strip", strip).join(strips, ["_cluster", "_strip"], "left")
    block = F.coalesce(F.col("_strip") * (1 << 24) + F.pmod(F.xxhash64("_rep"), F.col("_parts")) + 1, F.lit(0))
    return numbered.withColumn("_block", block).drop("_strip", "_parts")


def block_pairs(blocked: DataFrame) -> DataFrame:
    """Pairs of blocks of a cluster (``_x`` <= ``_y``) whose corners allow a link."""
    corners = stage(blocked.groupBy("_cluster", "_block").agg(
        F.min("_n").alias("_least"), F.max("_n").alias("_most"), F.array(*[F.max(F.get("_counts", F.lit(g))) for g in range(GROUPS)]).alias("_corner")), "corners")
    x = corners.select("_cluster", F.col("_block").alias("_x"), F.col("_least").alias("_lx"), F.col("_most").alias("_mx"), F.col("_corner").alias("_cx"))
    y = corners.select("_cluster", F.col("_block").alias("_y"), F.col("_least").alias("_ly"), F.col("_most").alias("_my"), F.col("_corner").alias("_cy"))
    minima = F.expr("aggregate(zip_with(_cx, _cy, (p, q) -> least(p, q)), 0L, (s, v) -> s + v)")
    return x.join(y, "_cluster").filter("_x <= _y").filter(
        (F.col("_mx") * SHARE[1] >= F.col("_ly") * SHARE[0]) & (F.col("_my") * SHARE[1] >= F.col("_lx") * SHARE[0])
        & (minima * (SHARE[0] + SHARE[1]) >= SHARE[0] * (F.col("_lx") + F.col("_ly")))).select("_cluster", "_x", "_y")


class Tree:
    """An R-tree over group counts: points sorted by size and first groups, packed into leaves and nodes.

    Only the upper corner of a node is kept, the lower one bounds no overlap; and the range of sizes below it.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((counts[:, 1], counts[:, 0], sizes))
        self.counts, self.sizes = counts[self.order], sizes[self.order]
        self.levels = []
        corner, low, high = self.counts, self.sizes, self.sizes
        width = LEAF
        while len(corner) > 1:
            starts = np.arange(0, len(corner), width)
            corner = np.maximum.reduceat(corner, starts)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((width, corner, low, high))
            width = FANOUT

    @staticmethod
    def _open(corner, low, high, point, size) -> np.ndarray:
        fits = (high * SHARE[1] >= size * SHARE[0]) & (low * SHARE[0] <= size * SHARE[1])
        return fits & (np.minimum(corner, point).sum(1) >= needed(low, size))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the points whose summed minima with ``point`` reach the overlap needed."""
        at = np.arange(len(self.levels[-1][1])) if self.levels else np.arange(len(self.sizes))
        for level in range(len(self.levels) - 1, -1, -1):
            width, corner, low, high = self.levels[level]
            at = at[self._open(corner[at], low[at], high[at], point, size)]
            below = len(self.sizes) if level == 0 else len(self.levels[level - 1][1])
            at = (at[:, None] * width + np.arange(width)).ravel()
            at = at[at < below]
        at = at[self._open(self.counts[at], self.sizes[at], self.sizes[at], point, size)]
        return self.order[at]


def links(hashes: list[bytes], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the threshold connects: sets numbered ``left`` against sets numbered ``right``."""
    sets = [np.frombuffer(h, dtype=np.uint64) for h in hashes]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    begins = np.append(0, np.cumsum(sizes))
    _, word = np.unique(np.concatenate(sets), return_inverse=True)
    counts = np.array([group_counts(s) for s in sets], dtype=np.int64)
    own, parent, out = np.zeros(word.max() + 1, dtype=bool), np.arange(len(sets)), []
    tree = Tree(counts[right], sizes[right])
    # central sets first: what they reach is connected at once
    centre = np.median(counts[right], axis=0)
    for i in left[np.argsort(np.abs(counts[left] - centre).sum(1), kind="stable")].tolist():
        met = right[tree.search(counts[i], int(sizes[i]))]
        met = met[parent[met] != parent[i]]
        if len(met) == 0:
            continue
        own[word[begins[i]:begins[i + 1]]] = True
        n = sizes[met]
        rows = np.repeat(begins[met] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        shared = np.add.reduceat(own[word[rows]].astype(np.int64), np.append(0, np.cumsum(n)[:-1]))
        own[word[begins[i]:begins[i + 1]]] = False
        for j in met[shared * SHARE[1] >= SHARE[0] * (n + sizes[i] - shared)].tolist():
            if parent[j] != parent[i]:
                out.append((i, j))
                parent[parent == parent[j]] = parent[i]
    return out


def verified(blocked: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links between classes (``a``, ``b``), at most one per set and pair of blocks."""
    task = ["_cluster", "_x", "_y"]
    first = blocked.join(pairs, (blocked["_cluster"] == pairs["_cluster"]) & (blocked["_block"] == pairs["_x"])).select(
        pairs["_cluster"], "_x", "_y", "_rep", "_hashes", F.lit(0).alias("_side"))
    second = blocked.join(pairs.filter("_x < _y"), (blocked["_cluster"] == pairs["_cluster"]) & (blocked["_block"] == pairs["_y"])).select(
        pairs["_cluster"], "_x", "_y", "_rep", "_hashes", F.lit(1).alias("_side"))

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_rep", "ascending")])
        reps, side = group.column("_rep").to_numpy(), group.column("_side").to_numpy()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if side.any() else left
        found = links(group.column("_hashes").to_pylist(), left, right) if len(left) and len(right) else []
        return pa.table({"a": pa.array([reps[i] for i, _ in found], type=pa.int64()), "b": pa.array([reps[j] for _, j in found], type=pa.int64())})

    return first.union(second).groupBy(*task).applyInArrow(join, "a long, b long")


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document id ``_id``, ``n_shingles`` and ``component_id``: the smallest id that links lead to."""
    sketched = stage(sketch(docs, doc_id, text), "sketches")
    classes = stage(sketched.filter("_id IS NOT NULL AND _set IS NOT NULL").groupBy("_set").agg(
        F.min("_id").alias("_rep"), F.min_by("_bands", "_id").alias("_bands")), "classes")
    found = stage(members(docs, stage(clusters(classes), "clusters"), doc_id, text), "members")
    found = stage(with_blocks(found), "blocks")
    linked = components(verified(found, block_pairs(found)))
    named = classes.select("_set", "_rep").join(linked.select(F.col("node").alias("_rep"), "component"), "_rep", "left").select(
        "_set", F.coalesce("component", "_rep").alias("_component"))
    return sketched.drop("_bands").join(named, "_set", "left").select(
        "_id", "n_shingles", F.coalesce("_component", "_id").alias("component_id"))


def _document(doc_id: str, text: str) -> list[Column]:
    """What tells a document in ``one_of_each``, in its order: id, null ids last, then 128 bits of hash of the text."""
    own = F.col(doc_id).cast("long")
    return [own.isNull().alias("_none"), F.coalesce(own, F.lit(0)).alias("_own"), F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def without_repeats(docs: DataFrame, told: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents, of rows that repeat id and text the first by their further columns; ``told`` has the documents with their ``_rows``."""
    repeated = stage(told.filter("_rows > 1").drop("_rows"), "repeated")
    if repeated.isEmpty():
        return docs
    names = {c: unused_name(docs, c) for c in repeated.columns}
    may, place, rest = unused_name(docs, "_may"), unused_name(docs, "_place"), [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    keyed = docs.withColumns(dict(zip(names.values(), _document(doc_id, text))))
    flagged = with_flag(keyed, names["_h1"], repeated, "_h1", may)
    # the limit of one row a document is also taken before the shuffle, so a document of very many rows is no hot key
    order = F.to_json(F.struct(*rest)) if rest else F.lit(0)
    first = flagged.filter(F.col(may)).withColumn(place, F.row_number().over(Window.partitionBy(*names.values()).orderBy(order))).filter(F.col(place) == 1)
    return stage(flagged.filter(~F.col(may)).select(docs.columns).union(first.select(docs.columns)), "single-rows")


def with_numbers(docs: DataFrame, told: DataFrame, doc_id: str, text: str, number: str) -> DataFrame:
    """The documents with a ``number`` of their own that follows the order of documents: the id, if no id is null or has several texts."""
    several = told.groupBy("_none", "_own").agg(F.count("*").alias("_texts")).filter("_none OR _texts > 1")
    if several.isEmpty():
        return docs.withColumn(number, F.col(doc_id).cast("long"))
    key = told.columns[:4]
    order = told.select(key).repartitionByRange(*key).sortWithinPartitions(*key)
    numbers = stage(order.withColumn(number, F.monotonically_increasing_id()), "numbers")
    names = {c: unused_name(docs, c) for c in key}
    for c, own in names.items():
        numbers = numbers.withColumnRenamed(c, own)
    keyed = docs.withColumns(dict(zip(names.values(), _document(doc_id, text))))
    return stage(keyed.join(numbers, list(names.values())).select(*docs.columns, number), "numbered")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: of the document with the smallest id, null ids last, and of its texts the one with the smallest hash.

    Documents are told by id and text here, so an id's texts stay or go each for itself, and null ids are linked like others.
    Rows that repeat id and text are one document and leave one row, without shingles as well.
    """
    told = stage(docs.select(_document(doc_id, text)).groupBy("_none", "_own", "_h1", "_h2").agg(F.count("*").alias("_rows")), "documents")
    number = unused_name(docs, "_number")
    numbered = with_numbers(without_repeats(docs, told, doc_id, text), told, doc_id, text, number)
    key = unused_name(numbered, "_id")
    others = stage(classify(numbered, number, text).filter("_id > component_id").select(F.col("_id").alias(key)).distinct(), "others")
    may = unused_name(numbered, "_may")
    flagged = with_flag(numbered, number, others, key, may)
    doubtful = flagged.filter(F.col(may)).drop(may)
    kept = flagged.filter(~F.col(may)).drop(may).union(doubtful.join(others, doubtful[number] == others[key], "left_anti"))
    return kept.drop(number)
