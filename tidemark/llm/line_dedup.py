"""Line deduplication, DataFrame functions only.

Lines become pairs of 64-bit hashes.  The hashes are range-partitioned together with the document, so that a
very common line spreads over many partitions, and sorted by hash, document and position; the first occurrence
of a line in each document streams out of that order, and documents are counted from those.  What comes back
is no text: per document, a bitmap of the lines to drop, 64 lines a word, only words with a bit set.

A line's key is the line without the six ASCII white-space characters at its ends, A-Z lower-cased; lines whose
key is empty are always kept.  A null or empty text is one empty line.  A document is told by its id and its
text: rows that repeat both count once and lose the same lines; rows with equal ids and different texts do not
disturb each other, and a null id is an id like any other.  All further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.batches import unused_name
from tidemark.workspace import stage

# fixed values
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_ID = -(2**63)

DOCUMENT = ("_id", "_text")  # id and hash of the text
KEY = ("_h1", "_h2")  # 128 bits: two lines of a corpus do not meet by chance


def document(doc_id: str, text: str) -> list[Column]:
    """What tells a document: its id and a hash of its text."""
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a key: document, position from 0 on, hashes of the key."""
    keys = F.transform(_lines(F.translate(text, UPPER, UPPER.lower())), lambda line: F.btrim(line, F.lit(BLANKS)))
    lines = docs.select(*document(doc_id, text), F.posexplode(keys).alias("_pos", "_key")).filter("length(_key) > 0")
    return lines.select(*DOCUMENT, "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))


def repeated_lines(docs: DataFrame, min_docs: int, doc_id: str = "doc_id", text: str = "text",
                   keep_first: bool = False) -> DataFrame:
    """The lines to drop (document, position; once per row that repeats them): those whose key stands in at least ``min_docs`` documents.

    With ``keep_first`` the occurrence with the smallest (id, text hash, position) stays.
    """
    lines = stage(line_hashes(docs, doc_id, text), "line-hashes")
    spread = lines.repartitionByRange(*KEY, *DOCUMENT).sortWithinPartitions(*KEY, *DOCUMENT, "_pos")
    place = F.row_number().over(Window.partitionBy(*KEY, *DOCUMENT).orderBy("_pos"))
    firsts = spread.withColumn("_place", place).filter("_place = 1")
    common = firsts.groupBy(*KEY).agg(F.count("*").alias("_docs"), F.min(F.struct(*DOCUMENT, "_pos")).alias("_first")).filter(
        F.col("_docs") >= min_docs)
    dropped = lines.join(common, list(KEY))
    if keep_first:
        dropped = dropped.filter(F.struct(*DOCUMENT, "_pos") != F.col("_first"))
    return dropped.select(*DOCUMENT, "_pos")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """Per document the words of its bitmap: entry i holds lines 64i to 64i + 63, the lowest bit first; up to the last set bit."""
    words = dropped.groupBy(*DOCUMENT, F.expr("_pos div 64").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_pos % 64 as int))")).alias("_bits"))
    packed = words.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_set"))
    by_word = packed.select(*DOCUMENT, F.map_from_entries("_set").alias("_by_word"), F.expr("cast(_set[size(_set) - 1]._word as int)").alias("_last"))
    return by_word.select(*DOCUMENT, F.expr("transform(sequence(0, _last), i -> coalesce(_by_word[cast(i as bigint)], 0L))").alias("_drop"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, doc_id: str = "doc_id", text: str = "text",
                keep_first: bool = False) -> DataFrame:
    """The documents without their repeated lines, with the number of lines before (``n_lines``) and dropped (``n_dropped``).

    Columns of those two names are replaced.
    """
    bitmaps = drop_bitmaps(repeated_lines(docs, min_docs, doc_id, text, keep_first))
    left = docs.drop("n_lines", "n_dropped")
    names = {c: unused_name(left, c) for c in (*DOCUMENT, "_drop")}
    for c, own in names.items():
        bitmaps = bitmaps.withColumnRenamed(c, own)
    id_column, text_column = document(doc_id, text)
    keyed = left.withColumns({names["_id"]: id_column, names["_text"]: text_column})
    joined = keyed.join(bitmaps, [names["_id"], names["_text"]], "left")
    drop = f"`{names['_drop']}`"
    lines = f"split(coalesce(`{text}`, ''), '\\n', -1)"
    kept = (f"CASE WHEN {drop} IS NULL THEN `{text}` ELSE array_join(filter({lines}, (line, i) -> "
            f"(coalesce(get({drop}, i div 64), 0L) & shiftleft(1L, i % 64)) = 0L), '\\n') END")
    count = f"coalesce(aggregate({drop}, 0L, (n, w) -> n + bit_count(w)), 0L)"
    return joined.select(*[F.expr(kept).alias(c) if c == text else F.col(f"`{c}`") for c in left.columns],
                         F.expr(f"cast(size({lines}) as bigint)").alias("n_lines"), F.expr(count).alias("n_dropped"))
