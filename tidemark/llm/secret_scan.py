"""Secret scan, DataFrame functions only: patterns, and two character Markov models.

Patterns find assignments, access keys and hex strings.  Their finds are labelled samples of random strings, the other
long words of the corpus samples of ordinary identifiers (but for those to be judged); both are counted as character pairs over all documents.
A long word of letters and digits whose log-likelihood under the random model exceeds that under the ordinary one by
``LEAST_RATIO`` is reported as well, unless it overlaps a pattern's find, which always stays.  Without samples of
either class only patterns report.

Matches carry no offsets in SQL, so a text is split at the matches: a span begins after all pieces and matches before
it.  Only lengths and matched words leave a document; they are summed per document, so a long text is one short list.

Offsets count code points, the end exclusive.  A null text is empty.  Documents are told by id and text: rows that
repeat both get the same spans; further columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.batches import unused_name
from tidemark.llm.line_dedup import DOCUMENT, document
from tidemark.workspace import stage

# fixed values
KINDS = ("assign", "access", "hex", "markov")
NAMED = r"(?i:(password|passwd|secret|token|api_?key))"
ASSIGN = NAMED + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}+"
LEAST_VALUE = 8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."

LEAST_LENGTH = 20  # characters of a word that the models judge
LEAST_RATIO = 10.0
JUDGED = f"length(value) >= {LEAST_LENGTH} AND value RLIKE '[0-9]' AND value RLIKE '[A-Za-z]'"
PSEUDO_COUNT = 5.0  # weight of how often a character ends any pair, in the ordinary model
RANDOM_PRIOR = 500.0  # weight of "all characters alike" in the random model


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'"


def _matches(kind: int, pattern: str, value_group: int, only_if: str) -> str:
    """SQL for an array with one entry per match: kind, number, length of the piece before it, its length, its value."""
    p = _quoted(pattern)
    zipped = f"arrays_zip(split(_t, {p}, -1), regexp_extract_all(_t, {p}, 0), regexp_extract_all(_t, {p}, {value_group}))"
    entry = (f"named_struct('kind', {kind}, 'number', i, 'lead', length(m.`0`), 'width', length(m.`1`), 'value', m.`2`)")
    return (f"CASE WHEN _t RLIKE {_quoted(only_if)} THEN filter(transform({zipped}, (m, i) -> {entry}), e -> e.width IS NOT NULL) "
            f"ELSE cast(array() AS array<struct<kind: int, number: int, lead: int, width: int, value: string>>) END")


def matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All matches with their spans, one row each: document, kind (its place in KINDS, 3 for a word), start, end, value."""
    found = ", ".join([_matches(0, ASSIGN, 2, NAMED), _matches(1, ACCESS, 0, ACCESS), _matches(2, HEX, 0, HEX), _matches(3, WORD, 0, WORD)])
    texts = docs.select(*document(doc_id, text), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = texts.select(*DOCUMENT, F.expr(f"inline(concat({found}))")).repartition(*DOCUMENT).dropDuplicates([*DOCUMENT, "kind", "number"])
    so_far = Window.partitionBy(*DOCUMENT, "kind").orderBy("number")
    return rows.withColumn("end", F.sum(F.col("lead") + F.col("width")).over(so_far)).select(
        *DOCUMENT, "kind", (F.col("end") - F.col("width")).alias("start"), "end", "value")


def passing(found: DataFrame) -> DataFrame:
    """Pattern finds that are long enough, and words that overlap none of them."""
    good = found.filter(f"kind > 0 OR length(value) >= {LEAST_VALUE}")
    by_start = Window.partitionBy(*DOCUMENT).orderBy("start")
    before = F.max(F.expr("CASE WHEN kind < 3 THEN end END")).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.expr("CASE WHEN kind < 3 THEN start END")).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    return good.withColumns({"_before": before, "_after": after}).filter(
        "kind < 3 OR (coalesce(_before, 0) <= start AND coalesce(_after, end) >= end)").drop("_before", "_after")


def pair_counts(found: DataFrame) -> DataFrame:
    """Counts of neighbouring characters in random (1) and ordinary (0) samples; at most the square of ALPHABET rows each.

    Words that the models will judge are samples of neither.
    """
    chars = found.filter(f"kind < 3 OR NOT ({JUDGED})").select(F.expr("int(kind < 3)").alias("random"), F.expr("filter(split(value, ''), c -> c <> '')").alias("c"))
    pairs = chars.filter("size(c) > 1").select(
        "random", F.expr("inline(transform(arrays_zip(slice(c, 1, size(c) - 1), slice(c, 2, size(c) - 1)), p -> named_struct('a', p.`0`, 'b', p.`1`)))"))
    return pairs.groupBy("random", "a", "b").count()


def log_ratios(counts: Sequence) -> list[float] | None:
    """log P(b after a | random) - log P(b after a | ordinary), row by row of ALPHABET; None without samples of both classes."""
    size = len(ALPHABET)
    seen = [[[0.0] * size for _ in range(size)] for _ in range(2)]
    for r in counts:
        a, b = ALPHABET.find(r["a"]), ALPHABET.find(r["b"])
        if a >= 0 and b >= 0:
            seen[r["random"]][a][b] += r["count"]
    if not all(any(map(any, table)) for table in seen):
        return None

    ordinary, random = seen
    ends = [sum(row[b] for row in ordinary) + PSEUDO_COUNT / size for b in range(size)]
    usual = [n / sum(ends) for n in ends]

    def log_p(row, b, prior, weight):
        return math.log((row[b] + weight * prior) / (sum(row) + weight))
    return [log_p(random[a], b, 1 / size, RANDOM_PRIOR) - log_p(ordinary[a], b, usual[b], PSEUDO_COUNT) for a in range(size) for b in range(size)]


def likelier_random(found: DataFrame, ratios: list[float] | None) -> DataFrame:
    """Pattern finds, and the words that the models tell to be random."""
    if ratios is None:
        return found.filter("kind < 3")
    table = "array(" + ", ".join(f"{r!r}D" for r in ratios) + ")"
    code = f"(instr('{ALPHABET}', c) - 1)"
    total = (f"aggregate(filter(split(value, ''), c -> c <> ''), named_struct('at', -1, 'total', 0D), (s, c) -> named_struct('at', {code}, "
             f"'total', s.total + CASE WHEN s.at < 0 THEN 0D ELSE get({table}, s.at * {len(ALPHABET)} + {code}) END), s -> s.total)")
    return found.filter(f"kind < 3 OR ({JUDGED} AND {total} >= {LEAST_RATIO})")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "secrets", keep_text: bool = True) -> DataFrame:
    """The documents with an array ``out`` of spans (kind, start, end), by start and then by kind (an existing column is replaced)."""
    found = passing(stage(matches(docs, doc_id, text), "secret-matches"))
    told = likelier_random(found, log_ratios(pair_counts(found).collect()))
    spans = told.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("_spans"))
    left = docs.drop(out)
    names = {c: unused_name(left, c) for c in (*DOCUMENT, "_spans")}
    for c, own in names.items():
        spans = spans.withColumnRenamed(c, own)
    keyed = left.withColumns(dict(zip([names[c] for c in DOCUMENT], document(doc_id, text))))
    keyed = keyed if keep_text else keyed.drop(text)
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    listed = f"transform(coalesce(`{names['_spans']}`, array()), s -> named_struct('kind', get({kinds}, s.kind), 'start', s.start, 'end', s.end))"
    return keyed.join(spans, [names[c] for c in DOCUMENT], "left").select(
        *[F.col(f"`{c}`") for c in left.columns if keep_text or c != text], F.expr(listed).alias(out))
