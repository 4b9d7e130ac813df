"""Quality rules with risk-controlled thresholds.

Every rule is a ratio of two counts of a document, the larger the worse, on a grid of ``STEPS`` levels a unit.
Cutoffs are chosen per stratum (language) from labelled documents, half of which propose and half certify:

* A cutoff is certified if an exact binomial test on the certifying half rejects "it refuses more than ``alpha`` /
  (number of rules) of the good documents".  Cutoffs are tested from the most lenient on and testing stops at the
  first failure (fixed sequence), so only strata times rules need correcting: each is tested at ``delta`` divided
  by their number (Bonferroni).  With probability 1 - delta, no stratum loses more than ``alpha`` of its good documents.
* Among certified cutoffs the proposing half decides: refused bad documents less ``PRICE`` times refused good ones.

A rule without a certified and useful cutoff is off in that stratum; with few labels all documents pass.

Null texts have no words.  A null stratum is a stratum of its own.  Labels that are null or of unknown documents
are ignored; a document labelled several times counts once, as bad if any label says so.  Repeated rows are judged alike.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.batches import in_batches, slices, unused_name

# fixed values
WORD = re.compile("[^\x20\x09-\x0D]+")
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = b"\x20\x09\x0A\x0B\x0C\x0D"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
RULES = {  # ratio: counts above and below
    "symbols": ("n_symbols", "n_words"), "repeated_lines": ("n_dup_lines", "n_lines"), "repeated_words": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}
STEPS, TOP = 50, 2000
ALPHA, DELTA, PRICE = 0.05, 0.05, 20


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of a text, in the order of COUNTS."""
    if not text:
        return (0,) * len(COUNTS)
    words = WORD.findall(text)
    raw = text.encode()
    lines = text.split("\n")
    distinct = set(lines)
    repeated_lines = 0
    if len(distinct) < len(lines):
        repeated_lines = sum(map(_has_word, lines)) - sum(map(_has_word, distinct))
    return (len(words), sum(map(len, words)), len(raw) - len(raw.translate(None, SYMBOLS)), repeated_lines,
            repeated_words(words), len(lines), len(raw) - len(raw.translate(None, CAPITALS)))


def _has_word(line: str) -> bool:
    return WORD.search(line) is not None


def repeated_words(words: list[str]) -> int:
    """Words that stand in a window of three words that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, again = set(), set()
    for w in windows:
        (again if w in seen else seen).add(w)
    end = total = 0
    for i, w in enumerate(windows):
        if w in again:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def count_texts(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with the counts of their texts; columns of those names are replaced."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in COUNTS and (keep_text or f.name != text)]
    at = docs.columns.index(text)
    picked = [docs.columns.index(f.name) for f in kept]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                counted = zip(*[text_counts(t) for t in part.column(at).to_pylist()]) if part.num_rows else [[]] * len(COUNTS)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in picked], *[pa.array(c, type=pa.int64()) for c in counted]],
                                                 [f.name for f in schema.fields])

    return in_batches(docs).mapInArrow(run, schema)


def _level(rule: str) -> Column:
    above, below = RULES[rule]
    return F.expr(f"CASE WHEN {below} > 0 THEN least({STEPS} * {above} div {below}, {TOP}) ELSE 0 END")


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p): the regularised incomplete beta function, so its cost does not grow with n."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    return _beta(n - k, k + 1, 1 - p)


def _beta(a: float, b: float, x: float) -> float:
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 100_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + term * d or tiny)
            c = 1 + term / c or tiny
            value *= d * c
        if abs(d * c - 1) < 1e-13:
            break
    return front * value


def certified_cutoff(levels: np.ndarray, good: np.ndarray, bad: np.ndarray, certify: np.ndarray, alpha: float, level: float) -> int | None:
    """The chosen cutoff (documents at or above it are refused) from counts per level, or None."""
    order = np.argsort(levels)[::-1]
    refused = np.cumsum(certify[order])
    certified = 0
    while certified < len(order) and binomial_tail(int(refused[certified]), int(certify.sum()), alpha) <= level:
        certified += 1
    gain = (np.cumsum(bad[order]) - PRICE * np.cumsum(good[order]))[:certified]
    if len(gain) == 0 or gain.max() <= 0:
        return None
    return int(levels[order][int(np.argmax(gain))])


def choose_cutoffs(counted: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", quality: str = "quality",
                   alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a useful certified cutoff: ``_stratum`` and a map ``_cutoffs`` from rule to level."""
    marks = labels.select(F.col(doc_id).alias("_id"), F.col(quality).alias("_good")).dropna().groupBy("_id").agg(F.min("_good").alias("_good"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), _level(r).cast("int").alias("level")) for r in RULES])
    levels = counted.filter(~base_failed()).select(
        F.col(doc_id).alias("_id"), F.col(stratum).cast("string").alias("_stratum"), rules.alias("_rules"),
        F.expr(f"crc32(cast({doc_id} as string)) % 2 = 0").alias("_certify"))
    known = levels.join(marks, "_id").dropDuplicates(["_id"]).select("_stratum", "_certify", "_good", F.inline("_rules"))
    told = lambda c: F.count(F.when(F.expr(c), 1))
    tallies = known.groupBy("_stratum", "rule", "level").agg(
        told("not _certify and _good = 1").alias("good"), told("not _certify and _good = 0").alias("bad"),
        told("_certify and _good = 1").alias("certify"))
    tests = tallies.groupBy().agg(F.count_distinct(F.coalesce("_stratum", F.lit("\x00")))).first()[0] * len(RULES)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        cut = certified_cutoff(*[group[c].to_numpy() for c in ("level", "good", "bad", "certify")], alpha / len(RULES), delta / max(1, tests))
        return group.head(0 if cut is None else 1).assign(level=cut)[["_stratum", "rule", "level"]]

    chosen = tallies.groupBy("_stratum", "rule").applyInPandas(choose, "_stratum string, rule string, level int")
    return chosen.groupBy("_stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "level"))).alias("_cutoffs"))


def judge(counted: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """The counted documents with ``base_failed`` and ``kept`` (columns of those names are replaced)."""
    left = counted.drop("base_failed", "kept")
    key, rule_map = unused_name(left, "_stratum"), unused_name(left, "_cutoffs")
    cutoffs = cutoffs.select(F.col("_stratum").alias(key), F.col("_cutoffs").alias(rule_map))
    joined = left.join(cutoffs, F.col(f"`{stratum}`").cast("string").eqNullSafe(F.col(key)), "left")
    refused = F.lit(False)
    for r in RULES:
        refused = refused | (_level(r) >= F.coalesce(F.col(f"`{rule_map}`")[r], F.lit(TOP + 1)))
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], base_failed().alias("base_failed"), (~base_failed() & ~refused).alias("kept"))
