"""A corpus pipeline of five stages: quality rules, line dedup, near duplicates, decontamination, token ids.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of their docs, which keep their values whatever they are called:

* quality rules: documents that fail the base rules or a certified cutoff go;
* line dedup: of a line that stands in ten documents or more only the first occurrence stays; documents that lose lines
  and have too few words for the base rules left go, those that lose none stay;
* near duplicates: of documents linked by a word-shingle similarity of 0.75 or more the one with the smallest id stays,
  rows that repeat id and text stay once;
* decontamination: documents that hold three quarters of a benchmark item's shingles go;
* token ids: all columns, and ``n_tokens`` and ``token_ids`` (little-endian 32-bit numbers; columns of these names are
  replaced); ``text`` is what the ids decode to.

Null and empty texts have no words and fail the first stage.  An empty table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_pairs, decontaminate, jaccard_join, line_dedup, quality_rules
from tidemark.workspace import stage

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
COMMON_LINE_DOCS = 10
READ = ("doc_id", "lang", "text")  # what operators read
REST = "_rest_of_row"


def carried(docs: DataFrame) -> DataFrame:
    """What operators read, and all other columns as one that none of them touches."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in READ] or [F.lit(0).alias("_none")]
    return docs.select(*READ, F.struct(*rest).alias(REST))


def restored(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in READ else F.col(f"{REST}.`{c}`") for c in columns])


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counted = stage(quality_rules.count_texts(carried(docs)), "rule-counts")
    cutoffs = stage(quality_rules.choose_cutoffs(counted, spark.read.parquet(f"{sf_dir}/labels.parquet")), "rule-cutoffs")  # then its size is known
    return restored(quality_rules.judge(counted, cutoffs).filter("kept"), docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(carried(docs), COMMON_LINE_DOCS, keep_first=True)
    words = F.size(F.filter(F.split("text", f"[{line_dedup.BLANKS}]+"), lambda w: w != ""))
    remnant = F.when(F.col("n_dropped") > 0, words < quality_rules.LEAST_WORDS).otherwise(False)
    return restored(left.filter(~remnant), docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = decontaminate.without_items(carried(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return restored(clean, docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    decoded = byte_pairs.encode(carried(docs), path, public_tokenizers.PATTERN, drop_text=True, decoded="decoded")
    own = [c for c in docs.columns if c.lower() not in ("text", "n_tokens", "token_ids")]
    return decoded.select(*[F.col(c) if c in READ else F.col(f"{REST}.`{c}`") for c in own],
                          F.expr("cast(octet_length(token_ids) div 4 as bigint)").alias("n_tokens"),
                          "token_ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES = [("quality_rules", keep_by_rules), ("line_dedup", dedup_lines), ("jaccard_join", one_of_near_copies),
          ("decontaminate", decontaminated), ("byte_pairs", token_ids)]

# the certified cutoffs of the first stage are not expressible in SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
