"""Registered queries of the training-data operators, with their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_pairs, collocations, curve_packing, decontaminate, jaccard_join, line_dedup, piece_counts, quality_model, quality_rules, secret_scan, token_alignment, toxicity, url_filter
from tidemark.llm.labels import fold
from tidemark.workspace import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_PAIR_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"
WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_50k.json"
CONTEXT_TOKENS = 4096
COMMON_LINE_DOCS = 10
LEAST_SCORE = 0.3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SPAM_HOSTS = r"(^|\.)(spam-farm|cheap-pills|casino-win)\."  # whose pages' urls make up the list


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(column: str):
    return F.sha2(F.coalesce(F.col(column).cast("binary"), F.lit(b"")), 256)


@query("op1_decontaminate", f"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') FROM benchmark),
sets AS (
  SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT side, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT id, count(*) AS n FROM sets WHERE side = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, any_value(n) AS n_item
FROM sets d JOIN sets b ON d.side = 'd' AND b.side = 'b' AND d.s = b.s JOIN sizes ON sizes.id = b.id
GROUP BY d.id, b.id HAVING 4 * count(*) >= 3 * any_value(n)""")
def op1_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", F.inline("found_items"))


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return _scored(toxicity.score(docs, machine, keep_text=False), fold("doc_id", 4) == 2)


def _scored(df: DataFrame, held_out) -> DataFrame:
    return df.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


@query("op3_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= {COMMON_LINE_DOCS})
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k GROUP BY doc_id""")
def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, COMMON_LINE_DOCS).select(
        "doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


@query("op4_byte_pairs")
def op4_byte_pairs(spark, sf_dir):
    path = public_tokenizers.path(BYTE_PAIR_FILE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_pairs.encode(docs, path, public_tokenizers.PATTERN, drop_text=True, decoded="decoded").select(
        "doc_id", F.expr("cast(octet_length(token_ids) div 4 as bigint)").alias("n_tokens"),
        sha256("token_ids").alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"))


@query("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    counted = stage(quality_rules.count_texts(docs, keep_text=False), "rule-counts")
    cutoffs = quality_rules.choose_cutoffs(counted, table(spark, sf_dir, "labels"))
    return quality_rules.judge(counted, cutoffs).select(
        "doc_id", *quality_rules.COUNTS[:5], "base_failed", "kept")


@query("op6_quality_model")
def op6_quality_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return _scored(quality_model.score(docs, model, keep_text=False), fold("doc_id", 5) == 0)


def _after_scheme_sql(url: str) -> str:
    return f"(CASE WHEN strpos({url}, '://') > 0 THEN substring({url}, strpos({url}, '://') + 3) ELSE '' END)"


_RULES_SQL = ", ".join(f"('{said}', '{h}', '{p}')" for said, h, p in URL_RULES)


@query("op7_url_filter", f"""
WITH urls AS (SELECT page_id, url, {_after_scheme_sql("url")} AS u FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(u, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*\\?([^#]*)', 1) AS q FROM urls),
canon AS (SELECT *, list_sort([p for p in string_split(q, '&') if length(p) > 0 AND NOT regexp_matches(p, '{url_filter.TRACKING}')]) AS kept,
  regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '') AS bare FROM parts),
named AS (SELECT page_id, host, path, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '')
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS c FROM canon),
listed AS (SELECT DISTINCT c FROM named WHERE regexp_matches(host, '{SPAM_HOSTS}') AND c IS NOT NULL),
rules(said, h, p) AS (VALUES {_RULES_SQL}),
fitting AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(said, length(h || p)) AS said
  FROM named JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT n.page_id, host, path, rule, coalesce(said, CASE WHEN listed.c IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM named n LEFT JOIN fitting f ON n.page_id = f.page_id LEFT JOIN listed ON n.c = listed.c""")
def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(url_filter.host(F.col("url")).rlike(SPAM_HOSTS)).select("url")
    return url_filter.block_listed(pages, listed, rules=URL_RULES).drop("url")


@query("op8_piece_counts")
def op8_piece_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = piece_counts.count_tokens(docs, public_tokenizers.path(PIECE_FILE))
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


@query("op9_secret_scan")
def op9_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, keep_text=False)

    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secret_scan.KINDS[:3]]
    return found.select("doc_id", *counts, F.expr(f"sha2({listed("filter(secrets, s -> s.kind <> 'markov')")}, 256)").alias("base_sha256"),
                        F.expr(listed("secrets")).alias("spans"))


@query("op10_jaccard_join", f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * met.n >= 75 * (x.n + y.n - met.n)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, s.b FROM reached r JOIN steps s ON r.other = s.a)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reached USING (doc_id) GROUP BY d.doc_id""")
def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.classify(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("_id", "doc_id")


@query("op11_curve_packing")
def op11_curve_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = curve_packing.pack(docs, public_tokenizers.path(WORD_FILE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE), public_tokenizers.PATTERN)


@query("op13_collocations", f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
counts AS (SELECT lang, w[i:i + k - 1] AS g, count(*) AS a FROM places, (VALUES (1), (2), (3), (4)) orders(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
frequent AS (SELECT * FROM counts WHERE a >= {collocations.LEAST}),
candidates AS (SELECT * FROM frequent WHERE len(g) > 1),
cuts AS (SELECT *, unnest(range(1, len(g))) AS k FROM candidates),
rated AS (SELECT c.lang, c.g, c.a, l.a AS l, r.a AS r, k, 2000000::HUGEINT * c.a // (l.a + r.a) AS score
  FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN frequent r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
lowest AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
begun AS (SELECT lang, g, a, n, unnest(range(1, len(g) - n + 2)) AS i FROM candidates, (VALUES (2), (3)) shorter(n) WHERE n < len(g)),
held AS (SELECT lang, g[i:i + n - 1] AS g, max(a) AS longer FROM begun GROUP BY ALL),
kept AS (SELECT x.*, array_to_string(x.g, ' ') AS phrase FROM lowest x LEFT JOIN held h ON h.lang = x.lang AND h.g = x.g
  WHERE longer IS NULL OR 100 * longer < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang) USING (lang) WHERE rank <= {collocations.TOP}""")
def op13_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))
