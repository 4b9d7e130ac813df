"""URL filter: rules first, then a list of canonical URLs behind a blocked Bloom filter.

A rule names a host and a path; it fits urls of that host and its subdomains whose path begins with the rule's.  The
longest fitting rule decides.  All other urls are blocked if their canonical form is listed.

The Bloom filter is built where the list lies and has a bounded size.  What passes goes to an exact hash join with the
list, which takes the false positives out, so the verdict never depends on the filter.

Canonical: scheme and leading ``www.`` dropped, host lower-cased, default ports, fragments and tracking parameters
dropped, remaining parameters sorted, trailing slashes dropped.  A url that is null or has no ``://`` has an empty host
and path, fits no rule and is not listed.  Repeated rows are judged alike; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.batches import unused_name
from tidemark.llm.bloom import MOST_BLOCKS, with_flag

# fixed values
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TRACKING = "^(utm_.*|ref|fbclid|gclid)(=|$)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The form under which urls are listed; null for a url without a host."""
    own_host = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"^www\.", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (F.length(p) > 0) & ~p.rlike(TRACKING)))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(own_host != "", F.concat(own_host, F.regexp_replace(path(url), r"/+$", ""), asked))


def rule_for(url: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, as host and path in one, and its verdict; nulls where none fits.  Rules: verdict, host, path."""
    h, p = host(url), path(url)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def block_listed(pages: DataFrame, listed: DataFrame, url: str = "url", out: str = "verdict",
                 rules: Sequence[tuple[str, str, str]] = (), most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``out`` (columns of those names are replaced); ``listed`` has a column ``url``."""
    left = pages.drop("host", "path", "rule", out)
    canon = unused_name(left, "_canonical")
    rule, verdict = rule_for(F.col(url), rules)
    judged = left.withColumns({"host": host(F.col(url)), "path": path(F.col(url)), "rule": rule, out: verdict, canon: canonical(F.col(url))})
    names = listed.select(canonical(F.col("url")).alias("_listed")).dropna().distinct()
    open_urls = judged.filter(f"`{out}` IS NULL").select(F.col(f"`{canon}`").alias("_listed")).dropna().distinct()
    passed = with_flag(open_urls, "_listed", names, "_listed", "_may", most_blocks).filter("_may")
    hits = passed.select("_listed").join(names, "_listed", "left_semi")
    hit = unused_name(left, "_hit")
    found = hits.select(F.col("_listed").alias(canon), F.lit(True).alias(hit))
    said = F.coalesce(F.col(f"`{out}`"), F.when(F.col(hit), "block").otherwise("allow")).alias(out)
    return judged.join(found, canon, "left").select(*[F.col(f"`{c}`") for c in left.columns], "host", "path", "rule", said)
