"""Small documents with every awkward case, and brute-force helpers."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# columns that the operators use themselves, to clash with
CLASHING = ("_id", "_text", "_drop", "_canonical", "_hit", "_stratum", "_cutoffs", "_t", "n_lines", "n_words", "kept", "score",
            "token_ids", "decoded", "found_items", "secrets", "component_id", "_pos", "_h1", "kind", "start", "number")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def prose(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(n))


def texts(seed=3):
    rng = random.Random(seed)
    base = prose(rng, 120)
    words = base.split()
    near = [" ".join(words[:i] + ["zzz"] + words[i + 1:]) for i in (3, 60, 110)]
    lines = "\n".join([prose(rng, 9) for _ in range(6)] + ["Same LINE here ", " same line here\t", "", "  "])
    return [None, "", " ", "\n", "\n\n a", "one", "one two three", "\x0b\x0c\r\t x", base, base, *near, lines, lines.upper(),
            "ñandú Éa b 😀   x\x00y", "a" * 5000, "ab " * 3000, "token = 'abcdefgh12345678'", prose(rng, 200_000),
            *[f"common line\n{prose(rng, 60)}\n{prose(rng, 3)}" for _ in range(12)]]


def documents(spark, clash=False, seed=3):
    rows = [(i, t, ("en", "de", None)[i % 3], "s", None) for i, t in enumerate(texts(seed))]
    rows += [rows[8], rows[8], (None, "a text without an id", None, None, None), (5, "another text with a used id", "en", "s", 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(7).cast("long").alias(c) for c in CLASHING])
    return df


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
