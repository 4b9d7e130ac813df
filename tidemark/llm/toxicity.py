"""Toxicity by a factorization machine over hashed terms.

A document is the set of its distinct lower-cased letter runs and of their beginnings (inflected and compound words
share one), hashed.  The machine
adds a weight per term and, for every pair of terms in a document, the product of their factors: what an insult
weighs may depend on whom it meets.  Pair sums are computed in time linear in the terms.

Training uses at most ``SAMPLE`` labelled documents, drawn by a hash of their ids (of an id with several texts the one with
the smallest hashes), and one of those that are near copies.  The model's features, ``FEATURES`` at most, are the terms that tell
the classes apart (a z-score over ``LEAST_Z`` between the shares of documents that have them) and, of the ``PAIRED`` most
frequent terms, those of pairs that tell them apart better than either term does: a term that is balanced between the classes and matters only
next to another one is a feature too.  The model is a few arrays of fixed size; scoring is one pass.  Only the text enters a score.

Null and empty texts get the score of a document without terms; a training set of one class gives that class's share
as everyone's score.  Repeated rows score alike; further columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.batches import in_batches, mix, shingle_set, slices, word_hashes
from tidemark.llm.labels import labelled_sample

TERM = re.compile(r"[^\W\d_]+")
SAMPLE = 12_000  # labelled documents that training reads at most
BEGINNINGS = (4, 6)  # letters
FEATURES = 1 << 14
LEAST_Z = 4.0
PAIRED = 1024
FACTORS = 8
EPOCHS = 12
SEED = 11


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's terms: words and, marked as such, how words begin."""
    words = set(TERM.findall((text or "").lower()))
    begins = {"^" + w[:n] for n in BEGINNINGS for w in words if len(w) > n}
    return np.unique(word_hashes(" ".join([*words, *begins])))


def near_copy_marks(text: str | None) -> tuple[int, ...]:
    """Three MinHashes over word shingles; training takes one of the documents that share any."""
    hashes = shingle_set(text)
    if len(hashes) == 0:
        return ()
    return tuple(int(mix(hashes ^ np.uint64(k)).min() >> np.uint64(1)) for k in (1, 2, 3))


class Machine:
    """Sorted term hashes, their weights and factors, and a bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, factors: np.ndarray, bias: float):
        self.keys, self.weights, self.factors, self.bias = keys, weights, factors, bias

    def features(self, hashes: np.ndarray) -> np.ndarray:
        if len(self.keys) == 0 or len(hashes) == 0:
            return np.empty(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return at[self.keys[at] == hashes]

    def score(self, text: str | None) -> float:
        x = self.features(terms(text))
        v = self.factors[x]
        pairs = ((v.sum(0) ** 2) - (v ** 2).sum(0)).sum() / 2
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[x].sum() + pairs, -30, 30))))


def _z(with_mark: np.ndarray, having: np.ndarray, marked: float, n: int) -> np.ndarray:
    """z-scores of the difference between the shares of marked and of other documents that have something."""
    share, pooled = with_mark / marked - (having - with_mark) / (n - marked), having / n
    return np.abs(share) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / marked + 1 / (n - marked)))


def telling_terms(docs: list[np.ndarray], marks: np.ndarray) -> np.ndarray:
    """Sorted hashes of the terms whose shares in the two classes, alone or in a pair, differ most."""
    if not docs or marks.min() == marks.max():
        return np.empty(0, dtype=np.uint64)
    keys, having = np.unique(np.concatenate(docs), return_counts=True)
    marked, times = np.unique(np.concatenate([d for d, m in zip(docs, marks) if m]), return_counts=True)
    with_mark = np.zeros(len(keys))
    with_mark[np.searchsorted(keys, marked)] = times
    z = _z(with_mark, having, marks.sum(), len(marks))
    frequent = np.sort(np.lexsort((keys, -having))[:PAIRED])
    z[frequent] = np.maximum(z[frequent], pair_gains(docs, marks, keys[frequent], z[frequent]))
    ranked = np.lexsort((keys, -z))
    return np.sort(keys[ranked[z[ranked] >= LEAST_Z][:FEATURES]])


def pair_gains(docs: list[np.ndarray], marks: np.ndarray, keys: np.ndarray, z: np.ndarray) -> np.ndarray:
    """By how much each term's best pair tells the classes apart better than either of its terms."""
    present = np.zeros((len(docs), len(keys)), dtype=np.float32)
    for row, d in zip(present, docs):
        row[np.flatnonzero(np.isin(keys, d, assume_unique=True))] = 1
    both, both_marked = present.T @ present, present[marks > 0].T @ present[marks > 0]
    gains = _z(both_marked.astype(float), both.astype(float), marks.sum(), len(marks)) - np.maximum(z[:, None], z[None, :])
    np.fill_diagonal(gains, 0)
    return gains.max(axis=1)


def fit(docs: list[np.ndarray], marks: np.ndarray) -> Machine:
    """Logistic loss, AdaGrad over single documents in a fixed random order, shrinking weights and factors."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    keys = telling_terms(docs, marks)
    base = (marks.sum() + 0.5) / (len(marks) + 1) if len(marks) else 0.5
    machine = Machine(keys, np.zeros(len(keys)), rng.normal(0, 0.01, (len(keys), FACTORS)), float(np.log(base / (1 - base))))
    if len(keys) == 0:
        return machine
    rows = [machine.features(d) for d in docs]
    w, v = machine.weights, machine.factors
    seen_w, seen_v, seen_b = np.full(len(keys), 1e-2), np.full(v.shape, 1e-2), 1e-2
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            vx = v[x]
            total = vx.sum(0)
            z = machine.bias + w[x].sum() + (total ** 2 - (vx ** 2).sum(0)).sum() / 2
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - marks[i]
            gw, gv = miss + 1e-4 * w[x], miss * (total - vx) + 1e-3 * vx
            seen_w[x] += gw ** 2
            seen_v[x] += gv ** 2
            seen_b += miss ** 2
            w[x] -= 0.1 * gw / np.sqrt(seen_w[x])
            v[x] -= 0.03 * gv / np.sqrt(seen_v[x])
            machine.bias -= 0.05 * miss / np.sqrt(seen_b)
    return machine


def train(docs: DataFrame, labels: DataFrame, training: Column, mark: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          limit: int = SAMPLE) -> Machine:
    """Fit on a sample of the labelled documents: at most ``limit`` ids are broadcast, their terms come to the driver."""
    sample = labelled_sample(labels, mark, training, limit, doc_id)
    picked = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")

    def hashed(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([terms(t).tobytes() for t in texts], type=pa.binary()),
                     pa.array([near_copy_marks(t) for t in texts], type=pa.list_(pa.int64()))], ["_id", "_mark", "_terms", "_copies"])

    rows = in_batches(picked).mapInArrow(hashed, T.StructType([
        T.StructField("_id", T.LongType()), T.StructField("_mark", T.IntegerType()), T.StructField("_terms", T.BinaryType()),
        T.StructField("_copies", T.ArrayType(T.LongType()))]))
    one = rows.groupBy("_id").agg(F.min(F.struct("_terms", "_mark", "_copies")).alias("_one")).select("_id", "_one.*")  # limit rows, whatever repeats
    met, own, marks = set(), [], []
    for row in one.toPandas().sort_values("_id").itertuples():
        if met.isdisjoint(row[4]):
            own.append(np.frombuffer(row[2], dtype=np.uint64))
            marks.append(row[3])
        met.update(row[4])
    return fit(own, np.array(marks, dtype=float))


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score", keep_text: bool = True) -> DataFrame:
    """The documents with a column ``out``: the probability that they are toxic (an existing column of that name is replaced)."""
    kept = [f for f in docs.schema.fields if f.name.lower() != out.lower() and (keep_text or f.name != text)]
    at = docs.columns.index(text)
    picked = [docs.columns.index(f.name) for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                scores = pa.array([shared.value.score(t) for t in part.column(at).to_pylist()], type=pa.float64())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in picked], scores], [f.name for f in schema.fields])

    return in_batches(docs).mapInArrow(run, schema)
