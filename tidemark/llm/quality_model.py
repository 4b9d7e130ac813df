"""Quality classifier: random indexing, pooling, a two-layer network, calibrated probabilities.

Random indexing gives every word bucket a fixed sparse vector of a few +1 and -1; a bucket's context vector is the
sum of the vectors of its neighbours over the whole corpus.  Each partition adds up its own cells, the sums of
partitions are added by Spark, and what comes to the driver has a fixed size (``BUCKETS`` x ``WIDTH`` numbers).
A document is pooled: the frequency-weighted mean of its words' context vectors, beside the mean of their own sparse
vectors.  A network of two layers, trained in numpy on at most ``SAMPLE`` labelled documents (one of those that are
near copies), turns that into a score; a temperature fitted on documents left out of training calibrates it.

Some words stand for form: words seen before in the same three-word window or right before, capitals, runs of symbols.
Their own vectors have a place of their own.  Only the text enters a score.

Null and empty texts are pooled as zeros; a training set of one class gives that class's share as everyone's score.
Repeated rows score alike; further columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.batches import in_batches, mix, shingle_set, slices, word_hashes
from tidemark.llm.labels import labelled_sample

BUCKETS, WIDTH, NONZEROS = 1 << 13, 32, 4
FORMS = 4  # buckets and places kept for form: repeated, stuttered, capitals, symbols
REACH = (1, 2)  # neighbours on either side
SMOOTH = 1e-3  # a word with this share of the corpus counts half
SAMPLE = 12_000  # labelled documents that training reads at most
HIDDEN, EPOCHS, RATE, DECAY, SEED = 24, 60, 3e-3, 1e-3, 5
PERIOD = 1 << 15  # words that are taken at a time

SYMBOLS = re.compile(r"[^\w\s.,;:'\"()?-]+")
CAPITALS = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{2,}")
MARKS = ("\u00a4c", "\u00a4s")

_draw = np.random.Generator(np.random.PCG64(77))
PLACES = _draw.integers(FORMS, WIDTH, (BUCKETS, NONZEROS))
SIGNS = _draw.choice([-1, 1], (BUCKETS, NONZEROS))
PLACES[:FORMS] = np.arange(FORMS)[:, None]
SIGNS[:FORMS] = [[1, 0, 0, 0]] * FORMS
OWN = np.zeros((BUCKETS, WIDTH))
np.add.at(OWN, (np.arange(BUCKETS)[:, None], PLACES), SIGNS)
PLACES, SIGNS = np.vstack([PLACES, np.zeros((1, NONZEROS), dtype=int)]), np.vstack([SIGNS, np.zeros((1, NONZEROS), dtype=int)])
GAP = np.full(REACH[-1], BUCKETS)  # a bucket beyond the others, without a vector
_MARK_HASHES = np.concatenate([word_hashes(m) for m in MARKS])


def buckets(text: str | None) -> np.ndarray:
    """The text as word buckets, those of form included."""
    if not text:
        return np.empty(0, dtype=np.int64)
    marked = SYMBOLS.sub(rf" {MARKS[1]} \g<0> ", CAPITALS.sub(rf" {MARKS[0]} \g<0>", text))
    words = word_hashes(marked)
    out = (FORMS + words % np.uint64(BUCKETS - FORMS)).astype(np.int64)
    if len(words) > 2:
        windows = mix(words[:-2] * np.uint64(3) + mix(words[1:-1] * np.uint64(5) + words[2:]))
        first = np.zeros(len(windows), dtype=bool)
        first[np.unique(windows, return_index=True)[1]] = True
        out[2:][~first] = 0
    out[1:][words[1:] == words[:-1]] = 1
    for k, h in enumerate(_MARK_HASHES):
        out[words == h] = 2 + k
    return out


def context_cells(docs: DataFrame, text: str = "text") -> DataFrame:
    """Sums over all documents: cell (bucket * (WIDTH + 1) + place, the last place counts the bucket) and total."""
    def run(batches):
        table = np.zeros((BUCKETS + 1, WIDTH + 1))
        for batch in batches:
            for part in slices(batch, 64):
                held, size = [GAP], 0
                for b in map(buckets, part.column(0).to_pylist()):
                    held += [b, GAP]
                    size += len(b)
                    if size >= PERIOD:
                        _add_words(table, np.concatenate(held))
                        held, size = [GAP], 0
                if size:
                    _add_words(table, np.concatenate(held))
        cells = table[:BUCKETS].ravel()
        used = np.flatnonzero(cells)
        for at in range(0, len(used), 50_000):
            own = used[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(own, type=pa.int32()), pa.array(cells[own].astype(np.int64))], ["cell", "total"])

    return in_batches(docs.select(text)).mapInArrow(run, "cell int, total long").groupBy("cell").agg(F.sum("total").alias("total"))


def _add_words(table: np.ndarray, b: np.ndarray) -> None:
    """Add to each word's row the sparse vectors of its neighbours, and one to its count; gaps keep documents apart."""
    side = REACH[-1]
    for at in range(side, len(b) - side, PERIOD):
        end = min(at + PERIOD, len(b) - side)
        here = b[at:end] * (WIDTH + 1)
        beside = [b[at + k:end + k] for reach in REACH for k in (-reach, reach)]
        cells = np.concatenate([(here[:, None] + PLACES[there]).ravel() for there in beside] + [here + WIDTH])
        signs = np.concatenate([SIGNS[there].ravel() for there in beside] + [np.ones(len(here))])
        table += np.bincount(cells, weights=signs, minlength=table.size).reshape(table.shape)


class Vectors:
    """Weighted context vectors and weights of all buckets."""

    def __init__(self, cells: np.ndarray, totals: np.ndarray):
        table = np.zeros(BUCKETS * (WIDTH + 1))
        table[cells] = totals
        table = table.reshape(BUCKETS, WIDTH + 1)
        count, context = table[:, WIDTH], table[:, :WIDTH]
        share = count / max(1.0, count.sum())
        self.weight = SMOOTH / (SMOOTH + share)
        unit = context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
        self.context = unit - (unit * share[:, None]).sum(0)

    def pool(self, text: str | None) -> np.ndarray:
        b = buckets(text)
        if len(b) == 0:
            return np.zeros(2 * WIDTH + 1)
        used, times = np.unique(b, return_counts=True)
        w = self.weight[used] * times
        return np.concatenate([(w / w.sum()) @ self.context[used], (times / len(b)) @ OWN[used], [np.log1p(len(b))]])


class Network:
    """Two layers; ``score`` gives calibrated probabilities for pooled documents."""

    def __init__(self, base: float):
        self.base, self.layers, self.temperature = base, None, 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        mean, scale, w1, b1, w2, b2 = self.layers
        return np.tanh(np.clip((x - mean) / scale, -8, 8) @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on mini-batches in a fixed random order; every fifth document is kept for the temperature."""
    net = Network(float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5)
    if len(y) < 10 or y.min() == y.max():
        return net
    rng = np.random.Generator(np.random.PCG64(SEED))
    order = rng.permutation(len(y))
    held, used = order[::5], order[np.arange(len(y)) % 5 > 0]
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-3
    z = np.clip((x - mean) / scale, -8, 8)
    params = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
            w1, b1, w2, b2 = params
            hidden = np.tanh(z[part] @ w1 + b1)
            miss = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y[part]) / len(part)
            back = miss[:, None] * w2 * (1 - hidden ** 2)
            grads = [z[part].T @ back + DECAY * w1, back.sum(0), hidden.T @ miss + DECAY * w2, miss.sum()]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g ** 2
                params[k] = params[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net.layers = (mean, scale, *params)
    logits = net.logit(x[held])
    losses = {t: np.mean(np.logaddexp(0, logits / t) - y[held] * logits / t) for t in np.exp(np.linspace(-1.5, 2, 71)).tolist()}
    net.temperature = min(losses, key=losses.get)
    return net


def train(docs: DataFrame, labels: DataFrame, training: Column, mark: str = "quality", doc_id: str = "doc_id", text: str = "text",
          limit: int = SAMPLE) -> tuple[Vectors, Network]:
    """Vectors of the whole corpus and a network fitted on a sample of the labelled documents (``limit`` ids are broadcast)."""
    cells = context_cells(docs, text).toPandas()
    vectors = Vectors(cells["cell"].to_numpy(), cells["total"].to_numpy())
    sample = labelled_sample(labels, mark, training, limit, doc_id)
    picked = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([shared.value.pool(t).tobytes() for t in texts], type=pa.binary()),
                     pa.array([int(h[0] >> np.uint64(1)) if len(h := shingle_set(t)) else None for t in texts], type=pa.int64())],
                    ["_id", "_mark", "_pooled", "_copy"])

    rows = in_batches(picked).mapInArrow(pooled, "_id long, _mark int, _pooled binary, _copy long").toPandas().sort_values(["_id", "_pooled"])
    rows = rows[~rows.duplicated("_copy") | rows["_copy"].isna()]
    x = np.array([np.frombuffer(p) for p in rows["_pooled"]]).reshape(len(rows), 2 * WIDTH + 1)
    return vectors, fit(x, rows["_mark"].to_numpy(dtype=float))


def score(docs: DataFrame, model: tuple[Vectors, Network], text: str = "text", out: str = "score", keep_text: bool = True) -> DataFrame:
    """The documents with a column ``out``: the probability of good quality (an existing column of that name is replaced)."""
    kept = [f for f in docs.schema.fields if f.name.lower() != out.lower() and (keep_text or f.name != text)]
    at = docs.columns.index(text)
    picked = [docs.columns.index(f.name) for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        vectors, net = shared.value
        for batch in batches:
            for part in slices(batch):
                x = np.array([vectors.pool(t) for t in part.column(at).to_pylist()]).reshape(part.num_rows, 2 * WIDTH + 1)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in picked], pa.array(net.score(x), type=pa.float64())],
                                                 [f.name for f in schema.fields])

    return in_batches(docs).mapInArrow(run, schema)
