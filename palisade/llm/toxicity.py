"""Toxicity by subword-bag embeddings: character n-grams share vectors, their average goes through a linear softmax.

Every window of a text is the bag of its words' character n-grams, word ends included, hashed to rows of one embedding table.
Embeddings and softmax are trained jointly in numpy on a bounded sample of labelled documents; a misspelling that was never
seen still shares most of its n-grams. As the softmax is linear, scoring needs one number per n-gram row: a table of
2 ** BITS floats is all that goes to the executors. A document's score combines its worst and its mean window, so whole texts
of any length count.

The operating point is cross-fitted. The sample is cut into five parts in the order of a hash of the texts, so that copies lie
together: two tables are trained on two parts each, and the model is their mean. A logistic fit turns the odds of each half
under the other half's table into probabilities, with label shares restored. The fifth part, which no step has seen, then holds
the result: if more than ``CLEAN_LOSS`` of its clean documents reach the threshold, the intercept goes down until they don't.

Defined cases: null and empty texts have an empty bag and get the score of no evidence; labels that are null or repeat with
both values: null is ignored, any 1 wins; documents without labels are scored all the same; rows that repeat are each scored,
and of an id with several texts the greatest is learned from; without labelled rows of both kinds, empty tables included, every
score is the share of label 1 (0 if there is none); extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, DIM, SIZES = 17, 8, (3, 4, 5, 6)
WINDOW_CHARS = 128
THRESHOLD = 0.3
# The bound of the training sample: documents of either label, and windows of one document, evenly spaced over it.
SAMPLE_DOCS = 2000
SAMPLE_WINDOWS = 24
EPOCHS, BATCH, SEED = 10, 512, 7
# Step sizes: of the softmax, and of the strongest row of the table. Rows move in proportion to their gradients, so what
# only a few windows hold stays near its start; both fall linearly to zero.
RATE, TABLE_RATE = 0.02, 2.5
# Parts of the sample: two for either table, one for the check of the operating point.
PARTS = 5
# The share of the checking part's clean documents that may reach the threshold.
CLEAN_LOSS = 0.02

_MULTIPLY = np.uint32(0x9E3779B1)
_SPACE = np.uint32(0x20)


def normalized(text: str) -> np.ndarray:
    """Code points in lower case with every run of other than letters and digits as one space, at both ends too.

    Everything from U+3000 up counts as a letter.
    """
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype="<u4")
    kind = _kinds()
    other = ~np.where(codes < len(kind), kind[np.minimum(codes, len(kind) - 1)], True)
    keep = ~other
    keep[1:] |= other[1:] & ~other[:-1]
    keep[0] = True
    return np.where(other, _SPACE, codes)[keep].astype(np.uint32)


_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    if not _KINDS:
        _KINDS.append(np.array([chr(c).isalnum() for c in range(0x3000)]))
    return _KINDS[0]


def ngrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the table, first position) of all n-grams that have no space inside; a space at an end marks a word's end."""
    rows, places = [], []
    space = codes == _SPACE
    held = codes.astype(np.uint32)
    for n in range(2, max(SIZES) + 1):
        if len(codes) < n:
            break
        held = held[: len(codes) - n + 1] * _MULTIPLY + codes[n - 1 :]
        if n not in SIZES:
            continue
        inner = np.zeros(len(held), dtype=bool)
        for k in range(1, n - 1):
            inner |= space[k : k + len(held)]
        where = np.flatnonzero(~inner)
        x = held[where]
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        rows.append(((x ^ (x >> np.uint32(13))) >> np.uint32(32 - BITS)).astype(np.int32))
        places.append(where)
    if not rows:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(places)


@dataclass
class Model:
    """``table``: what each n-gram row adds to the log-odds of label 1; ``bias``; weights of worst window, mean window, 1."""

    table: np.ndarray
    bias: float
    combine: tuple[float, float, float]

    def window_odds(self, text: str) -> np.ndarray:
        codes = normalized(text)
        rows, places = ngrams(codes)
        if not len(rows):
            return np.array([self.bias])
        window = places // WINDOW_CHARS
        total = np.bincount(window, weights=self.table[rows])
        count = np.bincount(window)
        return (total / np.maximum(count, 1))[count > 0] + self.bias

    def odds(self, text: str | None) -> float:
        """Log-odds of label 1."""
        odds = self.window_odds(text or "")
        a, b, c = self.combine
        return float(a * odds.max() + b * odds.mean() + c)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.odds(text), -30, 30))))


def _windows(text: str, most: int) -> list[np.ndarray]:
    rows, places = ngrams(normalized(text))
    if not len(rows):
        return []
    window = places // WINDOW_CHARS
    n = int(window.max()) + 1
    chosen = range(n) if n <= most else {round(k * (n - 1) / (most - 1)) for k in range(most)}
    return [w for k in sorted(chosen) if len(w := rows[window == k])]


def _parts(texts: list[str | None], y: np.ndarray) -> np.ndarray:
    """The part of every document: within each label, equal stretches in the order of a hash of the text."""
    hashes = np.array([zlib.crc32(normalized(t or "").tobytes()) for t in texts], dtype=np.int64)
    part = np.zeros(len(y), dtype=np.int64)
    for value in (0, 1):
        own = np.flatnonzero(y == value)
        own = own[np.argsort(hashes[own], kind="stable")]
        part[own] = np.arange(len(own)) * PARTS // max(1, len(own))
    return part


def _table(bags: list[np.ndarray], target: np.ndarray, each: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """(table, bias) of one joint training over windows with labels ``target`` and weights ``each``."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    table = rng.normal(0, 0.01, (DIM, size)).astype(np.float32)
    soft = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    params = [table, soft, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step, peak = 0, 0.0
    steps = epochs * -(-len(bags) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            rows = np.concatenate([bags[k] for k in chosen])
            sizes = np.array([len(bags[k]) for k in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.stack([np.add.reduceat(table[d][rows], starts) for d in range(DIM)], axis=1) / sizes[:, None]
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), target[chosen]] -= 1
            g = (p * (each[chosen] / each[chosen].sum())[:, None]).astype(np.float32)
            back = (g @ soft.T) / sizes[:, None]
            spread = np.repeat(np.arange(len(chosen)), sizes)
            d_table = np.stack([np.bincount(rows, weights=back[spread, d], minlength=size) for d in range(DIM)]).astype(np.float32)
            left = 1 - step / steps
            for param, grad, (m, v) in zip(params, [d_table, mean.T.astype(np.float32) @ g, g.sum(axis=0)], moments, strict=True):
                m += 0.1 * (grad - m)
                if param is table:
                    peak = max(peak * 0.99, float(np.abs(m).max()))
                    param -= TABLE_RATE * left / (peak + 1e-12) * m
                else:
                    v += 0.01 * (grad * grad - v)
                    param -= RATE * left * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.99 ** (step + 1))) + 1e-8)
            step += 1
    way = soft[:, 1] - soft[:, 0]
    return (way @ table).astype(np.float32), float(bias[1] - bias[0])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression, the last column an intercept without ridge: Newton steps, halved until the loss falls."""
    ridges = np.full(x.shape[1], ridge * weight.sum())
    ridges[-1] = 0.0

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridges @ (beta * beta))

    beta = np.zeros(x.shape[1])
    now = loss(beta)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (q - y)) + ridges * beta
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + np.diag(ridges + 1e-9 * weight.sum())
        way = np.linalg.solve(hessian, slope)
        length = 1.0
        while length > 1e-6 and not loss(beta - length * way) <= now - 1e-4 * length * float(slope @ way):
            length /= 2
        if length <= 1e-6:
            break
        beta = beta - length * way
        before, now = now, loss(beta)
        if before - now < 1e-10 * abs(before):
            break
    return beta


def _combined(odds: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weights of worst window, mean window and 1. More evidence never lowers a score: a negative weight leaves the fit."""
    x = np.array([[o.max(), o.mean(), 1.0] for o in odds])
    used = [0, 1, 2]
    while True:
        beta = np.zeros(3)
        beta[used] = logistic(x[:, used], y, weight)
        negative = [k for k in used[:-1] if beta[k] < 0]
        if not negative:
            return tuple(float(v) for v in beta)
        used.remove(min(negative, key=lambda k: beta[k]))


def fit(texts: list[str | None], labels: list[int], share: float, epochs: int = EPOCHS, seed: int = SEED,
        threshold: float = THRESHOLD) -> Model:
    """Train on documents; ``share`` is the share of label 1 among all labelled documents, which the weights restore."""
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(1 << BITS, dtype=np.float32), float(odds), (1.0, 0.0, 0.0))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    part = _parts(texts, y)
    if min((y == 0).sum(), (y == 1).sum()) < PARTS:
        part[:] = 0  # too few for parts: one table, fitted and tuned on all
    bags, owner = [], []
    for k, text in enumerate(texts):
        for bag in _windows(text or "", SAMPLE_WINDOWS) if part[k] < PARTS - 1 else ():
            bags.append(bag)
            owner.append(k)
    owner_ = np.asarray(owner, dtype=np.int64)
    each = weight[owner_] / np.bincount(owner_, minlength=len(y))[owner_]
    half = part // 2  # 0 and 1 are the halves, 2 the checking part
    halves = []
    for side in range(1 if not half.any() else 2):
        own = np.flatnonzero(half[owner_] == side)
        if not len(own):
            return Model(np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share))), (1.0, 0.0, 0.0))
        table, bias = _table([bags[k] for k in own], y[owner_[own]].astype(int), each[own], epochs, seed + side)
        halves.append(Model(table, bias, (1.0, 0.0, 0.0)))
    seen = np.flatnonzero(half < 2)
    odds = [halves[(1 - half[k]) % len(halves)].window_odds(texts[k] or "") for k in seen]
    model = Model(np.mean([h.table for h in halves], axis=0, dtype=np.float32), float(np.mean([h.bias for h in halves])),
                  _combined(odds, y[seen], weight[seen]))
    clean = [k for k in np.flatnonzero(half == 2) if y[k] == 0]
    if clean:
        reached = np.quantile([model.odds(texts[k]) for k in clean], 1 - CLEAN_LOSS)
        a, b, c = model.combine
        model.combine = (a, b, c - max(0.0, float(reached - np.log(threshold / (1 - threshold))) + 1e-6))
    return model


def held_out() -> Column:
    """Rows whose crc32 of the id as text leaves 2 modulo 4 are kept out of training."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on at most ``sample_docs`` documents of either label, the first by a hash of the id. Held-out rows never take part."""
    marks = labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {int(r["toxic"]): r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for value in counts:
        part = marks.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return fit([], [], 0.0)
    # At most 2 * sample_docs ids: a proven size.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    sample = rows.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")).toPandas().sort_values("doc_id")
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit(sample["text"].tolist(), sample["toxic"].astype(int).tolist(), share)


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    schema = docs.select("*", F.lit(0.0).alias(column)).schema
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            found = [fitted.score(t) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    found = scored(docs.select("doc_id", "text"), model)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
