"""Language of a text by a byte convolutional network.

Byte embeddings, filters of several widths, max pooling over a window and a softmax, trained in numpy on a bounded sample of
labelled documents of every language. Texts are read as UTF-8 bytes in windows of fixed length, the last one moved back to end
with the text, so that every byte of a text is seen once or twice. A document's answer is the mean of its windows' answers.

For scoring, embeddings and filters are folded into tables by byte and by byte pair: a filter of width four is two look-ups.

Defined cases: null texts and texts without letters are ``und`` with score 0; so is everything if no labelled row can be
learned from; shorter texts are padded with a byte that adds nothing; of languages with equal odds the first by name is taken;
rows that repeat are each answered, and of an id with several texts the greatest is learned from; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.toxicity import held_out

WIDTHS, FILTERS, DIM, WINDOW = (2, 3, 4), 12, 8, 256
# The bound of the training sample: documents of each language, evenly spaced windows of each document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 500, 6
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 11
UNKNOWN = "und"

# Unicode's letters; digits in circles, fractions and Roman numeral signs are none.
_LETTER = regex.compile(r"\p{L}")
_SPACES = re.compile(r"\s+")


def text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(_SPACES.sub(" ", text.lower()).encode(), dtype=np.uint8)


def windows(data: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Rows of ``size`` bytes that cover ``data``; a shorter text is padded with zeros."""
    n = len(data)
    if n <= size:
        return np.pad(data, (0, size - n))[None, :]
    starts = np.append(np.arange(0, n - size, size), n - size)
    return np.lib.stride_tricks.sliding_window_view(data, size)[starts]


@dataclass
class Network:
    names: list[str]
    embed: np.ndarray  # 256 x DIM, row 0 is zero
    filters: list[np.ndarray]  # width x DIM x FILTERS each
    bias: np.ndarray  # all filters
    out: np.ndarray  # filters x names
    out_bias: np.ndarray

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """For each width the look-ups (offset, bytes read, table) whose sum is the filter's response."""
        found = []
        for weight in self.filters:
            by_byte = [(self.embed @ weight[j]).astype(np.float32) for j in range(len(weight))]
            steps = []
            for j in range(0, len(weight) - 1, 2):
                steps.append((j, 2, (by_byte[j][:, None, :] + by_byte[j + 1][None, :, :]).reshape(-1, FILTERS)))
            if len(weight) % 2:
                steps.append((len(weight) - 1, 1, by_byte[-1]))
            found.append(steps)
        return found

    def log_odds(self, rows: np.ndarray, tables: list) -> np.ndarray:
        """Softmax log-probabilities of windows."""
        pairs = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        pooled = []
        for steps, weight in zip(tables, self.filters, strict=True):
            length = rows.shape[1] - len(weight) + 1
            total = None
            for at, n, table in steps:
                part = np.take(table, (pairs if n == 2 else rows)[:, at : at + length], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        tables = self.tables() if self.names else []
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.names:
            return names, scores
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        total = np.zeros((len(texts), len(self.names)))
        count = np.zeros(len(texts))

        def run() -> None:
            rows, owner = np.concatenate(held), np.concatenate(owners)
            for at in range(0, len(rows), BATCH):
                found = np.exp(self.log_odds(rows[at : at + BATCH], tables))
                np.add.at(total, owner[at : at + BATCH], found)
            np.add.at(count, owner, 1)
            held.clear()
            owners.clear()

        size = 0
        for k, text in enumerate(texts):
            if text is None or not _LETTER.search(text):
                continue
            rows = windows(text_bytes(text))
            held.append(rows)
            owners.append(np.full(len(rows), k))
            size += len(rows)
            if size >= 64 * BATCH:
                run()
                size = 0
        if held:
            run()
        for k in np.flatnonzero(count):
            mean = total[k] / count[k]
            best = int(mean.argmax())
            names[k], scores[k] = self.names[best], float(min(1.0, mean[best]))
        return names, scores


def fit(texts: list[str], langs: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
    filters = [rng.normal(0, 1 / np.sqrt(w * DIM), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    width = FILTERS * len(WIDTHS)
    net = Network(names, embed, filters, np.zeros(width, np.float32),
                  rng.normal(0, 1 / np.sqrt(width), (width, len(names))).astype(np.float32), np.zeros(len(names), np.float32))
    rows, target = [], []
    for text, lang in zip(texts, langs, strict=True):
        if not _LETTER.search(text):
            continue
        own = windows(text_bytes(text))
        if len(own) > SAMPLE_WINDOWS:
            own = own[np.unique(np.linspace(0, len(own) - 1, SAMPLE_WINDOWS).round().astype(int))]
        rows.append(own)
        target.append(np.full(len(own), names.index(lang)))
    if not rows:
        return Network([], embed, filters, net.bias, net.out, net.out_bias)
    x, y = np.concatenate(rows), np.concatenate(target)
    weight = 1 / np.bincount(y, minlength=len(names))[y].astype(np.float32)
    params = [embed, *filters, net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    steps, step = epochs * -(-len(x) // BATCH), 0
    embed[0] = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            data, n = x[chosen], len(chosen)
            inside = embed[data]
            pooled, where = [], []
            for f in filters:
                length = WINDOW - len(f) + 1
                response = sum(inside[:, j : j + length] @ f[j] for j in range(len(f)))
                best = response.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(response, best[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(pooled, axis=1) + net.bias
            hidden = np.maximum(raw, 0)
            logits = hidden @ net.out + net.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y[chosen]] -= 1
            g = p * (weight[chosen] / weight[chosen].sum())[:, None]
            back = (g @ net.out.T) * (raw > 0)
            d_embed = np.zeros_like(embed)
            d_filters = []
            for k, (f, best) in enumerate(zip(filters, where, strict=True)):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                d = np.zeros_like(f)
                for j in range(len(f)):
                    bytes_ = np.take_along_axis(data, best + j, axis=1)
                    d[j] = np.einsum("nfd,nf->df", embed[bytes_], own)
                    np.add.at(d_embed, bytes_, own[:, :, None] * f[j].T[None])
                d_filters.append(d)
            d_embed[0] = 0
            left = 1 - step / steps
            step += 1
            for param, grad, (m, v) in zip(params, [d_embed, *d_filters, back.sum(axis=0), hidden.T @ g, g.sum(axis=0)], moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= RATE * left * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network:
    """Fit on at most ``sample_docs`` documents of each language, the first by a hash of the id; held-out rows take no part."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # sample_docs ids for each language: a proven size.
    chosen = known.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample_docs).select("doc_id", "lang")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = rows.where(F.col("text").isNotNull()).groupBy("doc_id").agg(F.max(F.struct("text", "lang")).alias("row"))
    sample = one.select("doc_id", "row.text", "row.lang").toPandas().sort_values("doc_id")
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def languages(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    net = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            names, scores = fitted.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
