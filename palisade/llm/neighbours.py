"""Approximate nearest neighbours (largest inner product) by learned partitions.

On a bounded sample a neighbour graph is cut into parts of equal size, so that as few neighbours as possible are separated; a small
network learns each vector's part, and the parts of its neighbours, from the vector alone. Every row of the table is indexed
under its most probable part. A query goes to its PROBES most probable parts and is compared there with all vectors, in blocks
of bounded size, in double precision.

Equal vectors are indexed once with their smallest ids (no more than a result can hold), so a vector that fills a third of the
table is one vector; its queries get their lists by a join that splits hot keys.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or have not the usual length (the most
frequent one) take no part; so do rows without an id; rows that repeat an id with one vector count once; fewer candidates than
asked for give shorter lists; ties go to the smaller id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.operators.skew import hot_safe_join, top_per_key
from palisade.session import written

TOP = 20
QUERY_EVERY = 20
PARTS, PROBES = 16, 13
# The bound of the sample that the graph and the network are fitted on, and the graph's neighbours.
SAMPLE_ROWS, GRAPH_NEIGHBOURS = 8000, 10
HIDDEN, EPOCHS, BATCH, RATE, SEED = 128, 20, 128, 0.003, 5
BLOCK_ROWS = 4096


def neighbour_graph(x: np.ndarray, k: int = GRAPH_NEIGHBOURS) -> np.ndarray:
    """For each row the ``k`` rows of largest inner product, itself left out."""
    k = min(k, len(x) - 1)
    found = np.zeros((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        found[at : at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else found[at : at + 1024]
    return found


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 6, seed: int = SEED) -> np.ndarray:
    """Parts of at most five per cent above equal size: seeded by spread-out centers, then moved to where the neighbours are."""
    rng = np.random.default_rng(seed)
    n = len(x)
    most = int(np.ceil(1.05 * n / parts))
    centers = x[rng.choice(n, parts, replace=False)]
    label = np.zeros(n, dtype=np.int64)
    for _ in range(rounds):
        affinity = x @ centers.T
        label = _placed(affinity, most)
        centers = np.stack([x[label == p].mean(axis=0) for p in range(parts)])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    # Edges count in both directions.
    source = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    target = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (source, label[target]), 1)
        votes[np.arange(n), label] += 0.5
        label = _placed(votes + 1e-3 * (x @ centers.T), most)
    return label


def _placed(wish: np.ndarray, most: int) -> np.ndarray:
    """Every row to its best part that has room; the rows with most to lose choose first."""
    order = np.argsort(-wish, axis=1)
    best = np.take_along_axis(wish, order[:, :2], axis=1)
    room = np.full(wish.shape[1], most)
    label = np.zeros(len(wish), dtype=np.int64)
    for i in np.argsort(-(best[:, 0] - best[:, -1]), kind="stable"):
        for p in order[i]:
            if room[p]:
                room[p] -= 1
                label[i] = p
                break
    return label


@dataclass
class Router:
    """Two dense layers from a vector to the probabilities of its parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.odds(x), axis=1, kind="stable")[:, :n]


def fit(x: np.ndarray, parts: int = PARTS, epochs: int = EPOCHS, seed: int = SEED) -> Router:
    """Graph, balanced parts, and the network that predicts the parts of a vector and of its neighbours."""
    rng = np.random.default_rng(seed)
    parts = max(1, min(parts, len(x) // 8))
    dim = x.shape[1]
    net = Router(rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, (HIDDEN, parts)), np.zeros(parts))
    if parts == 1:
        return net
    scale = np.sqrt(dim) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True).mean(), 1e-12)
    graph = neighbour_graph(x)
    label = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 0.5 / graph.shape[1])
    target[np.arange(len(x)), label] += 0.5
    params = [net.w1, net.b1, net.w2, net.b2]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    steps, step = epochs * -(-len(x) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            own = x[order[at : at + BATCH]] * scale
            raw = own @ net.w1 + net.b1
            hidden = np.maximum(raw, 0)
            logits = hidden @ net.w2 + net.b2
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - target[order[at : at + BATCH]]) / len(own)
            back = (g @ net.w2.T) * (raw > 0)
            left = 1 - step / steps
            step += 1
            for param, grad, (m, v) in zip(params, [own.T @ back, back.sum(axis=0), hidden.T @ g, g.sum(axis=0)], moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= RATE * left * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + 1e-3 * param)
    net.w1 *= scale
    return net


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part; -0.0 becomes 0.0 so that equal vectors are equal values."""
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    big = F.lit(float(np.finfo(np.float32).max))
    finite = F.forall("embedding", lambda v: F.coalesce((v >= -big) & (v <= big), F.lit(False)))
    vectors = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0))
    vectors = vectors.select("vec_id", F.transform("embedding", lambda v: v + F.lit(0.0).cast("float")).alias("embedding"))
    sizes = vectors.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), "size").limit(1).select("size")
    return vectors.where(F.size("embedding") == usual.scalar())


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()).astype(np.float64)


def index(distinct: DataFrame, sample_rows: int = SAMPLE_ROWS, parts: int = PARTS) -> tuple[DataFrame, Router | None]:
    """(rep, embedding, part) of all distinct vectors, and the router fitted on the first ``sample_rows`` by a hash."""
    sample = distinct.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("embedding").toPandas()
    if not len(sample):
        return distinct.select("rep", "embedding", F.lit(0).alias("part")), None
    router = fit(_matrix(sample["embedding"]), parts)
    return distinct.mapInArrow(_routed(distinct, router, 1), "rep long, embedding array<float>, part int"), router


def _routed(rows: DataFrame, router: Router, n: int):
    """The function that gives every row its ``n`` most probable parts, as rows."""
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found = net.parts(_matrix(batch.column("embedding")), n)
            again = pa.array(np.repeat(np.arange(batch.num_rows), found.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(again), batch.column("embedding").take(again), pa.array(found.ravel().astype(np.int32))],
                ["rep", "embedding", "part"])

    return run


def nearest(rows: DataFrame, is_query, top: int = TOP, parts: int = PARTS, probes: int = PROBES) -> DataFrame:
    """For the rows of which ``is_query`` holds: query_id, rank, vec_id, score of the ``top`` nearest found other rows."""
    vectors = written(usable(rows).distinct(), "vectors")
    # No result can hold more than top + 1 rows of one vector, itself included.
    members = written(top_per_key(vectors, ["embedding"], [F.col("vec_id")], top + 1, "nth"), "members")
    reps = members.where("nth = 1").select(F.col("vec_id").alias("rep"), "embedding")
    placed, router = index(reps, parts=parts)
    placed = written(placed, "parts")
    asked = vectors.where(is_query(F.col("vec_id")))
    if router is None:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    asking = asked.select("embedding").distinct().join(reps, "embedding").select("rep", "embedding")
    sent = written(asking.mapInArrow(_routed(reps, router, probes), "rep long, embedding array<float>, part int"), "sent")

    # Blocks of bounded size on both sides of a part; both counts have one row per part, a proven size.
    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias(name))

    counts = F.broadcast(blocks(placed, "vblocks").join(blocks(sent, "qblocks"), "part"))
    deal = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    theirs = placed.join(counts, "part").withColumn("vb", deal("vblocks")).select("part", "vb", every("qblocks").alias("qb"), "rep", "embedding")
    ours = sent.join(counts, "part").withColumn("qb", deal("qblocks")).select("part", "qb", every("vblocks").alias("vb"), "rep", "embedding")

    def block(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"rep": [], "cand": [], "score": []}).astype({"rep": "int64", "cand": "int64"})
        found = found.sort_values("rep", ignore_index=True)
        x, ids, qs = _matrix(found["embedding"]), found["rep"].to_numpy(), _matrix(queries["embedding"])
        out = []
        for at in range(0, len(qs), 512):
            s = qs[at : at + 512] @ x.T
            keep = min(top + 1, s.shape[1])
            # A margin over rounding, then exact scores in a fixed order of summation.
            least = -np.partition(-s, keep - 1, axis=1)[:, keep - 1] - 1e-9
            q, v = np.nonzero(s >= least[:, None])
            exact = (qs[at + q] * x[v]).sum(axis=1)
            order = np.lexsort((ids[v], -exact, q))
            q, v, exact = q[order], v[order], exact[order]
            nth = np.arange(len(q)) - np.searchsorted(q, q)
            chosen = nth < keep
            out.append(pd.DataFrame({"rep": queries["rep"].to_numpy()[at + q[chosen]], "cand": ids[v[chosen]], "score": exact[chosen]}))
        return pd.concat(out, ignore_index=True)

    met = ours.groupBy("part", "vb", "qb").cogroup(theirs.groupBy("part", "vb", "qb")).applyInPandas(block, "rep long, cand long, score double")
    order = [F.desc("score"), F.col("cand")]
    best = written(top_per_key(met, ["rep"], order, top + 1, "nth").select("rep", "cand", "score"), "best")

    # From distinct vectors to rows: a list per query vector, joined to its query rows.
    ids = members.join(members.where("nth = 1").select("embedding", F.col("vec_id").alias("cand")), "embedding").select("cand", "vec_id")
    spread = top_per_key(best.join(ids, "cand"), ["rep"], [F.desc("score"), F.col("vec_id")], top + 1, "nth")
    lists = spread.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("list"))
    of_rep = hot_safe_join(asked, reps, ["embedding"]).select(F.col("vec_id").alias("query_id"), "rep")
    own = hot_safe_join(of_rep, lists, ["rep"])
    others = F.slice(F.filter("list", lambda c: c["vec_id"] != F.col("query_id")), 1, top)
    return own.select("query_id", F.posexplode(others).alias("pos", "c")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))
