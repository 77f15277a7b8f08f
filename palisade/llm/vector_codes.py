"""Vector code compression: integer product codes whose every distance is exact.

A component x becomes the integer floor(256 x), a vector is cut into 16 equal parts, and each part position has a codebook of at
most 64 entries, refined by rounds of exact k-means. Distances come from matrix products in float64 BLAS: integers are broken
into limbs of so few bits that no dot product of two limb vectors reaches 2 ** 53, the products of limb pairs are exact, and
int64 puts them together with shifts. The nearest entry is the first least one. Only where a squared distance could pass 2 ** 62
do Python's integers take over from int64, for the same products.

Vectors never move. A round is one pass over the table in which every task adds up its parts by codebook entry, limb by limb in
int64, and Spark adds up the tasks' cells; the codebooks, bounded by their own size, go back to the tasks with the next round.

Defined cases: rows whose vector is null or holds null, NaN or infinite components are left out; vectors shorter than the
longest, and a length that 16 doesn't divide, are filled up with zeros at the end; rows that repeat an id are each coded, and
for the codebooks the first of an id's vectors stands, in the order of their integers' text; rows without an id are coded but no
start of a codebook; with fewer than 64 ids the codebooks are smaller; labels that are null count as one label; an error, or a
sum of errors, beyond 64 bits is null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.session import written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
INT_MAX = 2**63 - 1


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite float64 values: int64, or Python integers where these are too small."""
    if not values.size or np.abs(values).max() < 2.0**53:
        return np.floor(values * SCALE).astype(np.int64)
    flat = [int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in values.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(values.shape)


def usable(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows, vectors as float64) of a list column: those without nulls and non-finite components."""
    rows, vectors = [], []
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    good = np.isfinite(values)
    if flat.null_count:
        good &= ~np.asarray(flat.is_null())
    ends = np.cumsum(np.where(np.asarray(column.is_null()), 0, np.nan_to_num(np.asarray(
        pa.compute.list_value_length(column).fill_null(0)).astype(np.float64))).astype(np.int64))
    bad = np.concatenate([[0], np.cumsum(~good)])
    begin = 0
    nulls = np.asarray(column.is_null())
    for k, end in enumerate(ends.tolist()):
        if not nulls[k] and bad[end] == bad[begin]:
            rows.append(k)
            vectors.append(values[begin:end])
        begin = end
    return np.array(rows, dtype=np.int64), vectors


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Integer vectors as one array (position, vector, component of the part)."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return scaled(out).reshape(len(vectors), PARTS, width // PARTS).transpose(1, 0, 2)


def limb_bits(length: int) -> int:
    """Bits of a limb: ``length`` products of two limbs stay below 2 ** 53 (and a limb itself below 2 ** 26)."""
    return (53 - max(1, int(length)).bit_length()) // 2


def limbs(x: np.ndarray, bits: int, n: int) -> list[np.ndarray]:
    """x as sum of limb k times 2 ** (bits k), as float64; the lower limbs are not negative, the last one has the sign."""
    out = []
    for _ in range(n - 1):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    out.append(x.astype(np.float64))
    return out


def limb_count(largest: int, bits: int) -> int:
    """How many limbs hold every integer of magnitude up to ``largest``, the last one below 2 ** bits in magnitude."""
    n = 1
    while largest >= 1 << (bits * n):
        n += 1
    return n


def dots(x: np.ndarray, c: np.ndarray, largest: int) -> np.ndarray:
    """Exact dot products (position, vector, entry) of integer arrays whose components have a magnitude up to ``largest``."""
    length = x.shape[-1]
    bits = limb_bits(length)
    n = limb_count(largest, bits)
    fits = 4 * length * max(largest, 1) ** 2 < 1 << 62
    total = None
    left, right = limbs(x, bits, n), limbs(c, bits, n)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            product = np.matmul(a, b.transpose(0, 2, 1)).astype(np.int64)
            product = product if fits else product.astype(object)
            total = product * (1 << bits * (i + j)) if total is None else total + product * (1 << bits * (i + j))
    return total


@dataclass
class Codebooks:
    """``entries``: (position, entry, component); ``width``: the padded length of a vector; ``largest``: of any magnitude."""

    entries: np.ndarray
    width: int
    largest: int

    def assigned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for every (position, vector)."""
        products = dots(x, self.entries, self.largest)
        wide = products.dtype
        own = (self.entries.astype(wide) ** 2).sum(axis=2)
        score = own[:, None, :] - 2 * products
        chosen = score.argmin(axis=2)
        least = np.take_along_axis(score, chosen[:, :, None], axis=2)[:, :, 0]
        return chosen, least + (x.astype(wide) ** 2).sum(axis=2)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _vectors(df: DataFrame) -> DataFrame:
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label"))


def _first_books(rows: DataFrame, entries: int) -> Codebooks | None:
    """The start: the vectors of the smallest ids. Every task gives its own ``entries`` smallest and its bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, largest, best = -1, 0, {}
        for batch in batches:
            places, vectors = usable(batch.column(1))
            ids = batch.column(0).take(pa.array(places)).to_pylist()
            for vec_id, v in zip(ids, vectors, strict=True):
                length = max(length, len(v))
                bound = max(best) if len(best) >= entries else None
                if vec_id is None or bound is not None and vec_id > bound:
                    continue
                text = ",".join(map(str, scaled(v).tolist()))
                best[vec_id] = min(best.get(vec_id, text), text)
                if len(best) > entries:
                    del best[max(best)]
            if vectors:
                ends = [v for v in vectors if len(v)]
                top = max((float(np.abs(v).max()) for v in ends), default=0.0)
                largest = max(largest, int(np.abs(scaled(np.array([top, -top]))).max()))
        if length >= 0:
            chosen = sorted(best.items())
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array([None, *[k for k, _ in chosen]], pa.int64()), "ints": pa.array([str(largest), *[t for _, t in chosen]]),
                "length": pa.array([length, *[None] * len(chosen)], pa.int64())})

    found = written(rows.select("vec_id", "embedding").mapInArrow(run, "vec_id long, ints string, length long"), "code-start")
    bounds = found.where(F.col("length").isNotNull())
    # Magnitudes as text, longest first, as they may pass 64 bits.
    top = bounds.agg(F.max("length").alias("length"), F.max(F.struct(F.length("ints"), "ints")).alias("largest")).first()
    if top["length"] is None:
        return None
    width = -(-max(top["length"], 1) // PARTS) * PARTS
    starts = found.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("ints").alias("ints")).orderBy("vec_id").limit(entries)
    chosen = [[int(v) for v in r["ints"].split(",") if v] for r in starts.collect()]  # at most ``entries`` rows
    largest = int(top["largest"]["ints"])
    wide = np.int64 if largest <= INT_MAX >> 1 else object
    books = np.array([v + [0] * (width - len(v)) for v in chosen], dtype=wide).reshape(len(chosen), PARTS, width // PARTS)
    return Codebooks(np.ascontiguousarray(books.transpose(1, 0, 2)), width, largest)


def _refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every used entry to the floor of its parts' mean."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(books)
    positions, entries, length = books.entries.shape
    bits = limb_bits(length)
    n = limb_count(books.largest, bits)
    cells = positions * entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Codebooks = shared.value
        count = np.zeros(cells, dtype=np.int64)
        sums = np.zeros((n, length, cells), dtype=np.int64)
        for batch in batches:
            _, vectors = usable(batch.column(0))
            if not vectors:
                continue
            x = matrix(vectors, own.width)
            chosen, _ = own.assigned(x)
            cell = (chosen + np.arange(positions)[:, None] * entries).ravel()
            count += np.bincount(cell, minlength=cells)
            for k, limb in enumerate(limbs(x, bits, n)):
                for d in range(length):
                    # A batch's sums of limbs below 2 ** 26 are exact in float64.
                    sums[k, d] += np.bincount(cell, weights=limb[:, :, d].ravel(), minlength=cells).astype(np.int64)
        total = np.concatenate([count, sums.ravel()])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "total"])

    added = rows.select("embedding").mapInArrow(run, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.zeros(cells * (1 + n * length), dtype=np.int64)
    for r in added.collect():  # one row a cell of the codebooks
        total[r["cell"]] = r["total"]
    count = total[:cells].reshape(positions, entries)
    sums = total[cells:].reshape(n, length, positions, entries).astype(object)
    new = books.entries.astype(object).copy()
    for p, e in zip(*np.nonzero(count), strict=True):
        for d in range(length):
            new[p, e, d] = sum(int(sums[k, d, p, e]) << bits * k for k in range(n)) // int(count[p, e])
    return Codebooks(new.astype(books.entries.dtype), books.width, books.largest)


def codebooks(df: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """The final codebooks of a table of vec_id and embedding; None if no vector is usable."""
    rows = _vectors(df)
    books = _first_books(rows, entries)
    for _ in range(rounds if books is not None and books.entries.shape[1] else 0):
        books = _refined(rows, books)
    return books


def coded(df: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of every usable vector: two hex digits a part, and the squared distances added up."""
    rows = _vectors(df)
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Codebooks = shared.value
        for batch in batches:
            places, vectors = usable(batch.column(1))
            if not len(places):
                continue
            chosen, distance = own.assigned(matrix(vectors, own.width))
            errors = distance.astype(object).sum(axis=0) if distance.dtype == object else distance.sum(axis=0)
            taken = batch.take(pa.array(places))
            yield pa.RecordBatch.from_arrays([
                taken.column(0), taken.column(2),
                pa.array([row.tobytes().hex() for row in np.ascontiguousarray(chosen.T.astype(np.uint8))]),
                pa.array([int(e) if e <= INT_MAX else None for e in errors.tolist()], pa.int64())],
                ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, schema)


def compressed(df: DataFrame) -> DataFrame:
    """Per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    books = codebooks(df)
    if books is None or not books.entries.shape[1]:
        nothing = _vectors(df).where(F.lit(False))
        return nothing.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")],
                              F.lit("").alias("codebooks_sha256"))
    found = written(coded(df, books), "codes")
    # Null labels are one group and join as such. One row a label; adaptive execution splits a hot one or broadcasts them all.
    by_label = found.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("label_error"))
    other = by_label.withColumnRenamed("label", "label_")
    return found.join(other, F.col("label").eqNullSafe(F.col("label_"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _oracle() -> str:
    """The same by plain joins: one CTE for every assignment and every codebook."""
    def assigned(k: int) -> str:
        return f"""a{k} AS (
  SELECT row, part, entry, v, dist FROM (
    SELECT p.row, p.part, b.entry, p.v, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist,
      row_number() OVER (PARTITION BY p.row, p.part ORDER BY
        list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.entry) AS rn
    FROM p JOIN b{k} b ON p.part = b.part) WHERE rn = 1)"""

    def refined(k: int) -> str:
        return f"""m{k} AS (
  SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY d) AS v FROM (
    SELECT part, entry, d, sum(v[d]) AS total, count(*) AS n FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM p) + 1)) AS d)
    GROUP BY part, entry, d) GROUP BY part, entry),
b{k + 1} AS (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m USING (part, entry))"""

    rounds = ",\n".join(f"{assigned(k)},\n{refined(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT row, vec_id, part, ints[part * (len(ints) // {PARTS}) + 1 : (part + 1) * (len(ints) // {PARTS})] AS v
  FROM kept, (SELECT unnest(range({PARTS})) AS part)),
b0 AS (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, v FROM p WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})),
{rounds},
{assigned(ROUNDS)},
e AS (SELECT row, string_agg(lower(printf('%02x', CAST(entry AS INT))), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY row)
SELECT k.vec_id, e.code, e.error, CAST(sum(e.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM e JOIN kept k USING (row)
"""


ORACLE_SQL = _oracle()
