"""Line deduplication by sorted hashes: one copy of a frequent line stays, in the largest document that holds it.

Every line long enough becomes a row of its key's 128-bit hash, its document and its place. The rows are dealt to tasks by ranges
of (hash, document from the largest down) and sorted so inside a task. A task streams its rows once and keeps a few numbers: the
first document of a hash keeps its lines, and lines of the others go as soon as a third document comes. A hash that a third of
all rows share is cut over many tasks like any other: only the first and the last hash of a task can go on in another one, so
for these the task leaves a summary (documents, largest document) and the lines that it can't decide. The summaries, at most
two a task, are added up and decide the open lines where they lie.

The result is no text but a keep bitmap per document, packed and compressed; a document without one keeps every line.

Defined cases: null and empty texts are one empty line; a key is in one document however often the document repeats it; rows that
repeat an id are one document, and each row has the bitmap of its own text; rows without an id are together one document below
all others; ties can't arise, as places of one document go together; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.common import lower_ascii
from palisade.session import written

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
NO_ID = -(2**63)
DROPPED, OPEN, SUMMARY = 0, 1, 2

_STREAMED = pa.schema([
    ("kind", pa.int8()), ("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("place", pa.int32()),
    ("n_lines", pa.int32()), ("docs", pa.int64()),
])
_STREAMED_SQL = "kind byte, h1 long, h2 long, id long, row long, place int, n_lines int, docs long"


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _row_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(_text()).alias("row")]


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, id, row, place, n_lines): one row per line whose key has at least ``min_chars`` code points."""
    lines = docs.select(*_row_key(), F.split(_text(), "\n").alias("lines"))
    placed = lines.select("id", "row", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("place", "line"))
    key = lower_ascii(F.btrim("line", F.lit(BLANKS)))
    keyed = placed.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= min_chars)
    return keyed.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "id", "row", "place", "n_lines")


def stream(min_docs: int):
    """The pass over one task's sorted rows, for mapInArrow; two documents' lines of one hash are held at most."""

    def rows(kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        n = len(columns[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, dtype=np.int8)), *[pa.array(c) for c in columns], pa.nulls(n, pa.int64())], schema=_STREAMED)

    def summary(key: tuple[int, int], docs: int, largest: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"kind": SUMMARY, "h1": key[0], "h2": key[1], "id": largest, "docs": docs}], schema=_STREAMED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, largest, last, first_key = None, 0, 0, 0, True
        held: list[list[np.ndarray]] = []  # lines of documents 2 to min_docs - 1 of the present hash
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            h1, h2, ids = columns[:3]
            new_key = np.ones(len(ids), dtype=bool)
            new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            goes_on = key == (int(h1[0]), int(h2[0]))
            new_doc = new_key.copy()
            new_doc[1:] |= ids[1:] != ids[:-1]
            if goes_on:
                new_doc[0] = int(ids[0]) != last
            starts = np.flatnonzero(new_key)
            group = np.cumsum(new_key) - 1
            seen = np.cumsum(new_doc)
            ordinal = seen - (seen[starts] - new_doc[starts])[group]  # which document of its hash, from 1
            if goes_on:
                ordinal[group == 0] += docs
            total = ordinal[np.append(starts[1:], len(ids)) - 1]
            opened = np.zeros(len(ids), dtype=bool)
            if key is None or (goes_on and first_key):
                # The task's first hash may have begun in another task: all its lines wait.
                opened = group == 0
                if opened.any():
                    yield rows(OPEN, [c[opened] for c in columns])
            if not goes_on and key is not None:
                if first_key:
                    yield summary(key, docs, largest)
                held = []
            if goes_on and not first_key and held and total[0] >= min_docs:
                yield from (rows(DROPPED, c) for c in held)
                held = []
            gone = (ordinal >= 2) & (total >= min_docs)[group] & ~opened
            if gone.any():
                yield rows(DROPPED, [c[gone] for c in columns])
            # The present hash is the last of the batch.
            if len(starts) > 1 or not goes_on:
                if len(starts) > 1 and goes_on and first_key:
                    yield summary(key, int(total[0]), largest)
                elif len(starts) > 1 and key is None:
                    yield summary((int(h1[0]), int(h2[0])), int(total[0]), int(ids[0]))
                first_key = key is None and len(starts) == 1
                key, largest, held = (int(h1[-1]), int(h2[-1])), int(ids[starts[-1]]), []
            docs, last = int(total[-1]), int(ids[-1])
            if docs < min_docs and not first_key:
                waits = (group == len(starts) - 1) & (ordinal >= 2)
                if waits.any():
                    held.append([c[waits] for c in columns])
        if key is not None:
            yield summary(key, docs, largest)
            yield from (rows(OPEN, c) for c in held)

    return run


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, row, place, n_lines) of the lines that go, from the rows of :func:`line_rows`."""
    ranged = lines.repartitionByRange("h1", "h2", F.col("id").desc()).sortWithinPartitions("h1", "h2", F.col("id").desc())
    streamed = written(ranged.mapInArrow(stream(min_docs), _STREAMED_SQL), "lines")
    # At most two summaries a task.
    keys = streamed.where(F.col("kind") == SUMMARY).groupBy("h1", "h2").agg(F.sum("docs").alias("docs_"), F.max("id").alias("largest"))
    columns = ["id", "row", "place", "n_lines"]
    late = streamed.where(F.col("kind") == OPEN).join(F.broadcast(keys), ["h1", "h2"])
    late = late.where((F.col("docs_") >= min_docs) & (F.col("id") < F.col("largest")))
    return streamed.where(F.col("kind") == DROPPED).select(*columns).unionByName(late.select(*columns))


def packed(keep: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, row, n_lines, n_dropped, keep): the documents that lose lines, ``keep`` as of :func:`packed`."""
    @F.arrow_udf(T.BinaryType())
    def bitmap(n_lines: pa.Array, places: pa.Array) -> pa.Array:
        found = []
        for n, gone in zip(n_lines.to_pylist(), places, strict=True):
            keep = np.ones(n, dtype=bool)
            keep[gone.values.to_numpy(zero_copy_only=False)] = False
            found.append(packed(keep))
        return pa.array(found, pa.binary())

    gone = dropped_lines(line_rows(docs, min_chars), min_docs)
    # One document's own places; no more than it has lines, however often its row repeats.
    by_row = gone.groupBy("id", "row").agg(F.max("n_lines").alias("n_lines"), F.collect_set("place").alias("places"))
    return by_row.select("id", "row", "n_lines", F.size("places").alias("n_dropped"), bitmap("n_lines", "places").alias("keep"))


def kept_texts(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every document's text without its dropped lines."""
    @F.arrow_udf(T.StringType())
    def shortened(texts: pa.Array, keeps: pa.Array) -> pa.Array:
        found = []
        for text, keep in zip(texts.to_pylist(), keeps.to_pylist(), strict=True):
            if text is None:
                found.append(None)
                continue
            lines = text.split("\n")
            found.append("\n".join([lines[k] for k in np.flatnonzero(unpacked(keep, len(lines)))]))
        return pa.array(found, pa.string())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_row_key(), _text().alias("whole"))
    joined = rows.join(bitmaps.select("id", "row", "n_dropped", "keep"), ["id", "row"], "left")
    return joined.select(
        "doc_id", (F.char_length("whole") - F.char_length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(shortened(F.when(F.col("keep").isNotNull(), F.col("whole")), F.col("keep")), F.col("whole")).alias("kept"))


def digest(docs: DataFrame) -> DataFrame:
    found = kept_texts(docs, keep_bitmaps(docs))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS largest FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.doc_id, k.place, k.line, g.key IS NOT NULL AND k.doc_id < g.largest AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
