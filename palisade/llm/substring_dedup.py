"""Substring dedup: spans of 50 or more words that a document with a smaller id also holds are removed.

Matching statistics come from suffix automata of reference shards. A broadcast of automata of the whole corpus to every
document would be corpus times corpus, so the shards are routed instead: every window of 50 words chooses the smallest of its
25-word hashes as its anchor, which equal windows choose alike, and windows next to each other with one anchor form a context.
A shard holds the contexts of some anchors. Its task streams them in the order of their documents through the shard's automaton
(of all smaller documents so far), takes the windows whose matching statistic reaches 50, and then adds them to it.

Contexts that are equal as a whole need no automaton: all but the smallest document lose them. Anchors with more than
HOT_CONTEXTS different contexts would be one large group; their windows are counted one by one as rows instead, which splits
over any number of tasks and gives the same answer.

Words count as equal if their 64-bit hashes are; contexts if two of them are.

Defined cases: null and empty texts have no words and keep nothing (hash of the empty text); texts below 50 words stay whole;
repeated rows of one id don't remove each other; rows without an id neither lose nor give spans; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import small_side
from palisade.llm.hashing import BASE, INVERSE, mixed, power, text_chunks, word_hashes
from palisade.session import written

WINDOW, GRAM = 50, 25
HOT_CONTEXTS = 500
SHARD_CONTEXTS = 1000
KEY_ROWS = 1_000_000
EVERY = 2**31 - 1


def runs(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes of the word runs [start, end); ``rows`` are the prefix sums of the words' hashes."""
    return mixed((rows[ends] - rows[starts]) * power(INVERSE, len(hashes) + 1)[starts] + (ends - starts).astype(np.uint64))


def prefix(hashes: np.ndarray) -> np.ndarray:
    rows = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * power(BASE, len(hashes)), out=rows[1:])
    return rows


def contexts(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, context hash, first window, windows) of a document's word hashes."""
    n = len(hashes)
    none = np.zeros(0, dtype=np.int64)
    if n < window:
        return none, none, none, none
    rows = prefix(hashes)
    at = np.arange(n - gram + 1)
    grams = runs(hashes, at, at + gram, rows)
    each = window - gram + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, each).argmin(axis=1) + np.arange(n - window + 1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.append(first, len(place)))
    whole = runs(hashes, first, first + count + window - 1, rows)
    return grams[place[first]].view(np.int64), whole.view(np.int64), first, count


def documents_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    for i, j, data, starts in text_chunks(texts):
        hashes, _, _, at = word_hashes(data, starts, lower=False)
        for k in range(j - i):
            yield hashes[at[k] : at[k + 1]]


class Automaton:
    """A generalized suffix automaton over word hashes, grown online."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _new(self, size: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state for the strings of ``q`` that end behind ``p``, on its own."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._new(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word, self.next[last][word])
                continue
            state, p = self._new(self.size[last] + 1, 0, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._split(p, word, self.next[p][word])
            last = state

    def matched(self, words: list[int]) -> list[int]:
        """Matching statistics: for every word the length of the longest known string that ends with it."""
        found, state, length = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            found.append(length)
        return found


def matched_windows(rows: list[tuple[int, int, bytes]], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """``rows``: (document, context, words) of one shard. (document, context, first, last) runs of windows within a context
    that a smaller document's context holds."""
    automaton = Automaton()
    by_doc: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for doc, context, words in rows:
        by_doc[doc].append((context, np.frombuffer(words, dtype=np.uint64).tolist()))
    found = []
    for doc in sorted(by_doc):
        for context, words in by_doc[doc]:
            hit = [k - window + 1 for k, n in enumerate(automaton.matched(words)) if n >= window]
            for k in hit:
                if found and found[-1][:2] == (doc, context) and found[-1][3] == k - 1:
                    found[-1] = (doc, context, found[-1][2], k)
                else:
                    found.append((doc, context, k, k))
        for _, words in by_doc[doc]:
            automaton.add(words)
    return found


def context_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, context, doc_id), each once per text, written to the shared folder."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for doc_id, hashes in zip(batch.column(0).to_pylist(), documents_hashes(batch.column(1)), strict=True):
                anchor, context, _, _ = contexts(hashes, window, gram)
                if len(context):
                    _, once = np.unique(context, return_index=True)
                    parts.append((anchor[once], context[once], np.full(len(once), doc_id)))
            columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "context", "doc_id"])

    return written(docs.where("doc_id is not null").mapInArrow(emit, "anchor long, context long, doc_id long"), "contexts")


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, context, lo, hi): windows lo to hi of a context of a document start in a smaller document too."""
    placed = context_rows(docs, window, gram)
    owned = written(placed.groupBy("anchor", "context").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
                    .select("anchor", "context", "owner", "last"), "owners")

    # Equal contexts: all documents but the smallest lose all windows.
    copies = owned.where("last > owner").select("anchor", "context", "owner")
    whole = placed.join(copies, ["anchor", "context"]).where("doc_id > owner").select(
        "doc_id", "context", F.lit(0).alias("lo"), F.lit(EVERY).alias("hi"))

    # Anchors with several contexts: their words, from the smallest document that has them.
    mixed_ = owned.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("a"), F.max("owner").alias("z"))
    wanted = owned.join(mixed_.where("n > 1 and z > a").select("anchor", "n"), "anchor").select(
        F.col("owner").alias("doc_id"), "anchor", "context", (F.col("n") > HOT_CONTEXTS).alias("hot"))
    lists = written(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("context", "hot")).alias("wanted")), "wanted")
    keys = small_side(lists.select("doc_id"), KEY_ROWS)
    texts = docs.join(keys, "doc_id", "left_semi").join(lists, "doc_id").select("doc_id", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "doc_id", "hot", "words"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, hashes, asked in zip(batch.column(0).to_pylist(), documents_hashes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                hot = {w["context"]: w["hot"] for w in asked}
                anchor, context, first, count = contexts(hashes, window, gram)
                for a, c, f, n in zip(anchor.tolist(), context.tolist(), first.tolist(), count.tolist(), strict=True):
                    if c in hot:
                        rows.append((a, c, doc_id, hot.pop(c), hashes[f : f + n + window - 1].tobytes()))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    pieces = written(texts.mapInArrow(cut, "anchor long, context long, doc_id long, hot boolean, words binary"), "pieces")

    # Reference shards of about SHARD_CONTEXTS contexts.
    cold = pieces.where("not hot")
    shards = max(1, -(-cold.count() // SHARD_CONTEXTS))

    def streamed(pdf: pd.DataFrame) -> pd.DataFrame:
        found = matched_windows(list(zip(pdf["doc_id"].tolist(), pdf["context"].tolist(), pdf["words"].tolist(), strict=True)), window)
        return pd.DataFrame(found, columns=["doc_id", "context", "lo", "hi"])

    result = "doc_id long, context long, lo int, hi int"
    partial = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(streamed, result)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, context, words in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "context", "words")), strict=True):
                hashes = np.frombuffer(words, dtype=np.uint64)
                at = np.arange(len(hashes) - window + 1)
                own = runs(hashes, at, at + window, prefix(hashes)).view(np.int64)
                again = runs(hashes[::-1].copy(), at, at + window, prefix(hashes[::-1])).view(np.int64)[::-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), doc_id)), pa.array(np.full(len(at), context)), pa.array(at.astype(np.int32)),
                     pa.array(own), pa.array(again)], ["doc_id", "context", "at", "h1", "h2"])

    single = pieces.where("hot").mapInArrow(windows, "doc_id long, context long, at int, h1 long, h2 long")
    single = written(single, "windows")
    first = single.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    hot = single.join(first.select("h1", "h2", "first"), ["h1", "h2"]).where("doc_id > first").select(
        "doc_id", "context", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return whole.union(partial).union(hot)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept (text: the kept words joined by one space), kept_sha256."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lists = written(repeated(docs, window, gram).groupBy("doc_id").agg(
        F.collect_list(F.struct("context", "lo", "hi")).alias("spans")), "spans")
    keys = small_side(lists.select("doc_id"), KEY_ROWS)
    touched = docs.join(keys, "doc_id", "left_semi").join(lists, "doc_id").select("doc_id", "text", "spans")
    none = F.lit(None).cast("array<struct<context:long,lo:int,hi:int>>").alias("spans")
    clean = docs.join(keys, "doc_id", "left_anti").select("doc_id", "text", none)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, texts, marks = [], [], [], []
            ids, raw, spans = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for k, (text, own) in enumerate(zip(raw, spans, strict=True)):
                words = (text or "").encode().split()
                if own:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    by = defaultdict(list)
                    for s in own:
                        by[s["context"]].append((s["lo"], s["hi"]))
                    hashes = next(documents_hashes(batch.column(1).slice(k, 1)))
                    _, context, first, count = contexts(hashes, window, gram)
                    for c, f, n in zip(context.tolist(), first.tolist(), count.tolist(), strict=True):
                        for lo, hi in by.get(c, ()):
                            gone[f + lo] += 1
                            gone[f + min(hi, n - 1) + window] -= 1
                    keep = np.cumsum(gone[:-1]) == 0
                    left = [words[i] for i in np.flatnonzero(keep)]
                else:
                    left = words
                joined = b" ".join(left)
                total.append(len(words))
                removed.append(len(words) - len(left))
                texts.append(joined.decode())
                marks.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(marks, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    schema = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    return touched.mapInArrow(kept, schema).union(clean.mapInArrow(kept, schema))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM win JOIN first USING (h) WHERE m < doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS k FROM d WHERE len(w) > 0),
kept AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY k) AS t
  FROM word LEFT JOIN (SELECT doc_id, k, true AS out FROM gone) USING (doc_id, k) WHERE out IS NULL GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
