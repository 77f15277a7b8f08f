"""Best-fit packing of documents into token sequences: bounded-space online best-fit.

Tokenizing is narrow (one Arrow function); only lengths travel. Pieces are dealt over groups of bounded size. In a group a
fixed number of bins is open; the open bins hang on their free space, and a bitset of the free spaces that occur finds the
tightest fit in one step. When one more bin must open, the fullest closes. Pieces come through a buffer of bounded length that
hands them on longest first. Bins left open at the end of a group are packed
once more, as whole bundles, across groups.

Words are looked up in a bounded cache of pre-tokens, filled by the vocabulary's ranks; texts beyond Latin-1, and
those that hold the content of an added token such as <|endoftext|>, go to the tokenizer as a whole. Both give the tokenizer's own ids (tested).

Defined cases: a null text counts as empty and gives the one piece that holds the end id; repeated rows are packed each;
a document longer than a sequence is cut, its first piece being the shorter one; extra columns are ignored; no documents give
no rows.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.session import written

CAPACITY = 2048
END_ID = 0
OPEN_BINS = 1024
BUFFER = 4096
# A group holds about so many tokens and rows; what one task packs is bounded by it.
GROUP_TOKENS = 16_000_000
GROUP_ROWS = 100_000
GROUPS_PER_MERGE = 32
CACHED_WORDS = 500_000
VOCABULARY = "byte_bpe_50k"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# The byte-level pre-token pattern of the tokenizer for characters up to U+00FF: letters, numbers and white space as Unicode
# classes them there.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
PRE_TOKEN = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class WordCache:
    """Token ids of texts, as little-endian 32-bit bytes."""

    def __init__(self, name: str = VOCABULARY, most: int = CACHED_WORDS):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.words = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.most = most
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = array("I", self.words.encode_ordinary(word))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def ids(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            return self.whole(text)
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.whole(text)
        parts = PRE_TOKEN.findall(text)
        missing = set(parts).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > self.most:
                self.known = {}
                missing = set(parts)
            for word in missing:
                self.known[word] = self._word(word)
        return b"".join(map(self.known.__getitem__, parts))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; beyond one sequence the first is the shorter one."""
    first = n % capacity if n > capacity else n
    starts = range(first, n, capacity)
    return ([(0, first)] if first else []) + [(s, capacity) for s in starts]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; ``keep_ids`` adds the ids themselves."""
    end = np.asarray([END_ID], dtype="<u4").tobytes()
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = cache.ids(text or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(own), *([np.frombuffer(own, "<u4").astype("i4")] if keep_ids else [])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tokenized, schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of every item, in the given order, and the bins still open at the end.

    ``by_free[f]`` lists the open bins with ``f`` free ids and bit ``f`` of ``there`` tells whether there are any.
    """
    by_free: dict[int, list[int]] = {}
    there = opened = n_bins = 0
    bins, places = [], []
    for length in lengths:
        fitting = there >> length << length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1
            bin_ = by_free[free].pop()
            if not by_free[free]:
                there &= ~(1 << free)
            opened -= 1
        else:
            free, bin_ = capacity, n_bins
            n_bins += 1
            if opened == open_bins and length < capacity:
                fullest = (there & -there).bit_length() - 1
                by_free[fullest].pop(0)
                if not by_free[fullest]:
                    there &= ~(1 << fullest)
                opened -= 1
        bins.append(bin_)
        places.append(capacity - free)
        if free > length:
            by_free.setdefault(free - length, []).append(bin_)
            there |= 1 << (free - length)
            opened += 1
    return bins, places, [b for held in by_free.values() for b in held]


def _deal(rows: DataFrame, key: list[str], groups: int) -> DataFrame:
    return rows.withColumn("deal", F.xxhash64(*key)).withColumn("grp", F.pmod("deal", F.lit(groups)))


def pack(rows: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, group_tokens: int = GROUP_TOKENS,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` of :func:`pieces` with sequence_id and offset. ``rows`` is read twice: give a written table."""
    total = rows.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, -(-total[0] // group_tokens), -(-total[1] // group_rows))
    names = [c for c in rows.columns if c != "ids"]

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("deal", "doc_id", "piece", "ids_crc32")])
        length, at = group["length"].to_numpy(), np.arange(len(group))
        group = group.take(pa.array(np.lexsort((at, -length, at // BUFFER))))
        bins, places, left = best_fit(group["length"].to_pylist(), capacity, open_bins)
        ids = np.asarray(bins, dtype=np.int64)
        top = group["grp"][0].as_py() << 32 if len(ids) else 0
        done = group.select(names).append_column("sequence_id", pa.array(ids + top))
        return done.append_column("offset", pa.array(places, pa.int64())).append_column("open", pa.array(np.isin(ids, left)))

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    dealt = _deal(rows.select(*names), ["doc_id", "piece", "ids_crc32"], groups)
    first = written(dealt.groupBy("grp").applyInArrow(packed, f"{schema}, sequence_id long, offset long, open boolean"), "packed")

    # Bins left open, as bundles across groups.
    bundles = first.where("open").groupBy("sequence_id").agg(F.sum("length").alias("length"))
    merges = -(-groups // GROUPS_PER_MERGE)

    def merged(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("sequence_id", "ascending")])
        bins, places, _ = best_fit(group["length"].to_pylist(), capacity, len(group) + 1)
        top = (1 << 62) + (group["grp"][0].as_py() << 32) if len(group) else 0
        return pa.table({"sequence_id": group["sequence_id"], "into": pa.array(np.asarray(bins, dtype=np.int64) + top),
                         "at": pa.array(places, pa.int64())})

    moved = _deal(bundles, ["sequence_id"], merges).groupBy("grp").applyInArrow(merged, "sequence_id long, into long, at long")
    return first.join(moved, "sequence_id", "left").select(
        *names, F.coalesce("into", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"))


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(pieces(docs, capacity, vocabulary), "pieces"), capacity)
