"""Near-duplicate documents by HyperMinHash.

Each shingle hash falls into one of 128 buckets by its first bits; the bucket keeps its smallest remainder as a 16-bit register:
leading-zero count plus mantissa bits. Empty buckets borrow from others by a fixed probing order. Bands of four registers make
the candidate groups. Documents of equal shingle sets are first merged into classes, so exact copies never meet in a group.

A group is linked through its smallest member (a star), never as all pairs: the collision-corrected estimate drops what is far
off, the rest is confirmed on the full sets. Members that stay apart are compared with one more member drawn from their groups;
the few that then still are in another component are compared with all members of the components they meet: pair by pair with
small ones, block by block on full sets with large ones. So no link between two different sets of one group is lost. Components are min-label propagation over the confirmed links.

Defined cases: null and empty texts have no shingles and stay alone; repeated rows belong to one class; of an id with several
texts the greatest set of hashes stands where a pair is confirmed; a null id gets the class's component and is not kept; extra
columns are ignored; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import small_side
from palisade.llm.hashing import mixed, shingle_sets
from palisade.operators.skew import hot_safe_join
from palisade.session import written

BUCKETS, BANDS, MANTISSA = 128, 32, 10
# Rounds in which members that are still apart meet one drawn member of each of their groups.
DRAWS = 1
# Components of so many members are asked as a whole, in blocks of so many documents on either side.
LARGE, BLOCK = 16, 256
# Set sizes are told apart by powers of two for the chance of agreement.
GRADES = 21
PERCENT = 80
# The estimate may fall so many standard deviations below the threshold before a pair is dropped: of pairs exactly at the
# threshold one in 300 000. A wider margin confirms many times more pairs of large groups that are nearly similar.
DEVIATIONS = 4.5
# Sets of fewer shingles fill too few buckets for an estimate; their pairs are all confirmed.
ESTIMATE_FROM = 64
# Broadcast bound in rows of (id, partner ids).
PAIR_ROWS = 200_000
KEY_ROWS = 1_000_000

_REST = np.uint64(64 - 7)


def _probes() -> np.ndarray:
    """For each bucket the order in which it asks others when it is empty; the same for all documents."""
    n = BUCKETS * BUCKETS
    keys = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, BUCKETS)
    order = np.argsort(keys, axis=1, kind="stable")
    return order.astype(np.int64)


_PROBES = _probes()


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 128 registers (uint16) of a non-empty sorted set of hashes, empty buckets filled by borrowing."""
    bucket = (hashes >> _REST).astype(np.int64)
    first = np.searchsorted(bucket, np.arange(BUCKETS))
    filled = np.flatnonzero((first < len(hashes)) & (bucket[np.minimum(first, len(hashes) - 1)] == np.arange(BUCKETS)))
    rest = hashes[first[filled]] & np.uint64((1 << 57) - 1)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = 57 - exponent
    mantissa = np.maximum(0, (fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out = np.zeros(BUCKETS, dtype=np.uint16)
    out[filled] = (zeros << MANTISSA) | mantissa
    if len(filled) < BUCKETS:
        has = np.zeros(BUCKETS, dtype=bool)
        has[filled] = True
        empty = np.flatnonzero(~has)
        order = _PROBES[empty]
        out[empty] = out[order[np.arange(len(empty)), np.argmax(has[order], axis=1)]]
    return out


def _collisions() -> np.ndarray:
    """Chance that registers of two unrelated sets agree, by the log2 of hashes per bucket of either."""
    edges = np.concatenate([[0.0], *[2.0 ** -(z + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) for z in range(24, -1, -1)], [1.0]])
    alive = [np.exp(2.0**k * np.log1p(-np.minimum(edges, 1 - 1e-12))) for k in range(GRADES)]
    cells = np.array([a[:-1] - a[1:] for a in alive])
    return cells @ cells.T


_CHANCE = _collisions()


def estimated(ra: Column, rb: Column, na: Column, nb: Column) -> Column:
    """Collision-corrected Jaccard estimate from two arrays of bands and the set sizes."""
    lane = lambda z, k: F.when(F.shiftrightunsigned(z, 16 * k).bitwiseAND(F.lit(0xFFFF)) == 0, 1).otherwise(0)
    agree = F.aggregate(F.zip_with(ra, rb, lambda x, y: x.bitwiseXOR(y)), F.lit(0),
                        lambda n, z: n + lane(z, 0) + lane(z, 1) + lane(z, 2) + lane(z, 3))
    grade = lambda n: F.least(F.lit(GRADES - 1), F.greatest(F.lit(0), F.round(F.log2(n / BUCKETS)).cast("int")))
    chance = F.element_at(F.array(*[F.lit(float(c)) for c in _CHANCE.ravel()]), grade(na) * GRADES + grade(nb) + 1)
    return (agree / BUCKETS - chance) / (1 - chance)


def _likely(ra: Column, rb: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether sizes and corrected estimate allow ``percent``. Small sets have no estimate.

    Only the buckets that a set fills itself tell something, the others repeat them: n hashes fill 128 (1 - exp(-n / 128)).
    """
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    filled = BUCKETS * (1 - F.exp(-F.least(na, nb) / BUCKETS))
    margin = DEVIATIONS * F.sqrt(F.lit(percent / 100 * (1 - percent / 100)) / filled)
    return sizes & F.when(F.least(na, nb) < ESTIMATE_FROM, True).otherwise(estimated(ra, rb, na, nb) >= percent / 100 - margin)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n, h1, h2, bands): set size, a 128-bit hash of the set, 32 bands of four registers. Written once."""
    schema = "doc_id long, n long, h1 long, h2 long, bands array<long>"

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, bands = [], [], [], []
            for found in shingle_sets(batch.column(1), shingle, lower=True):
                n.append(len(found))
                h1.append(mixed(found).sum(dtype=np.uint64).astype(np.int64) if len(found) else 0)
                h2.append(mixed(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64) if len(found) else 0)
                bands.append(registers(found).view("<u8").astype(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n", "h1", "h2", "bands"])

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(signed, schema), "signatures")


def _close(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and corrected estimate allow ``percent``."""
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bands").alias("ra"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bands").alias("rb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_likely(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb"), percent)).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent``; ``pairs`` is a written table.

    Sets travel once per pair, to the pair's second document, where both are compared.
    """
    targets = pairs.groupBy("a").agg(F.collect_list("b").alias("to"))
    ends = pairs.select(F.col("b").alias("a")).distinct().withColumn("own", F.lit(True))
    wanted = written(targets.join(ends, "a", "full").select(F.col("a").alias("doc_id"), "to", F.coalesce("own", F.lit(False)).alias("own")), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(wanted, PAIR_ROWS), "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"b": pa.int64(), "a": pa.int64(), "hashes": pa.binary()}
        for batch in batches:
            rows: dict[str, list] = {"b": [], "a": [], "hashes": []}
            held = 0
            ids, to, own = (batch.column(c).to_pylist() for c in ("doc_id", "to", "own"))
            for doc_id, partners, is_end, found in zip(ids, to, own, shingle_sets(batch.column("text"), shingle, lower=True), strict=True):
                data = found.tobytes()
                for b, a in [(p, doc_id) for p in partners or []] + ([(doc_id, None)] if is_end else []):
                    rows["b"].append(b)
                    rows["a"].append(a)
                    rows["hashes"].append(data)
                    held += len(data)
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(rows[c], k) for c, k in kinds.items()], list(kinds))
                    rows, held = {c: [] for c in kinds}, 0
            yield pa.RecordBatch.from_arrays([pa.array(rows[c], k) for c, k in kinds.items()], list(kinds))

    shipped = texts.select("doc_id", "text", "to", "own").mapInArrow(sets, "b long, a long, hashes binary")
    ends_ = shipped.where("a is null").groupBy("b").agg(F.max("hashes").alias("theirs"))
    meet = hot_safe_join(shipped.where("a is not null"), ends_, ["b"], keys_from=pairs)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for x, y in zip(batch.column("hashes"), batch.column("theirs"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                passed.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return written(meet.select("a", "b", "hashes", "theirs").mapInArrow(compared, "a long, b long").distinct(), "links")


def _split(apart: DataFrame, label: DataFrame) -> DataFrame:
    """(band, key, rep, comp) of the groups that hold several components."""
    labelled = apart.select("band", "key", "rep").join(label, "rep", "left").select("band", "key", "rep", F.coalesce("comp", "rep").alias("comp"))
    split = labelled.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band", "key")
    return written(labelled.join(split, ["band", "key"], "left_semi"), "apart")


def _met(small: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different components that share a group and may reach ``percent``, each once.

    A pair meets in every band in which its registers agree and is made in the first of them. ``small``: (band, key, rep, comp, n,
    bands) with all members of a group, of any group that holds several components.
    """
    x = small.select("band", "key", F.col("rep").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"), F.col("bands").alias("ra"))
    y = small.select("band", "key", F.col("rep").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("bands").alias("rb"))
    first = F.array_position(F.zip_with("ra", "rb", lambda p, q: p == q), True) == x["band"] + 1
    likely = _likely(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb"), percent)
    both = (x["band"] == y["band"]) & (x["key"] == y["key"]) & (F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb"))
    return x.join(y, both & first & likely).select("a", "b")


def _asked(asked: DataFrame, label: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of documents a with a member b of the component that each is asked against, one for each block at most.

    ``asked``: (a, comp), written. Members and asking documents are dealt into blocks; every pair of blocks is one group of
    bounded size, in which full sets are compared.
    """
    members = label.join(asked.select("comp").distinct(), "comp", "left_semi")
    blocks = lambda rows, name: rows.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    dealt = blocks(members, "blocks").join(blocks(asked, "loads"), "comp")
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    theirs = members.join(dealt, "comp").select(F.col("rep").alias("doc_id"), F.transform(
        F.sequence(F.lit(0), F.col("loads") - 1), lambda k: F.struct(F.col("comp"), deal("rep", "blocks").alias("block"), k.alias("load"), F.lit(False).alias("asks"))).alias("to"))
    ours = asked.join(dealt, "comp").select(F.col("a").alias("doc_id"), F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.col("comp"), k.alias("block"), deal("a", "loads").alias("load"), F.lit(True).alias("asks"))).alias("to"))
    wanted = written(theirs.union(ours).groupBy("doc_id").agg(F.flatten(F.collect_list("to")).alias("to")), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(wanted, PAIR_ROWS), "doc_id")
    kinds = {"comp": pa.int64(), "block": pa.int32(), "load": pa.int32(), "asks": pa.bool_(), "doc_id": pa.int64(), "hashes": pa.binary()}

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, to = batch.column("doc_id").to_pylist(), batch.column("to").to_pylist()
            for doc_id, places, found in zip(ids, to, shingle_sets(batch.column("text"), shingle, lower=True), strict=True):
                data = found.tobytes()
                for at in range(0, len(places), 64):
                    rows = [{**p, "doc_id": doc_id, "hashes": data} for p in places[at : at + 64]]
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(list(kinds.items())))

    def compared(group: pa.Table) -> pa.Table:
        rows = {d: (asks, h) for d, asks, h in zip(*(group[c].to_pylist() for c in ("doc_id", "asks", "hashes")), strict=True)}
        own = [(d, np.frombuffer(h, dtype=np.uint64)) for d, (asks, h) in sorted(rows.items()) if not asks]
        found = []
        if own:
            sizes = np.array([len(h) for _, h in own])
            values = np.concatenate([h for _, h in own])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(len(own)), sizes)[order]
            for d, (asks, h) in sorted(rows.items()):
                if not asks:
                    continue
                mine = np.frombuffer(h, dtype=np.uint64)
                lo, hi = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
                hits = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum())
                both = np.bincount(owner[hits], minlength=len(own))
                linked = np.flatnonzero(100 * both >= percent * (sizes + len(mine) - both))
                if len(linked):
                    found.append((max(d, own[linked[0]][0]), min(d, own[linked[0]][0])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    rows = texts.select("doc_id", "text", "to").mapInArrow(sets, "comp long, block int, load int, asks boolean, doc_id long, hashes binary")
    return written(rows.groupBy("comp", "block", "load").applyInArrow(compared, "a long, b long").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(rep, comp): for every linked id the smallest id it reaches, by min-label propagation with shortcuts."""
    both = written(links.select("a", "b").union(links.select("b", "a")), "edges")
    label = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(label.select(F.col("a").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        # Where the own label's label is smaller, jump to it.
        jump = label.select(F.col("a").alias("comp"), F.col("comp").alias("j"))
        new = label.join(near, "a").join(jump, "comp", "left").select(
            "a", F.least("comp", "c", "j").alias("new"), "comp")
        new = written(new, "labels")
        if new.where("new < comp").isEmpty():
            return label.select(F.col("a").alias("rep"), "comp")
        label = new.select("a", F.col("new").alias("comp"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (smallest id of equal sets) and component_id."""
    signed = signatures(docs, shingle)
    classes = written(signed.where("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "bands"))).alias("m")).select(
        "h1", "h2", "n", F.col("m.doc_id").alias("rep"), F.col("m.bands").alias("bands")), "classes")
    reps = classes.where("rep is not null").select("rep", "n", "bands")
    placed = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    groups = placed.groupBy("band", "key").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("members")).where("members > 1")
    grouped = written(placed.join(groups.select("band", "key", "center"), ["band", "key"]), "groups")

    # Star: every member against the smallest of its groups.
    stars = grouped.where("rep <> center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    tried = written(_close(stars, reps, percent), "stars")
    links = _confirmed(tried, docs, shingle, percent)

    # Members that are still apart meet one more member of each group, drawn anew.
    apart = grouped.select("band", "key", "rep")
    for draw in range(DRAWS):
        apart = _split(apart, components(links))
        partner = F.min_by(F.struct(F.col("rep").alias("other"), F.col("comp").alias("other_comp")), F.xxhash64("rep", "band", F.lit(draw)))
        met = apart.join(apart.groupBy("band", "key").agg(partner.alias("p")).select("band", "key", "p.*"), ["band", "key"])
        pairs = met.where("comp <> other_comp").select(F.greatest("rep", "other").alias("a"), F.least("rep", "other").alias("b")).distinct()
        pairs = written(_close(pairs.join(tried, ["a", "b"], "left_anti"), reps, percent), "pairs")
        links = written(links.union(_confirmed(pairs, docs, shingle, percent)), "links")
        tried = tried.union(pairs)

    # What is apart then: small components pair by pair, each document against a large component as a whole.
    label = written(components(links), "labels")
    sizes = label.groupBy("comp").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LARGE)
    apart = written(_split(apart, label).join(sizes, "comp", "left").fillna(1, ["size"]).join(reps, "rep"), "apart")
    small, large = apart.where(F.col("size") < LARGE), apart.where(F.col("size") >= LARGE)
    near = _met(small, percent)
    near = written(near.join(tried, ["a", "b"], "left_anti"), "pairs")
    whole = large.select("band", "key", F.col("comp").alias("whole"), F.col("size").alias("of")).distinct()
    lower = F.struct("size", "comp") < F.struct("of", "whole")
    asked = apart.join(whole, ["band", "key"]).where(lower).select(F.col("rep").alias("a"), F.col("whole").alias("comp")).distinct()
    links = links.union(_confirmed(near, docs, shingle, percent)).union(_asked(written(asked, "asked"), label, docs, shingle, percent))
    joined = components(links)

    of_class = classes.join(joined, "rep", "left").select("h1", "h2", "n", "rep", F.coalesce("comp", "rep").alias("comp"))
    return signed.select("doc_id", "n", "h1", "h2").join(of_class, ["h1", "h2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("class_id"),
        F.coalesce("comp", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, as they are, but one document of each group: the smallest id. Rows without an id stay."""
    found = written(near_duplicates(docs, shingle, percent).select("doc_id", "component_id"), "components")
    gone = small_side(written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone"), KEY_ROWS)
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    # Repeated rows of one id: only these move.
    again = written(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null").select(
        F.col("doc_id").alias("_again")), "again")
    if again.isEmpty():
        return left
    again = small_side(again, KEY_ROWS)
    once = left.join(again, left["doc_id"] == again["_again"], "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, left["doc_id"] == again["_again"], "left_anti").unionByName(once)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(2, len(w)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(2, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * k >= 80 * (p.n + q.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT e.a, r.c FROM edge e JOIN reach r ON e.b = r.a),
comp AS (SELECT a, min(c) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN comp ON d.doc_id = comp.a
"""
