"""Benchmark decontamination by a distributed positional inverted index.

The index holds postings (term, document row, position) of the training texts. A phrase is looked up from its rarest terms:
every posting, moved back by the term's place in the benchmark item, names an alignment of item and document; alignments on
which all rare terms of a window agree are the intersection of the offset-adjusted lists. Only there the whole window is
compared with the document's words, so matches are exact. Everything runs in DataFrame functions.

Defined cases: a null or empty text has no words (0 words, 0 hits, no items); an item without words has no window; repeated
document rows give repeated result rows; rows of one id with other texts are answered row by row; items of equal words count
each by its own id; an empty benchmark leaves every document clean; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import lower_ascii, row_key, small_side
from palisade.operators.skew import hot_safe_join
from palisade.session import written

WINDOW = 13
RARE_TERMS = 3
# Broadcast bounds, in rows: vocabulary and anchor terms (some 50 bytes each), candidate document keys (16 bytes each).
TERM_ROWS = 200_000
KEY_ROWS = 1_000_000
# Items with their words and windows, some 3 kB each for a paragraph.
ITEM_ROWS = 5_000

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), GAP), "")


def n_words(text: Column) -> Column:
    """The number of words; where a word ends doesn't depend on its case."""
    return F.coalesce(F.size(F.array_remove(F.split(text, GAP_ANY_CASE), "")), F.lit(0))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key(F.col("text"), F.col("doc_id")).alias("key"), "doc_id", "text")


def occurrences(rows: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(key, pos, term) of every word of the rows' texts, or of those in ``terms``."""
    placed = rows.select("key", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return placed if terms is None else placed.join(small_side(terms, TERM_ROWS), "term", "left_semi")


def build_index(rows: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The stored index: (term, key, pos), written to the shared folder. ``terms`` keeps it to the terms that will be asked."""
    return written(occurrences(rows, terms).select("term", "key", "pos"), "postings")


def item_words(items: DataFrame) -> DataFrame:
    """(item_key, item_words, item_ids): items of equal words share one key."""
    said = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("item_words"))
    said = said.where(F.size("item_words") > 0)
    return said.groupBy("item_words").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")).withColumn(
        "item_key", F.sha2(F.concat_ws(" ", "item_words"), 256))


def windows(items: DataFrame, window: int) -> DataFrame:
    """(item_key, start, n): windows of ``window`` words; the whole item if it is shorter."""
    size = F.size("item_words")
    n = F.least(size, F.lit(window))
    return items.select("item_key", F.explode(F.sequence(F.lit(0), size - n)).alias("start"), n.alias("n"))


def rare_places(items: DataFrame, counts: DataFrame, window: int, rare: int) -> DataFrame:
    """(item_key, start, n, places): for every window the places in the item of its rarest terms.

    A term that no document has comes first, so its window can have no alignment.
    """
    terms = items.select("item_key", F.posexplode("item_words").alias("place", "term"))
    terms = terms.join(counts, "term", "left").fillna(0, ["n_postings"])
    spans = windows(items, window)
    inside = spans.join(terms, "item_key").where((F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("n")))
    order = Window.partitionBy("item_key", "start").orderBy("n_postings", "place")
    ranked = inside.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= rare)
    return ranked.groupBy("item_key", "start", "n").agg(F.collect_list(F.struct("place", "term")).alias("rare"))


def phrase_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, rare: int = RARE_TERMS) -> DataFrame:
    """Per document row that holds a window: (key, n_hit, item_ids). ``docs``: rows of :func:`keyed`."""
    said = written(item_words(items), "items")
    vocabulary = written(said.select(F.explode("item_words").alias("term")).distinct(), "vocabulary")
    counts = written(occurrences(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("n_postings")), "terms")
    spans = written(rare_places(said, counts, window, rare), "windows")
    places = spans.select("item_key", F.explode("rare").alias("r")).select("item_key", "r.place", "r.term").distinct()
    index = build_index(docs, written(places.select("term").distinct().join(counts, "term", "left_semi"), "anchors"))

    # Offset-adjusted lists: shift is where the item would begin in the document.
    moved = index.join(places, "term").select("item_key", "key", (F.col("pos") - F.col("place")).alias("shift"), "place")
    aligned = moved.groupBy("item_key", "key", "shift").agg(F.collect_set("place").alias("agreed"))
    by_item = spans.groupBy("item_key").agg(F.collect_list(
        F.struct("start", "n", F.transform("rare", lambda r: r["place"]).alias("places"))).alias("spans"))
    by_item = by_item.join(said, "item_key")
    by_item = written(by_item, "items")
    few = small_side(by_item, ITEM_ROWS)
    placed = aligned.join(few, "item_key") if few is not by_item else hot_safe_join(aligned, by_item, ["item_key"])
    alignments = placed.select(
        "key", "shift", "item_words", "item_ids",
        F.filter("spans", lambda s: (F.size(F.array_except(s["places"], F.col("agreed"))) == 0)
                 & (F.col("shift") + s["start"] >= 0)).alias("spans"),
    ).where(F.size("spans") > 0)
    candidates = written(
        alignments.groupBy("key").agg(F.collect_list(F.struct("shift", "item_words", "item_ids", "spans")).alias("found")),
        "alignments")

    # The whole windows against the words of the candidate documents.
    keys = small_side(candidates.select("key"), KEY_ROWS)
    texts = docs.join(keys, "key", "left_semi").select("key", words(F.col("text")).alias("doc_words"))
    matched = F.transform("found", lambda f: F.struct(
        f["shift"].alias("shift"), f["item_ids"].alias("item_ids"),
        F.filter(f["spans"], lambda s: F.slice(F.col("doc_words"), f["shift"] + s["start"] + 1, s["n"])
                 == F.slice(f["item_words"], s["start"] + 1, s["n"])).alias("spans")))
    hits = texts.join(candidates, "key").select("key", F.filter(matched, lambda f: F.size(f["spans"]) > 0).alias("hits"))
    covered = F.flatten(F.transform("hits", lambda f: F.flatten(F.transform(
        f["spans"], lambda s: F.sequence(f["shift"] + s["start"], f["shift"] + s["start"] + s["n"] - 1)))))
    found = hits.where(F.size("hits") > 0).select(
        "key", F.size(F.array_distinct(covered)).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda f: f["item_ids"])))).alias("item_ids"))
    return found.groupBy("key").agg(F.first("n_hit").alias("n_hit"), F.first("item_ids").alias("item_ids"))


def near(index: DataFrame, groups: DataFrame, slop: int) -> DataFrame:
    """Proximity matches: (group_id, key, pos) of each posting of a group's rarest term that has every other term of the
    group at most ``slop`` words away. ``groups``: (group_id, terms). Position blocks of ``slop`` words keep it an equi join.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n_postings"))
    terms = groups.select("group_id", F.explode(F.array_distinct("terms")).alias("term"), F.size(F.array_distinct("terms")).alias("n"))
    ranked = terms.join(counts, "term", "left").fillna(0, ["n_postings"]).withColumn(
        "nth", F.row_number().over(Window.partitionBy("group_id").orderBy("n_postings", "term")))
    posts = index.join(ranked.select("group_id", "term", "n", "nth"), "term")
    width = max(1, slop)
    block = F.floor(F.col("pos") / width)
    rarest = posts.where("nth = 1").select("group_id", "key", "n", "pos", F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    others = posts.where("nth > 1").select("group_id", "key", "nth", F.col("pos").alias("other"), block.alias("block"))
    close = rarest.join(others, ["group_id", "key", "block"]).where(F.abs(F.col("pos") - F.col("other")) <= slop)
    pairs = close.groupBy("group_id", "key", "pos", "n").agg(F.countDistinct("nth").alias("met")).where("met = n - 1")
    alone = posts.where("n = 1").select("group_id", "key", "pos")
    return pairs.select("group_id", "key", "pos").union(alone).distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit by a window, items with windows there, and whether a twentieth of the words is hit."""
    rows = keyed(docs)
    hits = phrase_hits(rows, items, window)
    n_hit = F.coalesce("n_hit", F.lit(0))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    found = rows.select("key", "doc_id", n_words(F.col("text")).cast("long").alias("n_words")).join(hits, "key", "left")
    return found.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, as they are, without the contaminated ones."""
    rows = keyed(docs)
    hits = small_side(written(phrase_hits(rows, items, window), "hits"), KEY_ROWS)
    bad = rows.join(hits, "key").where(20 * F.col("n_hit") >= n_words(F.col("text"))).select(F.col("key").alias("_row_key")).distinct()
    marked = docs.withColumn("_row_key", row_key(F.col("text"), F.col("doc_id")))
    return marked.join(small_side(written(bad, "contaminated"), KEY_ROWS), "_row_key", "left_anti").select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sizes AS (SELECT DISTINCT least(13, len(w)) AS n FROM b WHERE len(w) > 0),
spans AS (
  SELECT DISTINCT item_id, n, w[s : s + n - 1] AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
        FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, s, w[s : s + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.n, p.s, x.item_id FROM places p JOIN spans x USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM found) GROUP BY 1),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
         FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY 1)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN item ON d.doc_id = item.doc_id
"""
