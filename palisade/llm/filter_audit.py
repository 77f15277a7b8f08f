"""Filter interaction audit: what every filter of a chain removes, in every order, and each filter's exact Shapley share.

A document's failures are one bit per filter, so a part of the table is known once its documents are counted by bit set: 2 ** n
numbers, added up in the map tasks. From them comes the table of coalitions: how many documents any filter of a coalition
removes. Every step of every order is a difference of two coalitions. The Shapley shares are the solution of the kernel-weighted
least squares over all coalitions under the constraint that the shares add up to what all filters remove together. Its normal
equations are solved once in rationals; times n! the solution has whole coefficients, which Spark applies to the long counts
of each part, so any number of parts gives exact results.

Texts that repeat are found by their SHA-256. Copies are first folded to one row per (text, part, labels), so a text that a third
of all documents share travels as a few rows; only such folded rows meet in the window by text.

Defined cases: a null text is the empty one, a null source the empty part; a document without id has no smaller id and is none
for others; rows that repeat count each, and rows of one id are no copies of each other; of several label rows of an id any 1
wins; an empty table has no parts and gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import spaced_words

# The conditions of the audited chain.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, MARKS = 50, 65, 5, "[#$%&*|]"
FILTERS = "ABCDE"
_STEP = "array<struct<filter_order: string, step: int, own: int, before: int, after: int, alone: int, others: int>>"


def own_failures(text: Column) -> Column:
    """The bits of the conditions that a text alone decides: A short, B repetitive, C loud, D holds a mark."""
    words = spaced_words(text)
    upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bit(place: int, condition: Column) -> Column:
        return F.when(condition, F.lit(1 << place)).otherwise(0)

    return F.transform(F.array(words), lambda w: (
        bit(0, F.size(w) < MIN_WORDS)
        + bit(1, 100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * F.size(w))
    ))[0] + bit(2, 100 * upper > MAX_UPPER_PERCENT * F.char_length(text)) + bit(3, text.rlike(MARKS))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents, and those of good and toxic label, by part and set of failed filters."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), own_failures(text).alias("own"),
    )
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = rows.join(marks, "doc_id", "left").withColumns({
        "good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))})
    # Rows of one id first, on the join's partitioning; then copies of one text.
    ids = marked.groupBy("doc_id", "digest", "part", "own", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    folded = ids.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    least = F.min("least.doc_id").over(Window.partitionBy("digest"))
    first = F.when(F.col("least.doc_id") == F.col("of_text"), F.col("least.n")).otherwise(0) + F.col("nameless")
    copies = folded.withColumn("of_text", least).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("own").alias("failed"), first.alias("n")),
            F.struct((F.col("own") + (1 << 4)).alias("failed"), (F.col("n") - first).alias("n")))))
    return copies.where("n > 0").groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def coalitions(counts: DataFrame, filters: int) -> DataFrame:
    """(part, coalition, n, removed, good, toxic): what any filter of each of the 2 ** filters coalitions removes in a part."""
    def gone(value: str) -> Column:
        return F.sum(F.when(F.col("failed").bitwiseAND(F.col("coalition")) != 0, F.col(value)).otherwise(0))

    every = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
    return every.groupBy("part", "coalition").agg(
        F.sum("n").alias("n"), gone("n").alias("removed"), gone("good").alias("good"), gone("toxic").alias("toxic"))


def _solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The exact solution of matrix * x = right by elimination."""
    n = len(matrix)
    rows = [[*a, *b] for a, b in zip(matrix, right, strict=True)]
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [v / rows[k][k] for v in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [v - rows[i][k] * w for v, w in zip(rows[i], rows[k], strict=True)]
    return [row[n:] for row in rows]


def shapley_coefficients(filters: int) -> list[list[int]]:
    """For each filter, the whole number by which each coalition's value counts in n! times its Shapley share.

    Least squares of value(S) against the sum of the shares in S, weighted by (n - 1) / (C(n, s) s (n - s)) over all proper
    coalitions, under the constraint that all shares add up to the value of the full coalition: the normal equations with one
    Lagrange multiplier, solved in rationals for every unit value at once.
    """
    full = (1 << filters) - 1
    inside = [[(s >> i) & 1 for i in range(filters)] for s in range(full + 1)]
    weight = [Fraction(0)] * (full + 1)
    for s in range(1, full):
        size = sum(inside[s])
        weight[s] = Fraction(filters - 1, comb(filters, size) * size * (filters - size))
    if filters == 1:
        return [[0, 1]]
    normal = [[sum(weight[s] * inside[s][i] * inside[s][j] for s in range(full + 1)) for j in range(filters)] + [Fraction(1)]
              for i in range(filters)]
    normal.append([Fraction(1)] * filters + [Fraction(0)])
    right = [[weight[s] * inside[s][i] for s in range(full + 1)] for i in range(filters)]
    right.append([Fraction(int(s == full)) for s in range(full + 1)])
    shares = [[factorial(filters) * v for v in row] for row in _solved(normal, right)[:filters]]
    assert all(v.denominator == 1 for row in shares for v in row)
    return [[int(v) for v in row] for row in shares]


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``counts`` as of :func:`failure_counts`, bit k standing for the filter named by letter k.
    """
    n = len(filters)
    full = (1 << n) - 1
    table = coalitions(counts, n).groupBy("part").agg(
        F.max("n").alias("n"),
        # 2 ** n entries, whatever the part's size.
        F.array_sort(F.collect_list(F.struct("coalition", "removed", "good", "toxic"))).alias("of"))
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, k in enumerate(order, start=1):
            steps.append({"filter_order": "".join(filters[i] for i in order), "step": step, "own": k, "before": before,
                          "after": before | 1 << k, "alone": 1 << k, "others": full & ~(1 << k)})
            before |= 1 << k

    def value(coalition: str, name: str = "removed") -> Column:
        return F.get("of", F.col(coalition))[name]

    shares = F.array(*[
        sum((c * F.get("of", F.lit(s))["removed"] for s, c in enumerate(row) if c), F.lit(0).cast("long"))
        for row in shapley_coefficients(n)])
    opened = table.withColumns({"shares": shares, "all": F.get("of", F.lit(full))["removed"]}).select(
        "part", "n", "of", "shares", "all", F.inline(F.from_json(F.lit(json.dumps(steps)), _STEP)))
    removed = value("after") - value("before")
    return opened.select(
        "part", "filter_order", "step",
        (F.col("n") - value("after")).alias("kept"), removed.alias("removed"),
        (value("alone") - removed).alias("redundant"), (F.col("all") - value("others")).alias("unique_fails"),
        (value("after", "good") - value("before", "good")).alias("good_lost"),
        (value("after", "toxic") - value("before", "toxic")).alias("toxic_lost"),
        F.get("shares", F.col("own")).alias("shapley"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (
  SELECT w.part,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS failed,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE 0 END AS good,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS toxic
  FROM w),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
b AS (SELECT unnest(range(5)) AS k),
o AS (SELECT [p.k, q.k, r.k, s.k, t.k] AS ks, chr(65 + CAST(p.k AS INT)) || chr(65 + CAST(q.k AS INT)) || chr(65 + CAST(r.k AS INT))
             || chr(65 + CAST(s.k AS INT)) || chr(65 + CAST(t.k AS INT)) AS filter_order
      FROM b p, b q, b r, b s, b t WHERE len(list_distinct([p.k, q.k, r.k, s.k, t.k])) = 5),
st AS (SELECT filter_order, CAST(i AS INT) AS step, ks[i] AS k, list_sum(list_transform(ks[1:i - 1], lambda x: 1 << CAST(x AS INT))) AS prior
       FROM o, range(1, 6) AS r(i)),
x AS (
  SELECT part, filter_order, step, k,
    CAST(sum(n) FILTER (failed & (CAST(coalesce(prior, 0) AS INT) | (1 << CAST(k AS INT))) = 0) AS BIGINT) AS kept,
    CAST(sum(n) FILTER (failed & CAST(coalesce(prior, 0) AS INT) = 0 AND failed & (1 << CAST(k AS INT)) <> 0) AS BIGINT) AS removed,
    CAST(sum(n) FILTER (failed & CAST(coalesce(prior, 0) AS INT) <> 0 AND failed & (1 << CAST(k AS INT)) <> 0) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (failed = 1 << CAST(k AS INT)) AS BIGINT) AS unique_fails,
    CAST(sum(good) FILTER (failed & CAST(coalesce(prior, 0) AS INT) = 0 AND failed & (1 << CAST(k AS INT)) <> 0) AS BIGINT) AS good_lost,
    CAST(sum(toxic) FILTER (failed & CAST(coalesce(prior, 0) AS INT) = 0 AND failed & (1 << CAST(k AS INT)) <> 0) AS BIGINT) AS toxic_lost
  FROM c, st GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
  coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM x
"""
