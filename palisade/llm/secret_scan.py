"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean trigram query: an OR of sets of trigrams, each set demanded together.
Postings (trigram, document row) are stored for the trigrams that the queries ask for; a document is a candidate of a rule when
the postings of all trigrams of one of the sets meet there. Only candidates are verified with the expression. A rule in which
no trigram is mandatory scans everything. Everything runs in DataFrame functions; spans are counted in code points.

Defined cases: null and empty texts have no spans; repeated rows give repeated result rows; matches of one rule are leftmost and
don't overlap; spans of different rules may; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import lower_ascii, row_key, small_side
from palisade.session import written

# Fixed values. Base rules: kind, expression, group whose length counts (0: the match), least length.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
# More kinds of secrets.
MORE = [
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("cloud_key", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
]

# A part of an expression that can say more different strings than this counts as unknown.
MOST_STRINGS = 32
KEY_ROWS = 1_000_000


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int
    least: int
    place: int

    @property
    def sets(self) -> list[frozenset[str]]:
        return trigram_query(self.pattern)

    @property
    def quick(self) -> str:
        """An expression that every kept match satisfies; for a single run of characters the length can be asked at once."""
        return re_run(self.pattern, self.least) if self.group == 0 else self.pattern


def re_run(pattern: str, least: int) -> str:
    tree = parser.parse(pattern)
    if len(tree) == 1 and tree[0][0] is kinds.MAX_REPEAT and pattern.endswith("]+"):
        return f"{pattern[:-1]}{{{least}}}"
    return pattern


def _joined(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a, b in product(left, right)} if len(left) * len(right) <= MOST_STRINGS else None


def _strings(node: tuple) -> set[str] | None:
    """All strings that a part can match, in lower case, or None if there are too many."""
    op, value = node
    if op is kinds.LITERAL:
        return {chr(value).lower()}
    if op is kinds.IN and value and value[0][0] is not kinds.NEGATE:
        found: set[str] = set()
        for kind, item in value:
            if kind is kinds.LITERAL:
                found.add(chr(item).lower())
            elif kind is kinds.RANGE and item[1] - item[0] < MOST_STRINGS:
                found |= {chr(c).lower() for c in range(item[0], item[1] + 1)}
            else:
                return None
        return found if len(found) <= MOST_STRINGS else None
    if op is kinds.SUBPATTERN:
        return _sequence(value[-1])
    if op is kinds.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[1] <= 4:
        once = _sequence(value[2])
        if once is None:
            return None
        found, run = (set() if value[0] else {""}), {""}
        for n in range(1, value[1] + 1):
            run = _joined(run, once)
            if run is None:
                return None
            if n >= value[0]:
                found |= run
        return found if len(found) <= MOST_STRINGS else None
    return None


def _sequence(nodes) -> set[str] | None:
    found: set[str] | None = {""}
    for node in nodes:
        own = _strings(node)
        found = None if own is None else _joined(found, own)
        if found is None:
            return None
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The sets of lower-case trigrams of which one must be there in full; empty if nothing is mandatory.

    The expression's top level is cut into stretches of known strings. The stretch whose poorest string has the most trigrams
    decides: each of its strings is one set. A string without a trigram makes the stretch useless.
    """
    stretches: list[set[str]] = []
    run: set[str] = {""}
    for node in parser.parse(pattern):
        own = _strings(node)
        longer = None if own is None else _joined(run, own)
        if longer is None:
            stretches.append(run)
            run = own if own is not None else {""}
        else:
            run = longer
    stretches.append(run)
    queries = [[frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in sorted(stretch)] for stretch in stretches]
    usable = [q for q in queries if all(q)]
    return max(usable, key=lambda q: min(len(s) for s in q), default=[])


def rules(more: bool = True) -> list[Rule]:
    return [Rule(*r, place) for place, r in enumerate(BASE + (MORE if more else []))]


def build_index(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """The stored postings (trigram, key) of the given lower-case trigrams, written to the shared folder."""
    low = rows.select("key", lower_ascii(F.col("text")).alias("low"))
    present = F.filter(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    return written(low.where("low is not null").select("key", F.explode(present).alias("trigram")), "trigrams")


def candidates(index: DataFrame, wanted: list[Rule]) -> DataFrame:
    """(key, kinds): rows where the postings of one of a rule's sets meet."""
    sets = [(rule.kind, n, t, len(s)) for rule in wanted for n, s in enumerate(rule.sets) for t in sorted(s)]
    # As large as the rules, whatever the data: a proven size.
    asked = F.broadcast(index.sparkSession.createDataFrame(sets, "kind string, nth int, trigram string, size int"))
    met = index.join(asked, "trigram").groupBy("key", "kind", "nth", "size").agg(F.countDistinct("trigram").alias("n"))
    return met.where("n = size").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<start, place, end>> of a rule's kept matches, from the pieces between the matches."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    lengths = F.zip_with(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(
        F.char_length(g).alias("gap"), F.char_length(m).alias("n"))), counted, lambda p, c: F.struct(
            p["gap"].alias("gap"), p["n"].alias("n"), F.char_length(c).alias("counted")))
    empty = F.array().cast("array<struct<start:int,place:int,end:int>>")
    walked = F.aggregate(
        lengths, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["n"]).alias("at"),
            F.when(m["counted"] >= rule.least, F.concat(s["spans"], F.array(F.struct(
                (s["at"] + m["gap"]).alias("start"), F.lit(rule.place).alias("place"), (s["at"] + m["gap"] + m["n"]).alias("end")))))
            .otherwise(s["spans"]).alias("spans")))
    return F.when(text.rlike(rule.quick), walked["spans"]).otherwise(empty)


def secrets(docs: DataFrame, more: bool = True) -> DataFrame:
    """Per document row: key, doc_id, spans (array<struct<start, place, end>>, ordered); place is the rule's number."""
    every = rules(more)
    rows = docs.select(row_key(F.col("text"), F.col("doc_id")).alias("key"), "doc_id", "text")
    indexed = [r for r in every if r.sets]
    index = build_index(rows, sorted(set().union(*[s for r in indexed for s in r.sets])))
    chosen = written(candidates(index, indexed), "candidates")
    hits = rows.join(small_side(chosen, KEY_ROWS), "key")
    empty = F.array().cast("array<struct<start:int,place:int,end:int>>")
    verified = hits.select("key", F.concat(*[
        F.when(F.array_contains("kinds", r.kind), spans_of(F.col("text"), r)).otherwise(empty) for r in indexed]).alias("found"))
    verified = verified.where(F.size("found") > 0).groupBy("key").agg(F.first("found").alias("found"))
    open_rules = [r for r in every if not r.sets]
    scanned = F.concat(empty, *[spans_of(F.col("text"), r) for r in open_rules])
    all_rows = rows.select("key", "doc_id", F.coalesce(scanned, empty).alias("scanned"))
    return all_rows.join(verified, "key", "left").select(
        "key", "doc_id", F.array_sort(F.concat("scanned", F.coalesce("found", empty))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's counts and texts of spans."""
    every = rules()
    names = F.array(*[F.lit(r.kind) for r in every])
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["place"] + 1), s["start"], s["end"])))
    n = lambda place: F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def oracle_sql() -> str:
    """The contract in SQL. Places follow from the pieces between matches; runs of one class are asked for with their length."""
    parts = []
    for r in rules():
        pattern = {"hex": "[0-9a-f]{24,}", "access": "AKIA[A-Z0-9]{16,}"}.get(r.kind, r.pattern).replace("'", "''")
        parts.append(f"""SELECT doc_id, {r.place} AS place, '{r.kind}' AS kind, {r.least} AS least, f, string_split_regex(text, '{pattern}') AS g,
      regexp_extract_all(text, '{pattern}', {r.group}) AS c
    FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS f FROM documents) WHERE len(f) > 0""")
    found = " UNION ALL ".join(parts)
    return f"""
WITH found AS ({found}),
each AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM found),
placed AS (
  SELECT doc_id, place, kind, length(f[i]) AS n, length(c[i]) AS counted, least,
    list_sum(list_transform(g[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1 : i - 1], lambda x: length(x))), 0) AS s
  FROM each),
span AS (SELECT doc_id, place, s, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS said FROM placed WHERE counted >= least),
own AS (
  SELECT doc_id, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS k, count(*) FILTER (place = 2) AS h,
    string_agg(said, ',' ORDER BY s, place) FILTER (place < {len(BASE)}) AS base, string_agg(said, ',' ORDER BY s, place) AS spans
  FROM span GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM documents d LEFT JOIN own ON d.doc_id = own.doc_id
"""
