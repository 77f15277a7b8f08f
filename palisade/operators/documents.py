"""Nested JSON documents as rows.

Two walks are offered. ``leaves`` and ``fields`` stay in the JVM: each pass of VARIANT explode opens one more level while
finished rows pass through, so one scan without a shuffle reaches everything at any depth. VARIANT keeps object keys
sorted, so where the order in which a document was written decides the result (first text, last duplicate)
``with_walk`` reads the text once per document in Arrow batches and keeps the written order.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from palisade import fixed_values as fixed
from palisade.functions.json_text import is_json, is_nested, kind_of, opened_in_place
from palisade.session import written



STRING_OR_REST = '"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"|[^\\[\\]{}"]++'


def depth_of(text: Column) -> Column:
    """How deep objects and lists are nested in a JSON text: what its brackets alone say.

    Taking out the innermost pairs makes every branch one level flatter, so there are as many rounds as levels; those of the
    rest find nothing.
    """
    brackets = F.translate(F.regexp_replace(text, STRING_OR_REST, ""), "[]", "{}")
    return F.transform(F.array(brackets), lambda b: F.aggregate(
        F.sequence(F.lit(0), F.floor(F.length(b) / 2).cast("int")), F.struct(b.alias("rest"), F.lit(0).alias("taken")),
        lambda s, _: F.when(s["rest"] == "", s).otherwise(F.struct(
            F.replace(s["rest"], F.lit("{}"), F.lit("")).alias("rest"), (s["taken"] + 1).alias("taken"))))["taken"])[0]


def levels(df: DataFrame, doc: Column, text: Column | None = None) -> int:
    """How deep the deepest VARIANT of a table is nested: one number.

    Where the JSON text that ``doc`` was parsed from is at hand (``text``), its brackets are read and nothing is parsed; a text
    that is no JSON may then raise the number, but only up to what is usual, as deeper tables are asked again by ``doc``.
    """
    found = df.agg(F.max(depth_of(F.to_json(doc) if text is None else text))).first()[0]
    return levels(df, doc) if text is not None and (found or 0) > ROUNDS else int(found or 0)


def _opened(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Every row's value opened by one level; a leaf stays as it is."""
    opened = rows.sparkSession.tvf.variant_explode_outer(F.col("_v").outer()).toDF("_pos", "_key", "_child")
    step, is_open = F.col("_key"), F.col("_pos").isNotNull()
    return rows.lateralJoin(opened).select(
        *keep,
        F.coalesce("_child", "_v").alias("_v"),
        F.when(~is_open, F.col("path")).when(step.isNotNull(), F.concat("path", F.lit("."), step))
        .otherwise(F.concat("path", F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).alias("path"),
        F.when(~is_open, F.col("shape")).when(step.isNotNull(), F.concat("shape", F.lit("."), step))
        .otherwise(F.concat("shape", F.lit("[]"))).alias("shape"),
        F.when(is_open, F.col("path")).otherwise(F.col("parent")).alias("parent"),
        F.when(is_open, step).otherwise(F.col("key")).alias("key"),
    )


# Rounds of one plan; a deeper table goes on from a written one, as the planner's own recursion has its limits.
ROUNDS = 40
# Rounds where nobody has asked for the depth; what lies deeper is opened in its row.
UNASKED = 14


def _rest_opened(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The leaves of what the rounds have left open, however deep: each row opens its own rest, a leaf is looked at only."""
    here = F.struct("path", "shape", "parent", "key", F.col("_v").alias("v"), F.lit(True).alias("open"))
    rest = F.aggregate(F.sequence(F.lit(1), depth_of(F.to_json("_v"))), F.array(here), lambda nodes, _: opened_in_place(nodes))
    leaves_ = F.when(is_nested(F.col("_v")), rest).otherwise(F.array(here))
    return rows.select(*keep, F.explode(leaves_).alias("_x")).select(
        *keep, F.col("_x.v").alias("_v"), *[F.col(f"_x.{name}").alias(name) for name in ("path", "shape", "parent", "key")])


def _cut(rows: DataFrame, done: int) -> DataFrame:
    return written(rows, "walk") if done and done % ROUNDS == 0 else rows


def _start(df: DataFrame, doc: Column, keep: list[str], root: str) -> DataFrame:
    return df.select(
        *keep, doc.alias("_v"), F.lit(root).alias("path"), F.lit(root).alias("shape"),
        F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("key"),
    )


def leaves(df: DataFrame, doc: Column, keep: list[str], root: str = "data", depth: int | None = None,
           text: Column | None = None) -> DataFrame:
    """Every leaf of a VARIANT at any depth: path, shape (array steps as ``[]``), parent, key, kind and text value.

    Empty containers count as leaves. There are as many rounds as the deepest document has levels, which one pass over the
    brackets tells beforehand (``levels``); give ``depth`` where it is known, or where a stream can't be asked. What lies deeper
    than a given depth fails the job rather than getting lost. Where the documents were parsed from ``text``, which took work to
    make, they are gone through only once: some rounds open what is usual, and each row then opens its own rest.
    """
    rows = _start(df, doc, keep, root)
    unasked = depth is None and text is not None
    for done in range(UNASKED if unasked else levels(df, doc) if depth is None else depth):
        rows = _opened(_cut(rows, done), keep)
    if unasked:
        rows = _rest_opened(rows, keep)
    value = F.try_variant_get("_v", "$", "string")
    too_deep = F.col("kind").isin("object", "array") & ~value.isin("{}", "[]")
    return rows.withColumn("kind", kind_of(F.col("_v"))).select(
        *keep, "path", "shape", "parent", "key", "kind",
        F.when(too_deep, F.raise_error(F.lit("a document is nested deeper than the given depth")).cast("string"))
        .otherwise(value).alias("value"),
    )


def fields(df: DataFrame, doc: Column, keep: list[str], root: str = "data", depth: int | None = None,
           text: Column | None = None) -> DataFrame:
    """Every value of a VARIANT at any depth, nested ones too: path, shape, parent, key and the value ``v``.

    A round hands out the nodes it opens and goes on with what lies below them, so the table is read once: a row is a node, done
    or still open.
    """
    rows = _start(df, doc, keep, root).withColumn("_done", F.lit(False))
    carried = [*keep, "path", "shape", "parent", "key", "_v"]
    for done in range(levels(df, doc, text) if depth is None else depth):
        rows = _cut(rows, done)
        # An open nested value gives itself, done, and a copy that is opened next.
        twice = F.when(F.col("_done") | ~is_nested(F.col("_v")), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))
        split = rows.select(*carried, F.explode(twice).alias("_done"))
        child = F.when(~F.col("_done"), F.col("_v"))
        opened = split.sparkSession.tvf.variant_explode_outer(child.outer()).toDF("_pos", "_key", "_child")
        below, step = ~F.col("_done"), F.col("_key")
        named = F.when(step.isNotNull(), F.concat(F.lit("."), step))
        rows = split.lateralJoin(opened).where(F.col("_done") | F.col("_pos").isNotNull()).select(
            *keep,
            F.when(below, F.concat("path", F.coalesce(named, F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")))))
            .otherwise(F.col("path")).alias("path"),
            F.when(below, F.concat("shape", F.coalesce(named, F.lit("[]")))).otherwise(F.col("shape")).alias("shape"),
            F.when(below, F.col("path")).otherwise(F.col("parent")).alias("parent"),
            F.when(below, step).otherwise(F.col("key")).alias("key"),
            F.when(below, F.col("_child")).otherwise(F.col("_v")).alias("_v"), "_done")
    return rows.select(*keep, "path", "shape", "parent", "key", F.col("_v").alias("v"))


def _steps(value, path: str = ""):
    """Every value below ``value`` with its path and key, in written order, at any depth."""
    def inner(path, value):
        if isinstance(value, dict):
            return ((f"{path}.{name}", name, child) for name, child in value.items())
        return ((f"{path}[{place}]", None, child) for place, child in enumerate(value)) if isinstance(value, list) else iter(())

    open_ = [inner(path, value)]
    while open_:
        step = next(open_[-1], None)
        if step is None:
            open_.pop()
            continue
        yield step
        if isinstance(step[2], (dict, list)):
            open_.append(inner(step[0], step[2]))


def _depth(value) -> int:
    """How deep objects and lists are nested."""
    deepest, level = 0, [value]
    while level := [v for v in level if isinstance(v, (dict, list))]:
        deepest += 1
        level = [child for v in level for child in (v.values() if isinstance(v, dict) else v)]
    return deepest


def _below_text(name: str) -> bool:
    return name == "text" or (".text" in name or name.startswith("text")) and bool(BELOW_TEXT.search("." + name))


def _texts(value) -> list[str]:
    """The trimmed own text of every object, objects in document order; what hangs below a text is no object of its own."""
    found, open_ = [], [value]
    while open_:
        node = open_.pop()
        if isinstance(node, dict):
            own = node.get("text")
            if isinstance(own, str) and (own := own.strip()):
                found.append(own)
            below = [child for name, child in node.items() if isinstance(child, (dict, list)) and not _below_text(name)]
        else:
            below = [child for child in node if isinstance(child, (dict, list))] if isinstance(node, list) else []
        open_ += reversed(below)
    return found


def _objects(value, path: str):
    """Every object in and below ``value`` with its path, in written order, at any depth."""
    open_ = [(path, value)]
    while open_:
        path, node = open_.pop()
        if isinstance(node, dict):
            yield path, node
            below = [(f"{path}.{name}", child) for name, child in node.items() if isinstance(child, (dict, list))]
        elif isinstance(node, list):
            below = [(f"{path}[{place}]", child) for place, child in enumerate(node) if isinstance(child, (dict, list))]
        else:
            continue
        open_ += reversed(below)


def _named(value, path: str, wanted):
    """(name, value, path) of every field below ``value`` whose name is ``wanted``, in written order, at any depth."""
    open_ = [("", path, value)]
    while open_:
        name, path, node = open_.pop()
        if name and wanted(name):
            yield name, node, path
        if isinstance(node, dict):
            below = [(name, f"{path}.{name}", child) for name, child in node.items() if isinstance(child, (dict, list)) or wanted(name)]
        elif isinstance(node, list):
            below = [("", f"{path}[{place}]", child) for place, child in enumerate(node) if isinstance(child, (dict, list))]
        else:
            continue
        open_ += reversed(below)


@functools.lru_cache(4096)
def _is_reference(name: str) -> bool:
    return name.lower().replace("-", "").replace("_", "") in fixed.REFERENCE_KINDS


def _plain(value) -> str:
    return _canonical(value) if isinstance(value, (dict, list)) else str(value)


_canonical = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode
_spaced = json.JSONEncoder(ensure_ascii=False, sort_keys=True, default=str).encode


# What a walk can gather, beside whether the document is valid and which scanner wrote each entry.
PARTS = ("hash", "texts", "ids", "sources", "raw")


def _sources(info: dict, notes) -> list[dict]:
    """Objects with known fields, and labelled texts."""
    sources = []
    for block in fixed.COMPONENT_KEYS:
        for path, value in _objects(info.get(block), block):
            known = [(name, _plain(value[name])) for name in value if name in SPELLINGS and value[name] not in (None, "")]
            if known:
                sources.append({"path": path, "fields": known, "text": None})
    written = [text for _, text, _ in _named(notes, "", "text".__eq__) if isinstance(text, str)]
    return sources + [{"path": f"i18n[{i}]", "fields": None, "text": text} for i, text in enumerate(written)]


def _entry(index: int, info: dict, parts: tuple[str, ...] = PARTS) -> dict:
    """What one scanner entry says, still unjudged: its texts, native ids and objects with known fields."""
    shared = info.get("sharedDetailsLocal")
    notes = shared.get("i18n") if isinstance(shared, dict) else None
    entry = {"index": index, "provider": None if info.get("providerId") is None else str(info["providerId"])}
    if "texts" in parts:
        entry["texts"] = list(dict.fromkeys(_texts(notes)))
    if "ids" in parts:
        entry["ids"] = [
            {"key": name, "value": str(value), "path": path}
            for name, value, path in _named(info.get("extendedAttributesList"), "extendedAttributesList", _is_reference)
            if value not in (None, "") and not isinstance(value, (dict, list))
        ]
    if "sources" in parts:
        entry["sources"] = _sources(info, notes)
    if "raw" in parts:
        entry["raw"] = _canonical(info)
    return entry


# VARIANT reads no deeper nesting.
DEPTH = 1000
BELOW_TEXT = re.compile(r"\.text(?=[.\[]|$)")
CVE_WORD = re.compile(fixed.CVE_WORD.replace("(?U)", "(?i)"))
SPELLINGS = frozenset(name for names in fixed.FIELD_SPELLINGS.values() for name in names)
_TEXT, _TEXTS = pa.string(), pa.list_(pa.string())
# A half of a surrogate pair that stands alone, behind whole pairs and other escapes.
ESCAPE = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|(\\u[dD][89a-fA-F][0-9a-fA-F]{2})|\\.", re.S)
HALF = re.compile(r"\\u[dD][89a-fA-F]")
WALKED = pa.struct([
    ("valid", pa.bool_()),
    ("reject", _TEXT),
    ("mended", _TEXT),
    ("hash", _TEXT),
    ("texts", _TEXTS),
    ("entries", pa.list_(pa.struct([
        ("index", pa.int32()), ("provider", _TEXT), ("texts", _TEXTS),
        ("ids", pa.list_(pa.struct([("key", _TEXT), ("value", _TEXT), ("path", _TEXT)]))),
        ("sources", pa.list_(pa.struct([("path", _TEXT), ("fields", pa.map_(_TEXT, _TEXT)), ("text", _TEXT)]))),
        ("raw", _TEXT),
    ]))),
])


def _mended(text: str) -> str:
    """``text`` with U+FFFD for every escape that is a lone half of a surrogate pair, which no table can hold."""
    return ESCAPE.sub(lambda m: "\\ufffd" if m[1] else m[0], text) if HALF.search(text) else text


def _rejected(reason: str) -> dict:
    return {"valid": False, "reject": reason}


def _walk(text: str | None, parts: tuple[str, ...] = PARTS) -> dict:
    try:
        mended = _mended(text)
        document = json.loads(mended)
        body = _spaced(document) if "hash" in parts else None
        # As deep as there are brackets at most.
        if mended.count("{") + mended.count("[") > DEPTH and _depth(document) > DEPTH:
            return _rejected("too deep")
    except (TypeError, ValueError):
        return _rejected("no JSON")
    except RecursionError:
        return _rejected("too deep")
    whole = isinstance(document, dict) and isinstance(document.get("data"), dict) and bool(document.get("findingId"))
    data = document.get("data") if isinstance(document, dict) else None
    data = data if isinstance(data, dict) else {}
    related, shared = data.get("assessmentsRelated"), data.get("sharedDetailsLocal")
    infos = related.get("activeFindingProviderInfos") if isinstance(related, dict) else None
    return {
        "valid": whole,
        "reject": None if whole else "no finding",
        "mended": mended if mended != text else None,
        "hash": None if body is None else hashlib.sha256(body.encode("utf-8", "surrogatepass")).hexdigest(),
        "texts": list(dict.fromkeys(_texts(shared.get("i18n") if isinstance(shared, dict) else None))) if "texts" in parts else None,
        "entries": [
            _entry(i, info, parts) for i, info in enumerate(infos if isinstance(infos, list) else []) if isinstance(info, dict)
        ],
    }


@F.arrow_udf(T.StringType())
def smallest_cve(texts: pa.Array) -> pa.Array:
    """The smallest CVE id among the string values of a JSON text at any depth; keys are not searched."""
    def smallest(text: str | None) -> str | None:
        if text is None:
            return None
        found = {
            match.upper() for _, _, value in _steps([json.loads(text)]) if isinstance(value, str)
            for match in CVE_WORD.findall(value)
        }
        return min(found, default=None)

    return pa.array([smallest(text) for text in texts.to_pylist()], type=pa.string())


JSON_ESCAPE = r"\\(?:u[0-9A-Fa-f]{4}|.)"
VALUE_OR_KEY = '"([^"]*+)"(?!:)|"[^"]*+":'


def smallest_cve_of(raw: Column) -> Column:
    """:func:`smallest_cve` of compact JSON text, in the JVM where the text is ASCII.

    An escape stands for a quote, a backslash or a control character, none of which is part of a word, so it may be a blank; then
    quotes are the ends of texts only, and a text before a colon is a key.
    """
    ascii_only = F.octet_length(raw) == F.length(raw)
    named = F.lower(raw).contains("cve-")
    values = F.regexp_replace(F.regexp_replace(raw, JSON_ESCAPE, " "), VALUE_OR_KEY, " $1 ")
    found = F.array_min(F.regexp_extract_all(F.upper(values), F.lit(fixed.CVE_WORD), F.lit(0)))
    return F.when(ascii_only & named, found).otherwise(smallest_cve(F.when(~ascii_only & named, raw)))


def with_walk(df: DataFrame, text: str = "body", parts: tuple[str, ...] = PARTS) -> DataFrame:
    """Adds ``walked``: the parts of a detail document whose written order matters, null where they are not among ``parts``."""
    @F.arrow_udf(from_arrow_type(WALKED))
    def walk(texts: pa.Array) -> pa.Array:
        return pa.array([_walk(text, parts) for text in texts.to_pylist()], type=WALKED)

    # Marked so that the optimizer never evaluates it again inside a pushed-down filter.
    return df.withColumn("walked", walk.asNondeterministic()(F.col(text)))


def parsed(df: DataFrame, text: str = "body") -> DataFrame:
    """Adds ``doc``, the VARIANT of a JSON text."""
    return df.withColumn("doc", F.try_parse_json(text))


def valid_documents(df: DataFrame, text: str = "body", parts: tuple[str, ...] = PARTS) -> DataFrame:
    """The valid detail documents with ``walked`` and ``doc``; the strict check rides on the walk, the text is parsed once.

    What it leaves out is counted by :func:`rejected_documents`.
    """
    walked = with_walk(df, text, parts).where("walked.valid")
    return parsed(walked.withColumn(text, F.coalesce("walked.mended", text)), text).drop(text)


def rejected_documents(df: DataFrame, text: str = "body") -> DataFrame:
    """(reason, documents): the documents that :func:`valid_documents` leaves out: no JSON, no finding, or too deep for VARIANT."""
    return with_walk(df, text, ()).where("NOT walked.valid").groupBy(F.col("walked.reject").alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


def envelopes(df: DataFrame, text: str = "body") -> DataFrame:
    """Adds the parsed envelope and ``valid``: it parses, ``data`` is an object and ``findingId`` is truthy."""
    doc = F.try_parse_json(text)
    head = F.try_variant_get(doc, "$", "struct<findingId:string,data:map<string,variant>>")
    # One mention of the parsed text: a filter on ``valid`` is pushed down with its whole expression.
    valid = F.exists(
        F.array(head),
        lambda h: h["data"].isNotNull() & h["findingId"].isNotNull()
        & ~h["findingId"].isin("", "0", "false", "[]", "{}"),
    )
    return df.withColumn("doc", doc).withColumn("valid", is_json(F.col(text)) & F.coalesce(valid, F.lit(False)))
