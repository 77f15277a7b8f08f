"""JSON text in and out: canonical output, dotted-path reads, lists from JSON or scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.functions.nulls import blank_to_null, first_present


def canonical(**fields: Column) -> Column:
    """Compact JSON text with keys in alphabetical order and nulls kept."""
    return F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]), {"ignoreNullFields": "false"})


def at(doc: Column, path: str, kind: str = "string") -> Column:
    """The value at a dotted path of a VARIANT; null when a step is missing or is not an object.

    An object or array read as a string gives its compact, key-sorted JSON text.
    """
    return F.try_variant_get(doc, "$." + path if path else "$", kind)


def first_at(doc: Column, *paths: str) -> Column:
    """First non-null, non-empty value among dotted paths, as text."""
    return first_present(*[at(doc, path) for path in paths])


def at_once(doc: Column, *paths: str, **kinds: str) -> Column:
    """The texts at many dotted paths of a VARIANT as one nested struct: each object on the way is gone through once.

    Every field says what ``at`` says of its path. ``kinds`` gives other types, with ``__`` for the dots; no path may begin another.
    """
    tree: dict = {}
    for path, kind in [(path, "string") for path in paths] + [(name.replace("__", "."), kind) for name, kind in kinds.items()]:
        *steps, last = path.split(".")
        level = tree
        for step in steps:
            level = level.setdefault(step, {})
        level[last] = kind

    def shape(level: dict) -> str:
        fields = (f"`{name}`: {shape(kind) if isinstance(kind, dict) else kind}" for name, kind in level.items())
        return f"struct<{', '.join(fields)}>"

    return F.try_variant_get(doc, "$", shape(tree))


def part(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, "$." + path, "variant")


def kind_of(doc: Column) -> Column:
    """object, array, string, number, boolean or null."""
    shape = F.schema_of_variant(doc)
    return (
        F.when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "VOID", "null")
        .when(shape.isNotNull(), "number")
    )


def is_object(doc: Column) -> Column:
    """Only an object reads as a struct; this opens one level, copies none of its values and does not describe the whole."""
    return F.try_variant_get(doc, "$", "struct<`_`: boolean>").isNotNull()


def is_nested(doc: Column) -> Column:
    """An object or an array."""
    return is_object(doc) | F.try_variant_get(doc, "$", "array<variant>").isNotNull()


def is_json(text: Column) -> Column:
    """True only when the whole text is one JSON value.

    The parser stops after the first value, so the text is parsed once inside a list and once inside an object:
    anything that follows the value breaks one of the two or makes the list longer.
    """
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    inside = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce((F.size(listed) == 1) & inside.isNotNull(), F.lit(False))


def strict_parse(text: Column) -> Column:
    return F.when(is_json(text), F.try_parse_json(text))


def opened_in_place(nodes: Column) -> Column:
    """The nodes of a list of structs (path, shape, parent, key, v, open), opened by one level: the children of each open one."""
    def node(path: Column, shape: Column, parent: Column, key: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), shape.alias("shape"), parent.alias("parent"), key.alias("key"), value.alias("v"),
                        F.coalesce(is_nested(value), F.lit(False)).alias("open"))

    def below(x: Column) -> Column:
        fields, listed = F.try_variant_get(x["v"], "$", "map<string,variant>"), F.try_variant_get(x["v"], "$", "array<variant>")
        of_object = F.transform(F.map_entries(fields), lambda e: node(
            F.concat(x["path"], F.lit("."), e["key"]), F.concat(x["shape"], F.lit("."), e["key"]), x["path"], e["key"], e["value"]))
        of_list = F.transform(listed, lambda value, place: node(
            F.concat(x["path"], F.lit("["), place.cast("string"), F.lit("]")), F.concat(x["shape"], F.lit("[]")), x["path"],
            F.lit(None).cast("string"), value))
        children = F.coalesce(of_object, of_list)
        return F.when(x["open"] & (F.size(children) > 0), children).otherwise(F.array(x))

    return F.flatten(F.transform(nodes, below))


def items(doc: Column, path: str) -> Column:
    """The elements of an array at a dotted path as ARRAY<VARIANT>; null for anything that is not an array."""
    return F.try_variant_get(doc, "$." + path, "array<variant>")


PLAIN_LIST = r'^\["[^"\\\x00-\x1f]*+"(?:,"[^"\\\x00-\x1f]*+")*+\]\z'


def text_list(text: Column) -> Column:
    """A JSON array gives its items, other valid JSON one item, anything else the text itself, nothing an empty list."""
    doc = strict_parse(text)
    nothing = F.array().cast("array<string>")
    whole = F.try_variant_get(doc, "$", "array<string>")
    single = F.when(doc.isNotNull(), F.array(F.try_variant_get(doc, "$", "string"))).otherwise(F.array(text))
    # Short lists of texts without escapes are cut at their quotes, which says the same without a parser.
    plain = (F.length(text) < 500) & text.rlike(PLAIN_LIST)
    return (F.when(blank_to_null(text).isNull() | (text == "[]"), nothing)
            .when(plain, F.split(F.substr(text, F.lit(3), F.length(text) - 4), '","'))
            .otherwise(F.coalesce(whole, single)))


def names_of(doc: Column) -> Column:
    """Flatten to names: keys of an object; for a list, name/value/id/key of objects and plain items; else the scalar."""
    listed = F.try_variant_get(doc, "$", "array<variant>")
    from_list = F.filter(
        F.transform(
            listed,
            lambda item: F.when(
                is_object(item),
                first_present(*[F.try_variant_get(item, f"$.{key}", "string") for key in ("name", "value", "id", "key")]),
            ).otherwise(F.try_variant_get(item, "$", "string")),
        ),
        lambda name: name.isNotNull(),
    )
    scalar = F.try_variant_get(doc, "$", "string")
    return (
        F.when(is_object(doc), F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>")))
        .when(listed.isNotNull(), from_list)
        .when(scalar.isNotNull(), F.array(scalar))
        .otherwise(F.array().cast("array<string>"))
    )
