"""Host names, scanner names, CVE ids, stable keys and other text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions.nulls import blank_to_null


def normalize_hostname(name: Column) -> Column:
    return blank_to_null(F.regexp_replace(F.lower(F.trim(name)), r"\.+$", ""))


def short_hostname(name: Column) -> Column:
    return F.substring_index(normalize_hostname(name), ".", 1)


def hostname_matches(names: list[Column], requested: str) -> Column:
    """A dotted request needs equality with one of the names, a short one equals a first label."""
    target = requested.strip().lower().rstrip(".")
    known = F.array_compact(F.array(*[normalize_hostname(name) for name in names]))
    if "." in target:
        return F.array_contains(known, target)
    return F.exists(known, lambda name: F.substring_index(name, ".", 1) == target)


def normalize_cve(text: Column) -> Column:
    candidate = F.upper(F.trim(text))
    return F.when(candidate.rlike(fixed.CVE_FULL), candidate)


def normalize_scanner(text: Column) -> Column:
    """Known spellings to one product name, otherwise the trimmed text, otherwise UNKNOWN."""
    candidate = F.trim(F.coalesce(text, F.lit("")))
    compact = F.regexp_replace(F.lower(candidate), "[^a-z0-9]", "")
    pairs = [F.lit(part) for pair in fixed.SCANNER_NAMES.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), compact), blank_to_null(candidate), F.lit("UNKNOWN"))


def cve_words(text: Column) -> Column:
    """All CVE ids in a text, upper-cased, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.upper(text), F.lit(fixed.CVE_WORD), F.lit(0))))


def split_cves(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), r"[,;\s]+")
    return F.filter(words, lambda word: word.rlike("(?i)^CVE-"))


def stable_key(text: Column) -> Column:
    return F.substring(F.sha2(F.lower(F.trim(F.coalesce(text, F.lit("")))), 256), 1, 24)


def composite_key(*texts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(t, F.lit("")) for t in texts]), 256), 1, 24)


def short_digest(*parts: Column, size: int = 16) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, size)


def distinct_trimmed(texts: Column) -> Column:
    """Trimmed non-empty texts in order of first appearance."""
    return F.array_distinct(F.filter(F.transform(texts, lambda t: F.trim(t)), lambda t: t != ""))


def shorten(text: Column, size: int, tail: str = "...", keep: int | None = None) -> Column:
    """Text longer than ``size`` is cut to ``keep`` characters (``size`` by default) plus a tail."""
    cut = F.concat(F.left(text, F.lit(size if keep is None else keep)), F.lit(tail))
    return F.when(F.length(text) > size, cut).otherwise(text)


def history_url(app_url: str, namespace: str, asset_id: Column, finding_id: Column) -> Column:
    """Null when either id is missing."""
    return F.concat(
        F.lit(f"{app_url.rstrip('/')}/{namespace}/assets/live-report/"), blank_to_null(asset_id),
        F.lit("/vuln-management/findings/finding/"), blank_to_null(finding_id), F.lit("/history"),
    )


def cvss_vector(metrics: dict[str, Column], version: str = "3.1") -> Column:
    """The vector text, only when all eight base metrics are there."""
    parts = [F.concat(F.lit(f"{name}:"), blank_to_null(metrics[name])) for name in metrics]
    complete = F.lit(True)
    for part in parts:
        complete = complete & part.isNotNull()
    return F.when(complete, F.concat(F.lit(f"CVSS:{version}/"), F.concat_ws("/", *parts)))


def readable_size(size: Column) -> Column:
    """Bytes as o, Ko, Mo, Go or To; one decimal below ten units, none for plain bytes."""
    text = None
    for power, unit in enumerate(("o", "Ko", "Mo", "Go", "To")):
        value = size / (1024**power)
        shown = F.format_string(f"%.0f {unit}", F.round(value, 0))
        if power:
            shown = F.when(value < 10, F.format_string(f"%.1f {unit}", F.round(value, 1))).otherwise(shown)
        last = unit == "To"
        fits = F.lit(True) if last else size < 1024 ** (power + 1)
        text = F.when(fits, shown) if text is None else text.when(fits, shown)
    return text


def http_error_type(status: Column) -> Column:
    pairs = [F.lit(part) for pair in fixed.HTTP_ERROR_TYPES.items() for part in pair]
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), status.cast("int")),
        F.when(F.coalesce(status, F.lit(0)) != 0, "http_error").otherwise("network_error"),
    )


def event_type(trigger: Column, status: Column) -> Column:
    """Ordered word rules over trigger and status; the asset rule also needs the word ASSET."""
    text = F.upper(F.concat_ws(" ", F.coalesce(trigger, F.lit("")), F.coalesce(status, F.lit(""))))
    outcome = None
    for name, words in fixed.EVENT_RULES:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        if name == "ASSET_INDICATORS_CHANGED":
            hit = hit & text.contains("ASSET")
        outcome = F.when(hit, name) if outcome is None else outcome.when(hit, name)
    return outcome.otherwise("UNKNOWN")


def safe_cell(text: Column) -> Column:
    """Text that a spreadsheet will not read as a formula, cut to the cell limit."""
    guarded = F.when(text.rlike(fixed.FORMULA_STARTS), F.concat(F.lit("'"), text)).otherwise(text)
    return F.left(guarded, F.lit(fixed.MAX_CELL_TEXT))


def redact_map(entries: Column) -> Column:
    return F.transform_values(
        entries,
        lambda key, value: F.when(F.lower(key).isin(*fixed.SENSITIVE_KEYS), fixed.MASK).otherwise(value),
    )


def internet_facing(tags: Column) -> Column:
    """True when any tag key names an external or public address."""
    pattern = "|".join(fixed.INTERNET_MARKERS)
    return F.coalesce(F.exists(F.map_keys(tags), lambda key: F.upper(key).rlike(pattern)), F.lit(False))


def any_text_contains(columns: list[Column], needle: str) -> Column:
    """Free-text search over every column, case-insensitive; an empty needle matches everything."""
    hit = F.lit(needle.strip() == "")
    for column in columns:
        hit = hit | F.coalesce(F.lower(column.cast("string")).contains(needle.strip().lower()), F.lit(False))
    return hit
