"""Reading paths, versions, ids and component labels out of scanner text with built-in regex functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions.nulls import blank_to_null
from palisade.functions.text import distinct_trimmed


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group))


def registry_paths(text: Column) -> Column:
    return distinct_trimmed(_all(text, fixed.REGISTRY_PATH))


def file_paths(text: Column) -> Column:
    return distinct_trimmed(F.concat(_all(text, fixed.WINDOWS_FILE), _all(text, fixed.LINUX_FILE)))


def detected_versions(text: Column) -> Column:
    return distinct_trimmed(_all(text, fixed.DETECTED_VERSION))


def expected_versions(text: Column, provider: Column | None = None) -> Column:
    """The preferred scanner writes the reference version as ``LastProduct = x`` as well."""
    general = _all(text, fixed.EXPECTED_VERSION)
    if provider is None:
        return distinct_trimmed(general)
    extra = _all(text, fixed.LAST_PRODUCT_VERSION)
    return distinct_trimmed(
        F.when(provider == fixed.PREFERRED_PROVIDER, F.concat(general, extra)).otherwise(general)
    )


def qid(text: Column) -> Column:
    return blank_to_null(F.regexp_extract(F.coalesce(text, F.lit("")), fixed.QID_TEXT, 1))


def quoted_component(text: Column, provider: Column) -> Column:
    title = blank_to_null(F.regexp_extract(F.coalesce(text, F.lit("")), fixed.QUOTED_TITLE, 1))
    return F.when(provider == fixed.PREFERRED_PROVIDER, title)


def labelled_component(text: Column) -> Column:
    """Struct of the labelled fields, null when no field is found at all."""
    found = {
        name: blank_to_null(F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1)))
        for name, pattern in fixed.LABEL_PATTERNS.items()
    }
    title = blank_to_null(F.regexp_extract(F.coalesce(text, F.lit("")), fixed.TITLE_PACKAGE, 1))
    found["package"] = F.coalesce(found["package"], title)
    anything = F.coalesce(*found.values()).isNotNull()
    return F.when(anything, F.struct(*[value.alias(name) for name, value in found.items()]))


def version_pairs(detected: Column, expected: Column) -> Column:
    """Detected and expected versions side by side; the shorter list is padded with null."""
    return F.arrays_zip(detected.alias("detectedVersion"), expected.alias("expectedVersion"))


def has_secret(text: Column, markers: tuple[str, ...] = fixed.SECRET_MARKERS) -> Column:
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.coalesce(F.lower(text).contains(marker), F.lit(False))
    return hit
