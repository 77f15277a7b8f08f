"""The compact digest of an asset: its top findings, their components, paths and history lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions.dates import iso_utc
from palisade.functions.nulls import first_present, zero_if_null
from palisade.functions.text import shorten
from palisade.operators.skew import top_per_key


def top_findings(findings: DataFrame, limit: int = 5) -> DataFrame:
    """The highest ranked findings per asset and how many are left out, with shortened texts."""
    shown = max(1, limit)
    totals = findings.groupBy("assetId").agg(F.count(F.lit(1)).alias("_n"))
    best = top_per_key(findings, ["assetId"], [zero_if_null(F.col("trs")).desc(), F.col("findingId")], shown, "place")
    return best.join(totals, "assetId").withColumns({
        "omitted": F.greatest(F.lit(0).cast("bigint"), F.col("_n") - shown),
        "title": shorten(F.col("title"), 220), "recommendation": shorten(F.col("recommendation"), 320),
    }).drop("_n")


def component_fallback(components: Column, product: Column, detected: Column, target: Column) -> Column:
    """The known components of a finding, else one built from its product and versions, else none."""
    own = F.struct(product.alias("package"), product.alias("product"), detected.alias("installedVersion"),
                   target.alias("requiredVersion"))
    anything = first_present(product, detected, target).isNotNull()
    return F.when(F.size(components) > 0, components).when(anything, F.array(own)).otherwise(
        F.filter(F.array(own), lambda _: F.lit(False)))


def path_lists(leaves: DataFrame, keep: list[str]) -> DataFrame:
    """Install, vulnerable and registry paths of a document, from its leaves (path, key, value), distinct in path order.

    A path under a named list key belongs to that class; under ``paths`` an object's path is an install path and a
    plain text a vulnerable one.
    """
    def below(names: tuple[str, ...]) -> Column:
        return F.col("path").rlike(r"\.(" + "|".join(names) + r")(\[\d+\])?(\.[^.\[]+)*$")

    in_paths = F.col("path").rlike(r"\.paths\[\d+\]")
    kind = (
        F.when(below(fixed.PATH_CLASSES["install"]), "install")
        .when(below(fixed.PATH_CLASSES["vulnerable"]), "vulnerable")
        .when(below(fixed.PATH_CLASSES["registry"]), "registry")
        .when(in_paths & F.col("key").isin(*fixed.PATH_KEYS), "install")
        .when(in_paths & F.col("key").isNull(), "vulnerable"))
    rows = leaves.where(F.col("kind") == "string").where("value <> ''").withColumn("pathClass", kind).where("pathClass IS NOT NULL")
    return rows.groupBy(*keep, "pathClass", F.col("value").alias("foundPath")).agg(F.min("path").alias("firstAt"))


def history_lines(findings: DataFrame, observations: DataFrame, rows: int = 20, lines: int = 12) -> DataFrame:
    """At most twelve lines per finding from the dated ones of its first twenty observations, else its two bounds.

    ``observations`` has findingId, observedAt, eventId, detected, label.
    """
    looked_at = top_per_key(observations, ["findingId"], [F.col("observedAt"), F.col("eventId")], rows, "_place")
    dated = looked_at.where(F.col("observedAt").isNotNull())
    first = top_per_key(dated, ["findingId"], [F.col("_place")], lines, "line")
    seen = first.select(
        "findingId", "line", F.concat_ws(" | ", iso_utc(F.col("observedAt")), "label",
                                         F.when(F.col("detected"), "detected").otherwise("not detected")).alias("text"))
    bounds = F.array_compact(F.array(
        F.concat(iso_utc(F.col("firstSeen")), F.lit(" | First detection")),
        F.concat(iso_utc(F.col("lastSeen")), F.lit(" | Last observation"))))
    without = findings.join(observations.select("findingId").distinct(), "findingId", "left_anti")
    return seen.unionByName(without.select("findingId", F.posexplode(bounds).alias("p", "text")).select(
        "findingId", (F.col("p") + 1).alias("line"), "text"))


def coverage_counts(findings: DataFrame, observed: DataFrame, with_component: DataFrame) -> DataFrame:
    """How many findings of each asset have a CVE, a score, dates, a remediation, a history and components."""
    flagged = (
        findings.join(observed.select("assetId", "findingId").distinct().withColumn("_h", F.lit(True)), ["assetId", "findingId"], "left")
        .join(with_component.select("findingId").distinct().withColumn("_c", F.lit(True)), "findingId", "left"))
    has_component = F.col("_c") | first_present(F.col("affectedProduct"), F.col("detectedVersion"), F.col("targetVersion")).isNotNull()
    return flagged.groupBy("assetId").agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(F.size("cves") > 0).alias("withCve"),
        F.count_if(F.col("cvss").isNotNull()).alias("withCvss"),
        F.count_if(F.col("firstSeen").isNotNull() | F.col("lastSeen").isNotNull()).alias("withDates"),
        F.count_if(F.coalesce("recommendation", F.lit("")) != "").alias("withRemediation"),
        F.count_if(F.coalesce("_h", F.lit(False))).alias("withHistory"),
        F.count_if(F.coalesce(has_component, F.lit(False))).alias("withComponents"))
