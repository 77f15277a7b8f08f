"""Summaries by asset, CVE and remediation.

Every summary aggregates the findings first, with partial aggregation in the map tasks, and only then adds the
asset columns to one row per group. That way a hot asset, CVE or text never travels as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import CRITICAL_TRS
from palisade.functions.dates import day_boundaries
from palisade.functions.nulls import blank_to_null
from palisade.functions.scoring import priority
from palisade.functions.text import stable_key

CRITICAL_COLUMNS = [
    "assetId", "hostname", "ipAddress", "assetOsPrimary", "findingId", "findingName", "status", "hyScoreV2", "cve",
    "cvssScore", "cvssVector", "severity", "provider", "port", "protocol", "service", "description", "remediation",
    "firstSeen", "lastSeen",
]


def is_critical(threshold: float = CRITICAL_TRS) -> Column:
    return (F.col("hyScoreV2") >= threshold) | (F.upper("severity") == "CRITICAL")


def names(column: str) -> Column:
    """Distinct values as one sorted text. For columns drawn from a small vocabulary (scanners, systems, countries)."""
    return blank_to_null(F.array_join(F.array_sort(F.collect_set(column)), ", "))


def at_max(value: str, by: str) -> Column:
    """The value at the greatest ``by`` among rows that have a value; ties go to the greatest value."""
    known = F.col(value).isNotNull() & F.col(by).isNotNull()
    return F.max(F.when(known, F.struct(F.col(by), F.col(value))))[value]


def asset_summary(assets: DataFrame, facts: DataFrame, as_of: str, threshold: float = CRITICAL_TRS,
                  dates: str = "finding") -> DataFrame:
    """Counts, top scores, top CVE, scanners and age per asset that has findings.

    ``facts`` holds one row per (asset, finding) with the finding columns. Ages and last dates come from the
    findings, or from the asset itself with ``dates="asset"``.
    """
    per_asset = facts.groupBy("assetId").agg(
        F.count(F.lit(1)).alias("openFindings"),
        F.count_if(is_critical(threshold)).alias("criticalFindings"),
        F.count_if(F.upper("severity") == "HIGH").alias("highFindings"),
        F.max("hyScoreV2").alias("maxFindingTrs"),
        F.max("cvssScore").alias("maxCvss"),
        at_max("cve", "hyScoreV2").alias("topCve"),
        names("provider").alias("provider"),
        F.min("firstSeen").alias("_first"),
        F.max("lastSeen").alias("_last"),
    )
    joined = assets.join(per_asset, "assetId")
    first, last = ("_first", "_last") if dates == "finding" else ("firstSeen", "lastSeen")
    return joined.select(
        "assetId", "hostname", "ipAddress", "assetOsPrimary", "provider", "country", "businessUnit",
        "assetHyScoreV2", "openFindings", "criticalFindings", "highFindings", "maxFindingTrs", "maxCvss", "topCve",
        day_boundaries(F.col(first), as_of).alias("oldestFindingDays"), F.col(last).alias("lastSeen"),
    )


def critical_findings(assets: DataFrame, facts: DataFrame, threshold: float = CRITICAL_TRS) -> DataFrame:
    """Findings at or above the threshold, or of critical severity, with their asset columns.

    A hot asset is a split key of the join: the asset side has one row per key, so adaptive execution copies that row.
    """
    chosen = facts.where(is_critical(threshold)).drop("hostname")
    dims = assets.select("assetId", "hostname", "ipAddress", "assetOsPrimary")
    return chosen.join(dims, "assetId").select(*CRITICAL_COLUMNS)


def cve_summary(assets: DataFrame, facts: DataFrame) -> DataFrame:
    """Spread, top scores and the lists of scanners, systems and countries per CVE."""
    known = facts.where(F.col("cve").isNotNull())
    # One row per (CVE, asset) is enough for the asset columns and for counting assets.
    by_asset = known.groupBy("cve", "assetId").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("hyScoreV2").alias("maxTrs"),
        F.max("cvssScore").alias("maxCvss"),
        F.max(F.when(F.col("severity").isNotNull() & F.col("cvssScore").isNotNull(),
                     F.struct("cvssScore", "severity"))).alias("sev"),
        F.max(F.when(F.col("remediation").isNotNull() & F.col("hyScoreV2").isNotNull(),
                     F.struct("hyScoreV2", "remediation"))).alias("rem"),
        F.collect_set("provider").alias("scanners"),
    )
    dims = assets.select("assetId", "assetOsPrimary", "country")
    placed = by_asset.join(dims, "assetId")
    return placed.groupBy("cve").agg(
        F.count(F.lit(1)).alias("affectedAssets"),
        F.sum("n").alias("openInstances"),
        F.max("maxTrs").alias("maxTrs"),
        F.max("maxCvss").alias("maxCvss"),
        F.max("sev")["severity"].alias("severity"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("scanners")))), ", ").alias("providers"),
        names("assetOsPrimary").alias("operatingSystems"),
        names("country").alias("countries"),
        F.max("rem")["remediation"].alias("remediation"),
    ).withColumnRenamed("cve", "cveId")


def remediation_summary(facts: DataFrame) -> DataFrame:
    """Spread and priority per remediation text, compared trimmed and case-insensitively."""
    text = F.lower(F.trim("remediation"))
    known = facts.where(F.col("remediation").isNotNull() & (F.trim("remediation") != "")).withColumn("_text", text)
    grouped = known.groupBy("_text").agg(
        F.max("remediation").alias("remediation"),
        F.count_distinct("assetId").alias("affectedAssets"),
        F.count_distinct("cve").alias("cveCount"),
        F.count(F.lit(1)).alias("findingCount"),
        F.max("hyScoreV2").alias("maxTrs"),
        F.max("cvssScore").alias("maxCvss"),
        names("provider").alias("providers"),
    )
    return grouped.select(
        stable_key(F.col("_text")).alias("remediationKey"), "remediation", "affectedAssets", "findingCount",
        "cveCount", "maxTrs", "maxCvss", "providers",
        priority(F.col("maxTrs"), F.col("maxCvss")).alias("priority"),
    )
