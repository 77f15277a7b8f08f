"""Deduplicated star: assets, findings, the bridge between them, and CVE tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.operators.skew import first_per_key, hot_safe_join

SEARCH_COLUMNS = [
    "assetId", "hostname", "findingId", "findingName", "status", "vulnerabilityTypeId", "hyScoreV2", "cve",
    "cvssScore", "cvssVector", "severity", "description", "remediation", "port", "protocol", "service", "provider",
    "firstSeen", "lastSeen", "cisaKev",
]
# Newest first; the other columns make the order total so that ties always resolve the same way.
NEWEST = [
    "lastSeen", "hyScoreV2", "firstSeen", "vulnerabilityTypeId", "port", "cvssScore", "cve", "description",
    "remediation", "service", "cisaKev",
]
OVERLAY = [
    "findingName", "status", "vulnerabilityTypeId", "hyScoreV2", "cve", "cvssScore", "cvssVector", "severity",
    "description", "remediation", "port", "protocol", "service", "provider", "firstSeen", "lastSeen",
    "ignored", "deactivated", "expired",
]


def newest_first(df: DataFrame) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in NEWEST if c in df.columns]


def latest_relations(search: DataFrame) -> DataFrame:
    """One row per (asset, finding), the most recently seen."""
    return first_per_key(search, ["assetId", "findingId"], newest_first(search))


def latest_findings(merged: DataFrame) -> DataFrame:
    """One row per finding, without the asset columns."""
    return first_per_key(merged, ["findingId"], newest_first(merged)).drop("assetId", "hostname")


def facts(merged: DataFrame, assets: DataFrame | None) -> DataFrame:
    """Every (asset, finding) pair with the newest finding's columns, where ``assets`` are given those of known assets only; the
    newest sighting may be on any asset.

    A finding on very many assets is one key of a plain equi join with one row per key on the other side, which adaptive
    execution splits.
    """
    pairs = merged.select("assetId", "hostname", "findingId")
    if assets is not None:
        pairs = pairs.join(assets.select("assetId"), "assetId", "left_semi")
    return pairs.join(latest_findings(merged), "findingId")


def sighted_facts(search: DataFrame, assets: DataFrame | None) -> DataFrame:
    """:func:`facts` from the raw sightings, without the host name of a pair's own sighting.

    Only the two ids of a pair move beside the newest sightings: the newest sighting of a finding is also the newest of its newest ones
    per asset. The result stays dealt by finding, so joins by finding or by (finding, asset) go on without moving it.
    """
    pairs = search.select("assetId", "findingId")
    if assets is not None:
        pairs = pairs.join(assets.select("assetId"), "assetId", "left_semi")
    return pairs.repartition("findingId").distinct().join(latest_findings(search), "findingId")


def latest_assets(assets: DataFrame) -> DataFrame:
    order = [F.col("lastSeen").desc_nulls_last()] + [
        F.col(c).desc_nulls_last() for c in assets.columns if c not in ("assetId", "lastSeen")
    ]
    return first_per_key(assets, ["assetId"], order)


def bridge(merged: DataFrame) -> DataFrame:
    return merged.select("assetId", "findingId", "hostname")


def overlay_details(search: DataFrame, details: DataFrame) -> DataFrame:
    """Search rows with every common column taken from the detail row first; known exploitation stays as searched.

    ``details`` has one row per finding.
    """
    shared = [c for c in OVERLAY if c in details.columns and c in search.columns]
    renamed = details.select("findingId", *[F.col(c).alias(f"_d_{c}") for c in shared])
    joined = hot_safe_join(search, renamed, ["findingId"], "left")
    return joined.select(
        *[F.coalesce(f"_d_{c}", c).alias(c) if c in shared else F.col(c) for c in search.columns]
    )


def finding_cves(merged: DataFrame) -> DataFrame:
    return (
        merged.where(F.col("cve").isNotNull() & (F.col("cve") != ""))
        .select("findingId", F.upper(F.trim("cve")).alias("cveId"))
        .distinct()
    )


def cves(finding_cves_: DataFrame) -> DataFrame:
    return finding_cves_.select("cveId").distinct()


def finding_ids(rows: DataFrame) -> DataFrame:
    """One row per (asset, finding): any host and status (the greatest, to be repeatable), top score, any KEV."""
    return rows.groupBy("assetId", "findingId").agg(
        F.max("hostname").alias("hostname"),
        F.max("hyScoreV2").alias("hyScoreV2"),
        F.max("status").alias("status"),
        F.bool_or(F.coalesce("cisaKev", F.lit(False))).alias("cisaKev"),
    )


def build_counters(assets: DataFrame, search: DataFrame, merged: DataFrame, details_used: bool) -> DataFrame:
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("counter"), "value")

    used = search.sparkSession.range(1).select(
        F.lit("detailEnrichmentUsed").alias("counter"), F.lit(int(details_used)).cast("bigint").alias("value")
    )
    return (
        count(assets, "assets")
        .unionByName(count(search, "relationsBeforeDedup"))
        .unionByName(count(merged, "relationsAfterDedup"))
        .unionByName(used)
    )


def instances(assets: DataFrame, merged: DataFrame, findings: DataFrame) -> DataFrame:
    """Bridge joined with assets and findings; both pairs of dates stay visible under their own names.

    A hot finding or asset is one key of an equi join with one row per key on the other side, which adaptive execution splits.
    """
    asset_side = assets.withColumnsRenamed({"firstSeen": "assetFirstSeen", "lastSeen": "assetLastSeen"})
    return merged.select("assetId", "findingId").join(findings, "findingId").join(asset_side, "assetId")
