"""Remediation rows from detail evidence and the plan summary on top of them.

Copies of one finding could multiply through four joins, so each side is first cut to what can still differ:
the newest detail per (finding, asset) and the distinct values of its children. What remains is the product of the
evidence of one finding, which is the result itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.text import composite_key
from palisade.operators.skew import first_per_key, hot_safe_join, listed

KEYS = ["findingId", "assetId"]


def no_assets(spark) -> DataFrame:
    """The typed empty relation that stands in when there is no asset table."""
    return spark.createDataFrame([], "assetId string, assetOsPrimary string")


def remediation_findings(details: DataFrame, assets: DataFrame | None, cves: DataFrame, paths: DataFrame,
                         versions: DataFrame) -> DataFrame:
    """Finding x CVE x path x version rows; the path itself is not shown, only the greatest one of each type.

    Child rows match on finding and asset; a finding without an asset id therefore has no children. Rows and children are dealt by
    finding once; in a session that is set ``side_by_side`` all joins, groups and windows below stay there.
    """
    assets = no_assets(details.sparkSession) if assets is None else assets
    order = [F.col("extractedAt").desc_nulls_last()] + [
        F.col(name).desc_nulls_last() for name in details.columns if name not in (*KEYS, "extractedAt")
    ]
    owned = hot_safe_join(details, assets.select("assetId", "assetOsPrimary"), ["assetId"], "left")
    newest = first_per_key(owned.repartition("findingId"), KEYS, order)
    # Every child moves once, to its finding.
    one_cve = cves.repartition("findingId").groupBy(*KEYS, "cve").agg(F.max("description").alias("cveDescription"))
    one_path = paths.select(*KEYS, "pathType", "path").repartition("findingId").distinct()
    one_version = versions.select(*KEYS, "component", "detectedVersion", "expectedVersion").repartition("findingId").distinct()
    rows = (
        newest.join(one_cve, KEYS, "left")
        .join(one_path, KEYS, "left")
        .join(one_version, KEYS, "left")
    )
    parts = ("cve", "pathType", "path", "component", "detectedVersion", "expectedVersion")
    kept = first_per_key(
        rows.withColumns({f"_{name}": F.coalesce(name, F.lit("")) for name in parts}),
        ["findingId", *[f"_{name}" for name in parts]],
        [F.col("extractedAt").desc_nulls_last(), F.col("assetId").desc_nulls_last()],
    )
    # Every distinct path of the group is still there, so the greatest one can be taken from the reduced rows.
    group = Window.partitionBy("findingId", "cve", "_component")

    def greatest(kind: str) -> Column:
        return F.max(F.when(F.col("pathType") == kind, F.col("path"))).over(group)

    return kept.withColumns({"registryPath": greatest("REGISTRY"), "filePath": greatest("FILE")}).drop(
        *[f"_{name}" for name in parts], "pathType", "path")


GROUP = ["remediation", "providerId", "findingName", "component", "expectedVersion"]


def plan_summary(rows: DataFrame) -> DataFrame:
    """Spread, scores and exploitation per remediation, provider, name, component and target version."""
    key = composite_key(*[F.col(name) for name in GROUP])
    # The distinct ids of a plan row move with a digest of its texts, the texts themselves once per plan row and task.
    digest = F.unhex(F.md5(F.to_json(F.struct(*GROUP))))
    return rows.groupBy(digest.alias("_plan")).agg(
        *[F.max(name).alias(name) for name in GROUP],
        F.count_distinct("assetId").alias("affectedAssets"),
        F.count_distinct("findingId").alias("affectedFindings"),
        F.count_distinct("cve").alias("distinctCves"),
        F.max("cvssScore").alias("maxCvss"),
        F.max("hyScoreV2").alias("maxHyScore"),
        F.count_distinct(F.when(F.col("cisaKev"), F.col("findingId"))).alias("cisaKevFindings"),
    ).select(key.alias("remediationKey"), "remediation", "providerId", "component", "expectedVersion",
             "affectedAssets", "affectedFindings", "distinctCves", "maxCvss", "maxHyScore", "cisaKevFindings")


def plan_lists(rows: DataFrame, column: str) -> DataFrame:
    """The CVE or host list of each plan row, in parts when it is long."""
    keyed = rows.select(composite_key(*[F.col(name) for name in GROUP]).alias("remediationKey"), column)
    return listed(keyed, ["remediationKey"], column)
