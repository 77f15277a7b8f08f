"""Which findings to look at next, and what has been done already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.fixed_values import CRITICAL_TRS
from palisade.functions.nulls import blank_to_null

_OPTIONAL = {"assetId": "string", "hostname": "string", "status": "string", "hyScoreV2": "double", "cisaKev": "boolean"}


def work_list(rows: DataFrame) -> DataFrame:
    """One row per finding; a column the source lacks becomes a typed null."""
    if "findingId" not in rows.columns:
        raise ValueError("the source needs a findingId column")
    full = rows.select("findingId", *[
        F.col(name) if name in rows.columns else F.lit(None).cast(kind).alias(name)
        for name, kind in _OPTIONAL.items()
    ])
    return full.groupBy("findingId").agg(
        F.max("assetId").alias("assetId"), F.max("hostname").alias("hostname"), F.max("status").alias("status"),
        F.max("hyScoreV2").alias("hyScoreV2"), F.bool_or(F.coalesce("cisaKev", F.lit(False))).alias("cisaKev"),
    )


def select_candidates(work: DataFrame, status: str | None = "OPEN", min_score: float = CRITICAL_TRS,
                      only_kev: bool = False, all_findings: bool = False) -> DataFrame:
    """Wanted or unknown status, and a high score or known exploitation; ``all_findings`` turns the rules off."""
    if all_findings:
        return work
    chosen = work.where((F.coalesce("hyScoreV2", F.lit(0.0)) >= min_score) | F.col("cisaKev"))
    if status:
        chosen = chosen.where((F.col("status") == status) | F.col("status").isNull())
    return chosen.where("cisaKev") if only_kev else chosen


def in_order(work: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Known exploitation first, then by score; the id makes the order total."""
    ordered = work.orderBy(F.col("cisaKev").desc(), F.col("hyScoreV2").desc_nulls_last(), F.col("findingId"))
    ordered = ordered.offset(offset) if offset else ordered
    return ordered if limit is None else ordered.limit(limit)


def single_finding(work: DataFrame, finding_id: str, status: str | None = "OPEN") -> DataFrame:
    """A work list of one requested finding, with nothing else known about it."""
    return work.sparkSession.range(1).select(
        F.lit(finding_id).alias("findingId"), F.lit(None).cast("string").alias("assetId"),
        F.lit(None).cast("string").alias("hostname"), F.lit(status).cast("string").alias("status"),
        F.lit(None).cast("double").alias("hyScoreV2"), F.lit(False).alias("cisaKev"))


def not_yet_done(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: what has no row in the table of finished keys."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def fetch_status(work: DataFrame, cache: DataFrame, force: bool = False) -> DataFrame:
    """Per finding: skipped (a valid copy is there), refetch (an invalid or forced one) or download.

    ``cache`` has findingId and ``valid``.
    """
    seen = cache.groupBy("findingId").agg(F.bool_or("valid").alias("valid"))
    joined = work.join(seen, "findingId", "left")
    keep = F.lit(not force)
    return joined.withColumn(
        "fetch",
        F.when(F.col("valid").isNull(), "download").when(F.col("valid") & keep, "skipped").otherwise("refetch"),
    ).withColumn("invalidCache", F.coalesce(~F.col("valid"), F.lit(False))).drop("valid")


def fetch_counts(statuses: DataFrame) -> DataFrame:
    return statuses.agg(
        F.count(F.lit(1)).alias("selected"), F.count_if(F.col("fetch") == "skipped").alias("skipped"),
        F.count_if(F.col("fetch") != "skipped").alias("toFetch"), F.count_if("invalidCache").alias("invalidCache"))


def sampled(items: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key: the sampled ingest, taken before anything is unnested."""
    return items.orderBy(key).limit(n)


def usable_findings(rows: DataFrame) -> DataFrame:
    """Findings without an id are dropped."""
    return rows.where(blank_to_null(F.col("findingId")).isNotNull())


def assets_in_state(assets: DataFrame, states: list[str], asset_id: str | None = None) -> DataFrame:
    chosen = assets.where(F.col("state").isin(*states))
    return chosen if asset_id is None else chosen.where(F.col("assetId") == asset_id)
