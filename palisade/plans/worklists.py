"""Named queries: work lists, resume and remediation plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.operators import remediation_plan, worklist
from palisade.plans.lens import lens, oracle, read
from palisade.plans.registry import query
from palisade.session import side_by_side, written

_WORK = """SELECT findingId, max(assetId) AS assetId, max(hostname) AS hostname, max(status) AS status,
  max(hyScoreV2) AS hyScoreV2, bool_or(coalesce(cisaKev, false)) AS cisaKev FROM search GROUP BY findingId"""


def _work(body: str) -> str:
    return oracle(body, "search", extra={"work": _WORK})


def work(spark, sf):
    return worklist.work_list(lens(spark, sf, "search"))


@query("work_list", _work("SELECT * FROM work"))
def _(spark, sf):
    return work(spark, sf)


@query("work_list_missing_columns", oracle("""
SELECT findingId, CAST(NULL AS STRING) AS assetId, CAST(NULL AS STRING) AS hostname, CAST(NULL AS STRING) AS status,
  max(hyScoreV2) AS hyScoreV2, false AS cisaKev FROM search GROUP BY findingId""", "search"))
def _(spark, sf):
    return worklist.work_list(lens(spark, sf, "search").select("findingId", "hyScoreV2"))


@query("work_list_candidates", _work("""
SELECT * FROM work WHERE (status = 'OPEN' OR status IS NULL) AND (coalesce(hyScoreV2, 0) >= 900 OR cisaKev)"""))
def _(spark, sf):
    return worklist.select_candidates(work(spark, sf))


@query("work_list_kev_only", _work("""
SELECT * FROM work WHERE (coalesce(hyScoreV2, 0) >= 500 OR cisaKev) AND cisaKev"""))
def _(spark, sf):
    return worklist.select_candidates(work(spark, sf), status=None, min_score=500, only_kev=True)


@query("work_list_page", _work("""
SELECT findingId, hyScoreV2, cisaKev FROM work ORDER BY cisaKev DESC, hyScoreV2 DESC NULLS LAST, findingId LIMIT 100 OFFSET 50"""))
def _(spark, sf):
    return worklist.in_order(work(spark, sf), limit=100, offset=50).select("findingId", "hyScoreV2", "cisaKev")


@query("resume_pending", """
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def _(spark, sf):
    done = read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return worklist.not_yet_done(read(spark, sf, "orders").select("o_custkey"), done, "o_custkey").distinct()


_CACHE = "SELECT findingId, bool_or(firstCve IS NOT NULL) AS valid FROM details WHERE component IS NOT NULL GROUP BY findingId"


@query("fetch_status", oracle("""
SELECT w.findingId, CASE WHEN c.valid IS NULL THEN 'download' WHEN c.valid THEN 'skipped' ELSE 'refetch' END AS fetch,
  coalesce(NOT c.valid, false) AS "invalidCache" FROM work w LEFT JOIN cache c USING (findingId)
""", "search", "details", extra={"work": _WORK, "cache": _CACHE}))
def _(spark, sf):
    cache = lens(spark, sf, "details").where("component IS NOT NULL").selectExpr("findingId", "firstCve IS NOT NULL AS valid")
    return worklist.fetch_status(work(spark, sf), cache).select("findingId", "fetch", "invalidCache")


@query("fetch_counts", oracle("""
SELECT count(*) AS selected, count(*) FILTER (c.valid) AS skipped, count(*) FILTER (c.valid IS NULL OR NOT c.valid) AS "toFetch",
  count(*) FILTER (NOT c.valid) AS "invalidCache" FROM work w LEFT JOIN cache c USING (findingId)
""", "search", "details", extra={"work": _WORK, "cache": _CACHE}))
def _(spark, sf):
    cache = lens(spark, sf, "details").where("component IS NOT NULL").selectExpr("findingId", "firstCve IS NOT NULL AS valid")
    return worklist.fetch_counts(worklist.fetch_status(work(spark, sf), cache))


@query("sampled_assets", oracle("SELECT assetId, hostname FROM assets ORDER BY assetId LIMIT 25", "assets"))
def _(spark, sf):
    return worklist.sampled(lens(spark, sf, "assets"), "assetId", 25).select("assetId", "hostname")


@query("usable_findings", """
SELECT findingId, count(*) AS n FROM (SELECT CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL ELSE CAST(l_orderkey AS STRING) END
  AS findingId FROM lineitem) WHERE findingId <> '' GROUP BY 1
""")
def _(spark, sf):
    rows = read(spark, sf, "lineitem").selectExpr(
        "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS findingId")
    return worklist.usable_findings(rows).groupBy("findingId").agg(F.count(F.lit(1)).alias("n"))


@query("assets_in_state", oracle("""
SELECT assetId FROM assets WHERE businessUnit IN ('BUILDING', 'MACHINERY')""", "assets"))
def _(spark, sf):
    listed = lens(spark, sf, "assets").withColumnRenamed("businessUnit", "state")
    return worklist.assets_in_state(listed, ["BUILDING", "MACHINERY"]).select("assetId")


# The children as the reference tables hold them: several rows per finding, copies included.
_CHILDREN = {
    "fc": """SELECT findingId, assetId, firstCve AS cve, 'First' AS description FROM details WHERE firstCve IS NOT NULL
      UNION ALL SELECT findingId, assetId, secondCve, NULL FROM details WHERE secondCve IS NOT NULL""",
    "ep": """SELECT findingId, assetId, 'REGISTRY' AS pathType, registryPath AS path FROM details WHERE registryPath IS NOT NULL
      UNION ALL SELECT findingId, assetId, 'FILE', filePath FROM details WHERE filePath IS NOT NULL
      UNION ALL SELECT findingId, assetId, 'FILE', secondFilePath FROM details WHERE secondFilePath IS NOT NULL""",
    "v": """SELECT findingId, assetId, component, detectedVersion, expectedVersion FROM details
      WHERE detectedVersion IS NOT NULL OR expectedVersion IS NOT NULL""",
}
_MAIN = ["hyScoreV2", "findingName", "providerId", "cvssScore", "epssScore", "cisaKev", "remediation", "firstSeen", "lastSeen", "hostname"]
# From the definition: the newest detail of every finding on an asset, each combination of its children once, and beside it the
# greatest path of either kind that the finding has for that CVE and component.
_NEWEST_FIRST = f"extractedAt DESC NULLS LAST, {', '.join(f'{name} DESC NULLS LAST' for name in _MAIN)}"
_PLAN_STEPS = {
    "newest": f"SELECT DISTINCT ON (findingId, assetId) findingId, assetId, extractedAt, {', '.join(_MAIN)} FROM details "
              f"ORDER BY findingId, assetId, {_NEWEST_FIRST}",
    "cve_of": "SELECT findingId, assetId, cve, max(description) AS cveDescription FROM fc GROUP BY ALL",
    "path_of": "SELECT DISTINCT findingId, assetId, pathType, path FROM ep",
    "version_of": "SELECT DISTINCT findingId, assetId, component, detectedVersion, expectedVersion FROM v",
    "combined": """SELECT n.*, cve, cveDescription, pathType, path, component, detectedVersion, expectedVersion
      FROM newest n LEFT JOIN cve_of USING (findingId, assetId) LEFT JOIN path_of USING (findingId, assetId)
      LEFT JOIN version_of USING (findingId, assetId)""",
    "greatest_path": """SELECT findingId, coalesce(cve, '') AS c, coalesce(component, '') AS k,
        max(path) FILTER (pathType = 'REGISTRY') AS registryPath, max(path) FILTER (pathType = 'FILE') AS filePath
      FROM combined GROUP BY ALL""",
    "once": f"""SELECT DISTINCT ON (findingId, coalesce(cve, ''), coalesce(pathType, ''), coalesce(path, ''), coalesce(component, ''),
        coalesce(detectedVersion, ''), coalesce(expectedVersion, '')) *
      FROM combined ORDER BY findingId, coalesce(cve, ''), coalesce(pathType, ''), coalesce(path, ''), coalesce(component, ''),
        coalesce(detectedVersion, ''), coalesce(expectedVersion, ''), extractedAt DESC NULLS LAST, assetId DESC NULLS LAST, {_NEWEST_FIRST}""",
    "rows": """SELECT o.*, a.assetOsPrimary, registryPath, filePath, substr(sha256(concat_ws('|', coalesce(remediation, ''),
        coalesce(providerId, ''), coalesce(findingName, ''), coalesce(component, ''), coalesce(expectedVersion, ''))), 1, 24) AS planKey
      FROM once o LEFT JOIN assets a ON a.assetId = o.assetId
      JOIN greatest_path g ON g.findingId = o.findingId AND c = coalesce(cve, '') AND k = coalesce(component, '')""",
}


def _plan(body: str) -> str:
    return oracle(body, "assets", "details", extra={**_CHILDREN, **_PLAN_STEPS})


def plan_rows(spark, sf):
    side_by_side(spark)
    # Read by every child and several times by each: joined and written once.
    details = written(lens(spark, sf, "details"), "details")
    assets = lens(spark, sf, "assets")
    key = ["findingId", "assetId"]

    def child(**columns):
        return details.select(*key, *[F.expr(text).alias(name) for name, text in columns.items()])

    cves = child(cve="firstCve", description="'First'").unionByName(
        child(cve="secondCve", description="CAST(NULL AS STRING)")).where("cve IS NOT NULL")
    paths = (child(pathType="'REGISTRY'", path="registryPath").unionByName(child(pathType="'FILE'", path="filePath"))
             .unionByName(child(pathType="'FILE'", path="secondFilePath")).where("path IS NOT NULL"))
    versions = child(component="component", detectedVersion="detectedVersion", expectedVersion="expectedVersion").where(
        "detectedVersion IS NOT NULL OR expectedVersion IS NOT NULL")
    main = details.select(*key, "extractedAt", *_MAIN)
    return remediation_plan.remediation_findings(main, assets, cves, paths, versions)


@query("remediation_findings", _plan("""
SELECT findingId, assetId, assetOsPrimary, cve, cveDescription, registryPath, filePath, component, detectedVersion,
  expectedVersion, hyScoreV2, remediation, extractedAt FROM rows"""))
def _(spark, sf):
    return plan_rows(spark, sf).select(
        "findingId", "assetId", "assetOsPrimary", "cve", "cveDescription", "registryPath", "filePath", "component",
        "detectedVersion", "expectedVersion", "hyScoreV2", "remediation", "extractedAt")


# Counted from one row per finding of a plan, one per asset and one per CVE.
PLAN_SUMMARY_SQL = """
SELECT f.planKey AS remediationKey, f.remediation, f.providerId, f.component, f.expectedVersion,
  (SELECT count(*) FROM (SELECT DISTINCT assetId FROM rows r WHERE r.planKey = f.planKey AND assetId IS NOT NULL)) AS affectedAssets,
  f.n AS affectedFindings,
  (SELECT count(*) FROM (SELECT DISTINCT cve FROM rows r WHERE r.planKey = f.planKey AND cve IS NOT NULL)) AS distinctCves,
  f.c AS maxCvss, f.h AS maxHyScore, f.kev AS cisaKevFindings
FROM (SELECT planKey, any_value(remediation) AS remediation, any_value(providerId) AS providerId, any_value(component) AS component,
        any_value(expectedVersion) AS expectedVersion, count(*) AS n, max(c) AS c, max(h) AS h, count(*) FILTER (kev) AS kev
      FROM (SELECT planKey, findingId, any_value(remediation) AS remediation, any_value(providerId) AS providerId,
              any_value(component) AS component, any_value(expectedVersion) AS expectedVersion, max(cvssScore) AS c,
              max(hyScoreV2) AS h, bool_or(coalesce(cisaKev, false)) AS kev FROM rows GROUP BY planKey, findingId)
      GROUP BY planKey) f"""


@query("remediation_plan_summary", _plan(PLAN_SUMMARY_SQL))
def _(spark, sf):
    return remediation_plan.plan_summary(plan_rows(spark, sf))


def _list_sql(column: str) -> str:
    return f"""
SELECT planKey AS remediationKey, parts, CAST(('0x' || substr(md5(value), 1, 8)) AS BIGINT) % parts AS part,
  CAST(to_json(list(value ORDER BY value)) AS VARCHAR) AS "itemsJson", count(*) AS items
FROM (SELECT planKey, {column} AS value, CAST(ceil(count(*) OVER (PARTITION BY planKey) / 10000) AS BIGINT) AS parts
      FROM rows WHERE {column} IS NOT NULL GROUP BY planKey, {column})
GROUP BY ALL"""


@query("remediation_plan_cves", _plan(_list_sql("cve")))
def _(spark, sf):
    return remediation_plan.plan_lists(plan_rows(spark, sf), "cve")


@query("remediation_plan_hosts", _plan(_list_sql("hostname")))
def _(spark, sf):
    return remediation_plan.plan_lists(plan_rows(spark, sf), "hostname")
