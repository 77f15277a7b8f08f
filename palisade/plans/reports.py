"""Named queries: data quality, audits, search, presentation tables and digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions import json_text
from palisade.operators import dashboard, digest, documents, gold, quality, search, silver
from palisade.operators import intelligence as intel
from palisade.operators.silver import bridge
from palisade.plans.documents import _docs, bodies
from palisade.plans.intelligence import _CF, _CX, component_rows, docs, findings, kept, sql
from palisade.plans.lens import AS_OF, lens, oracle, read, sold_items
from palisade.plans.registry import query
from palisade.plans.scalar_rules import PRIORITY_SCORE_SQL
from palisade.plans.silver_gold import REMEDIATION_SUMMARY_SQL, facts, merged
from palisade.plans.worklists import PLAN_SUMMARY_SQL, _plan, plan_rows
from palisade.session import new_folder, written
from palisade.sources import files, sinks

c = F.col


# --- quality -------------------------------------------------------------------------------
@query("context_violations", sql("""
SELECT DISTINCT * FROM (
  SELECT 'invalid_priority' AS rule, findingId AS entity, 'P9' AS detail FROM fx WHERE findingId LIKE '%7-1'
  UNION ALL SELECT 'invalid_history_state', findingId, 'ODD' FROM fx WHERE findingId LIKE '%8-2'
  UNION ALL SELECT 'first_after_last', findingId, NULL FROM fx WHERE firstSeen > lastSeen
  UNION ALL SELECT 'cve_not_consolidated', cve, assetId FROM (SELECT assetId, unnest(cves) AS cve FROM fx) WHERE cve LIKE '%7'
  UNION ALL SELECT 'unknown_action_finding', findingId || '-x', assetId FROM fx WHERE findingId LIKE '%9-3'
  UNION ALL SELECT 'duplicate_component', "componentId", assetId FROM cf GROUP BY 2, 3 HAVING count(*) > 1
  UNION ALL SELECT 'scanner_not_in_sources', scanner, assetId FROM fx WHERE scanner = 'Microsoft Azure'
  UNION ALL SELECT 'asset_without_hostname', assetId, NULL FROM assets WHERE assetOsPrimary IS NULL
  UNION ALL SELECT 'strict_missing_field', assetId, 'asset.business.owner' FROM assets WHERE businessUnit IS NULL)""", cx=_CX, cf=_CF))
def _(spark, sf):
    return quality.context_violations(*seeded_context(spark, sf))


@query("context_violations_of_reports", sql("""
SELECT DISTINCT * FROM (
  SELECT 'missing_block' AS rule, assetId AS entity, 'validation' AS detail FROM assets WHERE assetId LIKE '%31'
  UNION ALL SELECT 'missing_block', assetId, 'sources' FROM assets WHERE assetId LIKE '%31' OR assetId LIKE '%52'
  UNION ALL SELECT rule, entity, detail FROM (
    SELECT 'missing_schema_version' AS rule, assetId AS entity, NULL AS detail, assetId AS a FROM assets WHERE assetId LIKE '%4'
    UNION ALL SELECT 'duplicate_finding', findingId, assetId, assetId FROM fx WHERE findingId LIKE '%5-1'
    UNION ALL SELECT 'invalid_priority', findingId, 'P9', assetId FROM fx WHERE findingId LIKE '%7-1'
    UNION ALL SELECT 'invalid_history_state', findingId, 'ODD', assetId FROM fx WHERE findingId LIKE '%8-2'
    UNION ALL SELECT 'first_after_last', findingId, NULL, assetId FROM fx WHERE firstSeen > lastSeen
    UNION ALL SELECT 'cve_not_consolidated', cve, assetId, assetId FROM (SELECT assetId, unnest(cves) AS cve FROM fx) WHERE cve LIKE '%7'
    UNION ALL SELECT 'unknown_action_finding', findingId || '-x', assetId, assetId FROM fx WHERE findingId LIKE '%9-3'
    UNION ALL SELECT 'duplicate_component', "componentId", assetId, assetId FROM cf GROUP BY 2, 3 HAVING count(*) > 1
    UNION ALL SELECT 'scanner_not_in_sources', scanner, assetId, assetId FROM fx WHERE scanner = 'Microsoft Azure'
    UNION ALL SELECT 'asset_without_hostname', assetId, NULL, assetId FROM assets WHERE assetOsPrimary IS NULL
    UNION ALL SELECT 'strict_missing_field', assetId, 'asset.business.owner', assetId FROM assets WHERE businessUnit IS NULL
  ) WHERE a NOT LIKE '%31' AND a NOT LIKE '%52')""", cx=_CX, cf=_CF))
def _(spark, sf):
    # Reports that lack a block or their version, and findings that stand in their report twice.
    assets, found, *others = seeded_context(spark, sf)
    twice = found.unionByName(found.where(c("findingId").endswith("5-1")))
    versions = assets.select("assetId", F.when(~c("assetId").endswith("4"), "1.0").alias("schemaVersion"))
    blocks = assets.select("assetId", F.explode(F.array(*map(F.lit, fixed.REQUIRED_BLOCKS))).alias("section")).where(
        ~((c("section") == "validation") & c("assetId").endswith("31"))
        & ~((c("section") == "sources") & c("assetId").rlike("(31|52)$")))
    return quality.context_violations(assets, twice, *others, versions=versions, blocks=blocks)


def seeded_context(spark, sf):
    """The tables of the context rules with a fault seeded for each of them; the clean tables are checked in the tests."""
    sold = sold_items(spark, sf)
    found = kept(findings(spark, sf, sold=sold), "assetId", "findingId", "priority", "historyState", "firstSeen", "lastSeen", "cves", "scanner",
                 "title", "trs", "cvss", "severity", "recommendation")
    seeded = found.withColumns({
        "priority": F.when(c("findingId").endswith("7-1"), "P9").otherwise(c("priority")),
        "historyState": F.when(c("findingId").endswith("8-2"), "ODD").otherwise(c("historyState"))})
    known = intel.finding_cve_rows(found).where(~c("cve").endswith("7"))
    refs = found.select("assetId", F.when(c("findingId").endswith("9-3"), F.concat("findingId", F.lit("-x")))
                        .otherwise(c("findingId")).alias("findingId"))
    names = found.select("assetId", c("scanner").alias("name")).where("name <> 'Microsoft Azure'")
    own = lens(spark, sf, "assets")
    assets = own.withColumn("hostname", F.when(c("assetOsPrimary").isNotNull(), c("hostname")))
    missing = own.where("businessUnit IS NULL").select("assetId", F.lit("asset.business.owner").alias("missing"))
    return assets, seeded, known, refs, intel.component_findings(component_rows(spark, sf, sold), found), names, missing


@query("component_warnings", sql("""
SELECT DISTINCT * FROM (
  SELECT 'component_without_version' AS rule, "componentId" AS entity FROM cx WHERE "installedVersion" IS NULL
  UNION ALL SELECT 'required_version_without_installed_version', "componentId" FROM cx WHERE "installedVersion" IS NULL AND "requiredVersion" IS NOT NULL
  UNION ALL SELECT 'installed_version_without_product', "componentId" FROM cx WHERE findingId LIKE '%1' AND product IS NULL
  UNION ALL SELECT 'path_without_component', 'o-' || findingId FROM docs WHERE component IS NULL AND filePath IS NOT NULL)""", cx=_CX))
def _(spark, sf):
    rows = component_rows(spark, sf).withColumns({
        "package": F.when(~c("findingId").endswith("1"), c("package")),
        "component": F.when(~c("findingId").endswith("1"), c("component"))})
    found = docs(spark, sf).where("filePath IS NOT NULL AND component IS NULL").select(
        F.concat(F.lit("o-"), "findingId").alias("occurrenceId"), F.concat(F.lit("none-"), "findingId").alias("componentId"),
        c("filePath").alias("installPath"))
    return quality.component_warnings(rows, found)


@query("null_profile", oracle("""
SELECT * FROM (SELECT 'hyScoreV2' AS "column", count(*) FILTER (hyScoreV2 IS NULL) AS "nullCount", count(*) AS rows,
  round(100 * count(*) FILTER (hyScoreV2 IS NULL) / count(*), 2) AS "nullPct" FROM search
 UNION ALL SELECT 'cve', count(*) FILTER (cve IS NULL), count(*), round(100 * count(*) FILTER (cve IS NULL) / count(*), 2) FROM search
 UNION ALL SELECT 'service', count(*) FILTER (service IS NULL), count(*), round(100 * count(*) FILTER (service IS NULL) / count(*), 2) FROM search
 UNION ALL SELECT 'provider', count(*) FILTER (provider IS NULL), count(*), round(100 * count(*) FILTER (provider IS NULL) / count(*), 2) FROM search
 UNION ALL SELECT 'findingId', 0, count(*), 0 FROM search) WHERE "nullPct" >= 5""", "search"))
def _(spark, sf):
    return quality.null_profile(lens(spark, sf, "search").select("hyScoreV2", "cve", "service", "provider", "findingId"), 0.05)


@query("coverage", oracle("""
SELECT 'cve' AS "column", round(100.0 * count(*) FILTER (cve NOT IN ('', '[]', '{}')) / count(*), 2) AS "coveragePct" FROM search
UNION ALL SELECT 'cvssScore', round(100.0 * count(cvssScore) / count(*), 2) FROM search
UNION ALL SELECT 'remediation', round(100.0 * count(*) FILTER (remediation NOT IN ('', '[]', '{}')) / count(*), 2) FROM search""", "search"))
def _(spark, sf):
    return quality.coverage(lens(spark, sf, "search"), ["cve", "cvssScore", "remediation"])


@query("uniqueness_checks", oracle("""
SELECT 'merged pair' AS name, count(*) AS rows, count(DISTINCT (assetId, findingId)) AS "distinctKeys",
  count(*) = count(DISTINCT (assetId, findingId)) AS passed FROM merged
UNION ALL SELECT 'search finding', count(*), count(DISTINCT findingId), count(*) = count(DISTINCT findingId) FROM search
UNION ALL SELECT 'search provider pair', count(*), count(DISTINCT (findingId, provider)), count(*) = count(DISTINCT (findingId, provider)) FROM search
""", "merged"))
def _(spark, sf):
    raw = lens(spark, sf, "search")
    return (
        quality.uniqueness(bridge(merged(spark, sf)), ["assetId", "findingId"], "merged pair")
        .unionByName(quality.uniqueness(raw, ["findingId"], "search finding"))
        .unionByName(quality.uniqueness(raw, ["findingId", "provider"], "search provider pair")))


@query("content_checks", """
SELECT 'body invalid JSON' AS "check", count(*) FILTER (event_id % 10 = 3) AS "badRows" FROM events
UNION ALL SELECT 'bad history link', count(*) FILTER (event_id % 4 = 1) FROM events
UNION ALL SELECT 'possible secret', count(*) FILTER (event_id % 25 = 0 OR event_id % 25 = 1) FROM events
""")
def _(spark, sf):
    rows = read(spark, sf, "events").select(
        F.when(c("event_id") % 10 == 3, F.concat("props", F.lit("}"))).when(c("event_id") % 10 == 4, F.lit(None))
        .otherwise(c("props")).alias("body"),
        F.when(c("event_id") % 4 == 0, F.lit("https://a/assets/live-report/1/vuln-management/findings/finding/2/history"))
        .when(c("event_id") % 4 == 1, F.lit("http://a/history")).alias("link"),
        F.when(c("event_id") % 25 == 0, F.lit("sent Authorization: x")).when(c("event_id") % 25 == 1, F.lit("a Bearer t"))
        .otherwise(c("event_type")).alias("text"))
    return quality.content_checks(rows, ["body"], "link", "text")


@query("document_secrets", r"""
SELECT doc_id, contains(lower(text), 'authorization:') OR contains(lower(text), 'bearer ') OR contains(lower(text), 'api_key') AS hit FROM documents
""")
def _(spark, sf):
    from palisade.functions.evidence_text import has_secret

    return read(spark, sf, "documents").select("doc_id", has_secret(c("text")).alias("hit"))


_PAIRS = {"e": "SELECT DISTINCT coalesce(findingId, '') AS f, coalesce(provider, '') AS p FROM search WHERE port > 3",
          "a": "SELECT DISTINCT coalesce(findingId, '') AS f, coalesce(provider, '') AS p FROM merged WHERE protocol = 'tcp'"}


def _pairs(spark, sf):
    return lens(spark, sf, "search").where("port > 3"), merged(spark, sf).where("protocol = 'tcp'"), ["findingId", "provider"]


@query("key_comparison", oracle("""
SELECT 'pairs' AS domain, x AS "availableRaw", y AS structured, m AS matched, x - m AS missing, y - m AS unexpected,
  round(100.0 * m / x, 2) AS "coveragePct" FROM (SELECT (SELECT count(*) FROM e) AS x, (SELECT count(*) FROM a) AS y,
  (SELECT count(*) FROM (SELECT * FROM e INTERSECT SELECT * FROM a)) AS m)""", "merged", extra=_PAIRS))
def _(spark, sf):
    return quality.key_comparison(*_pairs(spark, sf), "pairs")


@query("key_examples", oracle("""
SELECT * FROM (SELECT 'missing' AS kind, f AS "findingId", p AS provider FROM (SELECT * FROM e EXCEPT SELECT * FROM a) ORDER BY f, p LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'unexpected', f, p FROM (SELECT * FROM a EXCEPT SELECT * FROM e) ORDER BY f, p LIMIT 10)
""", "merged", extra=_PAIRS))
def _(spark, sf):
    return quality.key_examples(*_pairs(spark, sf))


@query("mapping_completeness", _docs("""
SELECT 'finding_details' AS domain, count(*) AS "availableRaw", count(*) AS structured, count(*) AS matched, 0 AS missing, 0 AS unexpected,
  100.0 AS "coveragePct", 'INCOMPLETE' AS status FROM docs
UNION ALL SELECT 'providers', count(DISTINCT findingId), count(DISTINCT CASE WHEN providerId IS NOT NULL THEN findingId END),
  count(DISTINCT CASE WHEN providerId IS NOT NULL THEN findingId END), count(DISTINCT CASE WHEN providerId IS NULL THEN findingId END), 0,
  round(100.0 * count(DISTINCT CASE WHEN providerId IS NOT NULL THEN findingId END) / count(DISTINCT findingId), 2), 'INCOMPLETE' FROM docs"""))
def _(spark, sf):
    raw = documents.envelopes(bodies(spark, sf)).where("valid").select(
        json_text.at(c("doc"), "findingId").alias("findingId"), json_text.at(c("doc"), "assetId").alias("assetId"),
        F.coalesce(json_text.at(c("doc"), "data.assessmentsRelated.activeFindingProviderInfos[0].providerId"), F.lit("")).alias("providerId"))
    own = docs(spark, sf)
    return quality.completeness_report([
        quality.key_comparison(raw, own, ["findingId", "assetId"], "finding_details"),
        quality.key_comparison(raw, own.where("providerId IS NOT NULL"), ["findingId", "providerId"], "providers")])


@query("output_report", oracle("""
SELECT 'assets' AS dataset, count(*) AS rows, 9 AS columns, '' AS "complexColumns" FROM assets
UNION ALL SELECT 'findings', count(*), 2, 'cves' FROM merged""", "assets", "merged"))
def _(spark, sf):
    return quality.output_report({
        "assets": lens(spark, sf, "assets"),
        "findings": merged(spark, sf).select("findingId", F.array("cve").alias("cves"))})


@query("blocking_errors", oracle("""
SELECT 'nested columns in findings: cves' AS error FROM merged GROUP BY 1 UNION ALL SELECT 'search finding' FROM search
GROUP BY 1 HAVING count(*) <> count(DISTINCT findingId)""", "merged"))
def _(spark, sf):
    report = quality.output_report({"findings": merged(spark, sf).select("findingId", F.array("cve").alias("cves"))})
    return quality.blocking_errors(report, quality.uniqueness(lens(spark, sf, "search"), ["findingId"], "search finding"))


# --- validation of written tables ----------------------------------------------------------
_VALIDATED = {"customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
              "labels": ("doc_id", "quality", "toxic"), "documents": ("doc_id", "text", "lang", "source", "n_chars"),
              "embeddings": ("vec_id", "embedding", "label")}


@query("output_validation", " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, '{n}' AS field, {str(n == 'embedding').lower()} AS nested, count(*) AS rows,
  {'CAST(NULL AS DOUBLE)' if n == 'embedding' else f'round(100.0 * count(*) FILTER ({n} IS NULL) / nullif(count(*), 0), 2)'} AS "nullPercent" FROM {t}"""
    for t, names in _VALIDATED.items() for n in names))
def _(spark, sf):
    return files.footer_report(spark, sf, [f"{t}.parquet" for t in _VALIDATED]).select(
        F.regexp_replace("dataset", "[.]parquet$", "").alias("dataset"), "field", "nested", "rows", "nullPercent")


@query("output_errors", """
SELECT 'missing: absent.parquet' AS error FROM labels GROUP BY 1 UNION ALL SELECT 'nested columns in embeddings.parquet: embedding' FROM embeddings GROUP BY 1
""")
def _(spark, sf):
    names = ["labels.parquet", "absent.parquet", "embeddings.parquet"]
    return quality.file_errors(files.footer_report(spark, sf, names), names)


@query("run_manifest", """
SELECT 'completed_with_errors' AS status, counter, CAST(value AS BIGINT) AS value FROM (
  SELECT 'documentsRead' AS counter, count(*) AS value FROM events UNION ALL SELECT 'documentsWritten', count(*) FILTER (event_id % 6 = 0) FROM events
  UNION ALL SELECT 'documentsFailed', count(*) FILTER (event_id % 6 <> 0) FROM events
  UNION ALL SELECT 'rowsOnDisk', count(*) FILTER (event_id % 6 = 0) FROM events)""")
def _(spark, sf):
    kind = c("event_id") % 6
    body = F.when(kind == 0, F.concat(F.lit('{"findingId":"f","data":'), "props", F.lit("}"))).when(kind < 3, F.lit('{"findingId":1}')).otherwise("[")
    checked = documents.envelopes(read(spark, sf, "events").select("event_id", body.alias("body")))
    path = new_folder(spark, "run")
    entry = sinks.observed_run(
        checked, path, "run", keep=c("valid"), read="documentsRead", wrote="documentsWritten", failed="documentsFailed", drop=["doc", "valid"])
    on_disk = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("completed_with_errors").alias("status"), F.lit("rowsOnDisk").alias("counter"), "value")
    return entry.select("status", F.explode("counters").alias("counter", "value")).unionByName(on_disk)


# --- search --------------------------------------------------------------------------------
@query("resolve_asset", oracle("""
SELECT assetId, hostname FROM assets WHERE lower(hostname) = 'customer-000000042.any' OR split_part(lower(hostname), '.', 1) = 'customer-000000042'
""", "assets"))
def _(spark, sf):
    return search.resolve_asset(lens(spark, sf, "assets"), "Customer-000000042.any").select("assetId", "hostname")


@query("context_lookup", oracle("""
SELECT assetId, score FROM (SELECT assetId, CASE WHEN rtrim(lower(hostname), '.') = 'customer-00000001' THEN 0 ELSE 1 END AS score,
  hostname FROM assets WHERE contains(rtrim(lower(hostname), '.'), 'customer-00000001')) ORDER BY score, hostname LIMIT 1""", "assets"))
def _(spark, sf):
    heads = lens(spark, sf, "assets").withColumn("fqdn", c("hostname"))
    return search.best_context(heads, "Customer-00000001.").select("assetId", "score")


@query("free_text", oracle("""
SELECT assetId FROM assets WHERE contains(lower(concat_ws('|', assetId, hostname, CAST(assetHyScoreV2 AS VARCHAR), ipAddress, assetOsPrimary,
  country, businessUnit)), 'nation_7.')""", "assets"))
def _(spark, sf):
    return search.text_matches(lens(spark, sf, "assets"), " NATION_7.").select("assetId")


@query("key_lookup", oracle("""
SELECT 'assets' AS dataset, 'assetId' AS "column", count(*) AS n FROM assets WHERE lower(trim(assetId)) = 'asset-7'
UNION ALL SELECT 'findings', 'assetId', least(5, count(*)) FROM merged WHERE lower(trim(assetId)) = 'asset-7'""", "assets", "merged"))
def _(spark, sf):
    data = {"assets": lens(spark, sf, "assets"), "findings": merged(spark, sf), "events": read(spark, sf, "events")}
    return search.lookup(data, "asset_id", " Asset-7 ", 5).groupBy("dataset", "column").agg(F.count(F.lit(1)).alias("n"))


@query("column_filters", oracle("""
SELECT findingId FROM merged WHERE severity = 'HIGH' AND provider = 'Azure' AND coalesce(hyScoreV2, 0) >= 300 AND coalesce(cvssScore, 0) >= 2
""", "merged"))
def _(spark, sf):
    return merged(spark, sf).where((c("severity") == "HIGH") & (c("provider") == "Azure") & search.at_least("hyScoreV2", 300)
                                   & search.at_least("cvssScore", 2)).select("findingId")


# --- presentation --------------------------------------------------------------------------
_AGE = "greatest(0, CAST(floor(date_diff('second', {}, TIMESTAMP '" + AS_OF + "') / 86400) AS BIGINT))"
_SEV = """CASE WHEN severity <> '' THEN upper(severity) WHEN coalesce({t}, 0) >= 900 OR coalesce({c}, 0) >= 9 THEN 'CRITICAL'
  WHEN coalesce({t}, 0) >= 700 OR coalesce({c}, 0) >= 7 THEN 'HIGH' WHEN coalesce({t}, 0) >= 400 OR coalesce({c}, 0) >= 4 THEN 'MEDIUM' ELSE 'LOW' END"""


def _pri(t: str, cv: str, kev: str, age: str) -> str:
    return f"""CASE WHEN {kev} OR coalesce({t}, 0) >= 900 OR coalesce({cv}, 0) >= 9 THEN 'P1'
      WHEN coalesce({t}, 0) >= 700 OR coalesce({cv}, 0) >= 7 OR {age} >= 180 THEN 'P2' ELSE 'P3' END"""


def _score(t: str, cv: str, kev: str, age: str) -> str:
    return PRIORITY_SCORE_SQL.format(age=age, kev=kev).replace("hyScoreV2", t).replace("cvssScore", cv)


_ACTION_CVE = "'Appliquer le correctif éditeur associé à ' || {} || ', redémarrer si requis, puis relancer un scan de validation.'"
_ACTION_ANY = "'Analyser la preuve du provider, appliquer le correctif recommandé par l’éditeur, puis relancer un scan de validation.'"


@query("findings_presented", oracle(f"""
SELECT findingId, {_SEV.format(t='hyScoreV2', c='cvssScore')} AS severity, {_AGE.format('firstSeen')} AS "ageDays",
  {_AGE.format('lastSeen')} AS "staleDays", {_pri('hyScoreV2', 'cvssScore', 'cisaKev', _AGE.format('firstSeen'))} AS priority,
  {_score('hyScoreV2', 'cvssScore', 'cisaKev', _AGE.format('firstSeen'))} AS "priorityScore",
  CASE WHEN remediation <> '' THEN 'source' ELSE 'derived' END AS "remediationSource",
  coalesce(nullif(remediation, ''), {_ACTION_CVE.format("nullif(cve, '')")}, 'Corriger ou désactiver le service ' || service
    || ' s’il n’est pas nécessaire, puis relancer un contrôle.', {_ACTION_ANY}) AS remediation,
  'TRS ' || CAST(CAST(round_even(coalesce(hyScoreV2, 0), 0) AS BIGINT) AS VARCHAR) || ' · CVSS ' || printf('%.1f', coalesce(cvssScore, 0.0))
    || ' · exposition ' || CAST({_AGE.format('firstSeen')} AS VARCHAR) || ' j' AS "priorityReason" FROM facts""", "facts"))
def _(spark, sf):
    return dashboard.enrich_findings(facts(spark, sf), AS_OF).select(
        "findingId", "severity", "ageDays", "staleDays", "priority", "priorityScore", "remediationSource", "remediation", "priorityReason")


_CVE_SUMMARY = """SELECT cve AS "cveId", count(DISTINCT assetId) AS "affectedAssets", max(hyScoreV2) AS "maxTrs", max(cvssScore) AS "maxCvss",
  first(severity ORDER BY cvssScore DESC, severity DESC) FILTER (severity IS NOT NULL AND cvssScore IS NOT NULL) AS severity,
  first(remediation ORDER BY hyScoreV2 DESC, remediation DESC) FILTER (remediation IS NOT NULL AND hyScoreV2 IS NOT NULL) AS remediation
  FROM instances WHERE cve IS NOT NULL GROUP BY cve"""


def cve_summary(spark, sf):
    return gold.cve_summary(lens(spark, sf, "assets"), facts(spark, sf))


@query("cves_presented", oracle(f"""
SELECT "cveId", {_SEV.format(t='"maxTrs"', c='"maxCvss"')} AS severity, {_pri('"maxTrs"', '"maxCvss"', 'false', '0')} AS priority,
  {_score('"maxTrs"', '"maxCvss"', 'false', '0')} AS "priorityScore", CASE WHEN remediation <> '' THEN 'source' ELSE 'derived' END AS "remediationSource",
  coalesce(nullif(remediation, ''), {_ACTION_CVE.format('"cveId"')}) AS remediation FROM cs""", "instances", extra={"cs": _CVE_SUMMARY}))
def _(spark, sf):
    return dashboard.enrich_cves(cve_summary(spark, sf)).select(
        "cveId", "severity", "priority", "priorityScore", "remediationSource", "remediation")


@query("remediations_presented", oracle(f"""
SELECT remediationKey, maxTrs, findingCount, cveCount, {_pri('maxTrs', 'maxCvss', 'false', '0')} AS priority,
  {_score('maxTrs', 'maxCvss', 'false', '0')} AS "priorityScore",
  'TRS max ' || CAST(CAST(round_even(coalesce(maxTrs, 0), 0) AS BIGINT) AS VARCHAR) || ' · CVSS max ' || printf('%.1f', coalesce(maxCvss, 0.0)) AS "priorityReason"
FROM rs""", "instances", extra={"rs": REMEDIATION_SUMMARY_SQL}))
def _(spark, sf):
    return dashboard.enrich_remediations(gold.remediation_summary(facts(spark, sf))).select(
        "remediationKey", "maxTrs", "findingCount", "cveCount", "priority", "priorityScore", "priorityReason")


@query("plans_presented", _plan(f"""
SELECT remediationKey, maxHyScore AS "maxTrs", affectedFindings AS "findingCount", distinctCves AS "cveCount",
  {_pri('maxHyScore', 'maxCvss', 'cisaKevFindings > 0', '0')} AS priority,
  {_score('maxHyScore', 'maxCvss', 'cisaKevFindings > 0', '0')} AS "priorityScore",
  concat_ws(' · ', 'TRS max ' || CAST(CAST(round_even(coalesce(maxHyScore, 0), 0) AS BIGINT) AS VARCHAR), 'CVSS max ' || printf('%.1f', coalesce(maxCvss, 0.0)),
    CASE WHEN cisaKevFindings > 0 THEN CAST(cisaKevFindings AS VARCHAR) || ' CISA KEV' END, 'cible ' || expectedVersion) AS "priorityReason"
FROM ({PLAN_SUMMARY_SQL})"""))
def _(spark, sf):
    from palisade.operators.remediation_plan import plan_summary

    return dashboard.enrich_remediations(plan_summary(plan_rows(spark, sf))).select(
        "remediationKey", "maxTrs", "findingCount", "cveCount", "priority", "priorityScore", "priorityReason")


_RAW_DIMS = """SELECT 'asset-' || CAST(o_custkey AS STRING) AS assetId, o_orderkey, o_orderstatus, o_orderpriority FROM orders"""


def raw_findings(spark, sf):
    """Raw finding objects with the shapes the dimensions come in: lists of texts, lists of objects, objects, scalars."""
    body = F.to_json(F.struct(
        F.array(F.concat(F.lit("per-"), (c("o_orderkey") % 5).cast("string"))).alias("perimeterIds"),
        F.array(F.struct(F.concat(F.lit("leaf-"), (c("o_orderkey") % 3).cast("string")).alias("id"))).alias("leafPerimeterIds"),
        F.create_map(F.concat(F.lit("prov-"), c("o_orderstatus")), F.lit(1)).alias("providerIds"),
        F.when(c("o_orderkey") % 2 == 0, F.array(F.lit("extra"))).alias("assetProviderIds"),
        c("o_orderstatus").alias("assetState"), F.lit("SERVER").alias("assetType"),
        (c("o_orderpriority") == "1-URGENT").alias("cisaKev"),
        F.create_map(F.when(c("o_orderkey") % 7 == 0, "net.Public_IP").otherwise("owner"), F.lit("x")).alias("tags")))
    return read(spark, sf, "orders").select(
        F.concat(F.lit("asset-"), c("o_custkey").cast("string")).alias("assetId"), F.try_parse_json(body).alias("doc"))


_DIMS = """SELECT assetId, string_agg(DISTINCT 'per-' || (o_orderkey % 5), ',' ORDER BY 'per-' || (o_orderkey % 5)) AS "perimeterIds",
  string_agg(DISTINCT 'leaf-' || (o_orderkey % 3), ',' ORDER BY 'leaf-' || (o_orderkey % 3)) AS "leafPerimeterIds",
  concat_ws(',', CASE WHEN bool_or(o_orderkey % 2 = 0) THEN 'extra' END,
            string_agg(DISTINCT 'prov-' || o_orderstatus, ',' ORDER BY 'prov-' || o_orderstatus)) AS "providerIds",
  string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS "assetStates", 'SERVER' AS "assetTypes",
  count(*) FILTER (o_orderpriority = '1-URGENT') AS "cisaKevFindings", count(*) FILTER (o_orderkey % 7 = 0) AS "internetFacingSignals",
  count(*) AS "findingCountObserved" FROM raw GROUP BY assetId"""
_SETS = ["perimeterIds", "leafPerimeterIds", "providerIds", "assetStates", "assetTypes"]


def dimensions(spark, sf):
    return dashboard.asset_dimensions(raw_findings(spark, sf))


def joined_sets(df):
    return df.withColumns({name: F.array_join(name, ",") for name in _SETS})


@query("asset_dimensions", oracle(_DIMS, extra={"raw": _RAW_DIMS}))
def _(spark, sf):
    return joined_sets(dimensions(spark, sf))


def summarised(spark, sf):
    return gold.asset_summary(lens(spark, sf, "assets"), facts(spark, sf), AS_OF)


_SUM = """SELECT assetId, hostname, ipAddress, count(*) AS "openFindings", count(*) FILTER (hyScoreV2 >= 900 OR upper(severity) = 'CRITICAL') AS "criticalFindings",
  max(hyScoreV2) AS "maxFindingTrs", max(date_diff('day', firstSeen, DATE '2002-01-01')) AS "oldestFindingDays" FROM instances GROUP BY ALL"""
_DASH = {"summary": _SUM, "raw": _RAW_DIMS, "dims": _DIMS,
         "wide": 'SELECT * FROM summary LEFT JOIN dims USING (assetId)'}
_CRIT = "SELECT assetId, hostname, findingId, cve, severity, hyScoreV2, remediation FROM instances WHERE hyScoreV2 >= 900 OR upper(severity) = 'CRITICAL'"


def wide(spark, sf):
    return dashboard.with_dimensions(summarised(spark, sf), dimensions(spark, sf))


def critical(spark, sf):
    return gold.critical_findings(lens(spark, sf, "assets"), facts(spark, sf))


_SCOPE = """assetId IN (SELECT assetId FROM wide WHERE contains(',' || "perimeterIds" || ',', ',per-2,')
  AND contains(',' || "providerIds" || ',', ',prov-P,') AND "maxFindingTrs" >= 900 AND "cisaKevFindings" > 0)"""


def scoped(spark, sf):
    return wide(spark, sf).where(search.scope_filter("per-2", "prov-P", "critical", True))


@query("assets_with_dimensions", oracle("""
SELECT assetId, "openFindings", "perimeterIds", "findingCountObserved" FROM wide""", "instances", extra=_DASH))
def _(spark, sf):
    return joined_sets(wide(spark, sf)).select("assetId", "openFindings", "perimeterIds", "findingCountObserved")


@query("raw_findings_summarised", oracle("""
SELECT assetId, count(*) AS n FROM raw WHERE assetId IN (SELECT assetId FROM summary) GROUP BY 1""", "instances", extra=_DASH))
def _(spark, sf):
    return dashboard.only_summarised(raw_findings(spark, sf), summarised(spark, sf)).groupBy("assetId").agg(
        F.count(F.lit(1)).alias("n"))


@query("assets_in_scope", oracle(f"SELECT assetId FROM summary WHERE {_SCOPE}", "instances", extra=_DASH))
def _(spark, sf):
    return scoped(spark, sf).select("assetId")


@query("assets_preset_kev", oracle("""SELECT assetId FROM wide WHERE "cisaKevFindings" > 0""", "instances", extra=_DASH))
def _(spark, sf):
    return wide(spark, sf).where(search.scope_filter(kev=True)).select("assetId")


@query("findings_in_scope", oracle(f"SELECT findingId FROM crit WHERE {_SCOPE}", "instances", extra={**_DASH, "crit": _CRIT}))
def _(spark, sf):
    return dashboard.findings_in_scope(critical(spark, sf), scoped(spark, sf)).select("findingId")


@query("cves_in_scope", oracle(f"""
SELECT "cveId" FROM cs WHERE "cveId" IN (SELECT cve FROM crit WHERE {_SCOPE} AND cve LIKE 'CVE-%')
  OR "cveId" IN (SELECT trim(cve) FROM crit WHERE {_SCOPE} AND upper(trim(cve)) LIKE 'CVE-%')""",
    "instances", extra={**_DASH, "crit": _CRIT, "cs": _CVE_SUMMARY}))
def _(spark, sf):
    return dashboard.cves_in_scope(
        cve_summary(spark, sf), dashboard.findings_in_scope(critical(spark, sf), scoped(spark, sf))).select("cveId")


@query("server_findings", oracle("""
SELECT a.assetId AS "serverId", f.findingId FROM summary a JOIN f ON f.assetId = a.assetId
UNION SELECT a.assetId, f.findingId FROM summary a JOIN f ON a.hostname = f.hostname""", "instances",
    extra={**_DASH, "f": """SELECT CASE WHEN port % 2 = 0 THEN assetId ELSE 'gone' END AS assetId, hostname, findingId FROM instances"""}))
def _(spark, sf):
    every = facts(spark, sf).drop("hostname").join(lens(spark, sf, "assets").select("assetId", "hostname"), "assetId")
    moved = every.select(F.when(c("port") % 2 == 0, c("assetId")).otherwise("gone").alias("assetId"), "hostname", "findingId")
    return dashboard.server_findings(moved, summarised(spark, sf))


@query("related_remediations",
    oracle("""
SELECT assetId, remediationKey, place, true AS direct FROM ranked WHERE place <= 5
UNION ALL SELECT s.assetId, remediationKey, place, false FROM summary s, best WHERE place <= 5 AND s.assetId NOT IN (SELECT assetId FROM hits)
""", "instances", "facts", extra={
        "summary": _SUM, "crit": _CRIT, "rs": REMEDIATION_SUMMARY_SQL,
        "openings": "SELECT remediationKey, maxTrs, left(lower(remediation), 45) AS o FROM rs WHERE length(remediation) > 20",
        "texts": "SELECT assetId, string_agg(lower(coalesce(remediation, '') || ' ' || coalesce(cve, '')), ' ' ORDER BY findingId) AS t FROM crit GROUP BY assetId",
        "hits": "SELECT DISTINCT assetId, remediationKey, maxTrs FROM texts JOIN openings ON contains(t, o)",
        "ranked": "SELECT *, row_number() OVER (PARTITION BY assetId ORDER BY coalesce(maxTrs, 0) DESC, remediationKey) AS place FROM hits",
        "best": "SELECT remediationKey, maxTrs, row_number() OVER (ORDER BY coalesce(maxTrs, 0) DESC, remediationKey) AS place FROM rs"}))
def _(spark, sf):
    # The three tables come from the same facts, and the remediations are read several times: each written once.
    assets = lens(spark, sf, "assets")
    every = written(silver.sighted_facts(lens(spark, sf, "search"), assets).drop("vulnerabilityTypeId"), "facts")
    return dashboard.related_remediations(
        gold.critical_findings(assets, every), written(gold.remediation_summary(every), "remediations"),
        gold.asset_summary(assets, every, AS_OF)
    ).select("assetId", "remediationKey", "place", "direct")


@query("key_figures", oracle("""
SELECT (SELECT count(*) FROM wide) AS assets, (SELECT count(*) FROM wide WHERE "maxFindingTrs" >= 900) AS "criticalAssets",
  (SELECT max("maxFindingTrs") FROM wide) AS "maxTrs", (SELECT CAST(sum(coalesce("cisaKevFindings", 0)) AS BIGINT) FROM wide) AS "kevFindings",
  (SELECT count(*) FROM wide WHERE ipAddress IS NULL) AS "assetsWithoutIp", (SELECT max("oldestFindingDays") FROM wide) AS "oldestFindingDays",
  (SELECT count(*) FROM crit) AS findings, (SELECT count(*) FROM cs) AS cves, (SELECT count(*) FROM cs WHERE "maxCvss" >= 9) AS "cvesCvss9",
  (SELECT count(*) FROM rs) AS actions, (SELECT count(*) FROM rs WHERE priority = 'P1') AS "p1Actions"
""", "instances", "facts", extra={**_DASH, "crit": _CRIT, "cs": _CVE_SUMMARY, "rs": REMEDIATION_SUMMARY_SQL}))
def _(spark, sf):
    assets = lens(spark, sf, "assets")
    pairs = written(merged(spark, sf), "merged")
    return dashboard.key_figures(assets, silver.facts(pairs, assets), dashboard.kev_signals(raw_findings(spark, sf)), AS_OF)


@query("risk_histogram", oracle("""
SELECT 'critical' AS band, count(*) FILTER ("maxFindingTrs" >= 900) AS assets FROM summary
UNION ALL SELECT 'high', count(*) FILTER ("maxFindingTrs" >= 700 AND "maxFindingTrs" < 900) FROM summary
UNION ALL SELECT 'medium', count(*) FILTER ("maxFindingTrs" >= 400 AND "maxFindingTrs" < 700) FROM summary
UNION ALL SELECT 'low', count(*) FILTER (coalesce("maxFindingTrs", 0) < 400) FROM summary""", "instances", extra={"summary": _SUM}))
def _(spark, sf):
    return dashboard.risk_histogram(summarised(spark, sf))


@query("severity_distribution", oracle("""
SELECT coalesce(nullif(severity, ''), 'Non classé') AS severity, count(*) AS findings FROM facts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""", "facts"))
def _(spark, sf):
    return dashboard.severity_distribution(facts(spark, sf))


@query("top_assets", oracle("""
SELECT assetId, "openFindings" FROM summary ORDER BY coalesce("openFindings", 0) DESC, assetId LIMIT 6""", "instances", extra={"summary": _SUM}))
def _(spark, sf):
    return dashboard.ranked(summarised(spark, sf), "findings", dashboard.ASSET_SORTS, "assetId", 6).select("assetId", "openFindings")


@query("top_assets_by_name", oracle("""
SELECT assetId, hostname FROM summary ORDER BY lower(hostname), assetId LIMIT 6""", "instances", extra={"summary": _SUM}))
def _(spark, sf):
    return dashboard.ranked(summarised(spark, sf), "hostname", dashboard.ASSET_SORTS, "assetId", 6).select("assetId", "hostname")


@query("top_cves", oracle("""
SELECT "cveId", "affectedAssets" FROM cs ORDER BY "affectedAssets" DESC, "cveId" LIMIT 250""", "instances", extra={"cs": _CVE_SUMMARY}))
def _(spark, sf):
    return dashboard.ranked(cve_summary(spark, sf), "assets", dashboard.CVE_SORTS, "cveId", 250).select("cveId", "affectedAssets")


@query("server_top_findings", oracle("""
SELECT assetId, findingId, place FROM (SELECT *, row_number() OVER (PARTITION BY assetId ORDER BY coalesce(hyScoreV2, 0) DESC, findingId) AS place
  FROM crit WHERE severity = 'HIGH') WHERE place <= 8""", "instances", extra={"crit": _CRIT}))
def _(spark, sf):
    return dashboard.ranked_server_findings(critical(spark, sf), 8, severity="HIGH").select("assetId", "findingId", "place")


# --- digest --------------------------------------------------------------------------------
@query("digest_top_findings", sql("""
SELECT assetId, findingId, place, greatest(0, n - 5) AS omitted FROM (SELECT assetId, findingId, count(*) OVER (PARTITION BY assetId) AS n,
  row_number() OVER (PARTITION BY assetId ORDER BY coalesce(trs, 0) DESC, findingId) AS place FROM fx) WHERE place <= 5"""))
def _(spark, sf):
    return digest.top_findings(findings(spark, sf)).select("assetId", "findingId", "place", "omitted")


@query("digest_history_lines", oracle("""
SELECT findingId, line, strftime(observedAt, '%Y-%m-%dT%H:%M:%S.%f') || 'Z | ' || label || ' | ' || CASE WHEN detected THEN 'detected' ELSE 'not detected' END AS text
FROM (SELECT *, row_number() OVER (PARTITION BY findingId ORDER BY observedAt, eventId) AS line FROM observations) WHERE line <= 12""", "observations"))
def _(spark, sf):
    seen = lens(spark, sf, "observations")
    bounds = seen.groupBy("findingId").agg(F.min("observedAt").alias("firstSeen"), F.max("observedAt").alias("lastSeen"))
    return digest.history_lines(bounds, seen)


@query("digest_coverage", sql("""
SELECT f.assetId, count(*) AS findings, count(*) FILTER (len(cves) > 0) AS "withCve", count(cvss) AS "withCvss",
  count(*) FILTER (f.firstSeen IS NOT NULL OR f.lastSeen IS NOT NULL) AS "withDates", count(recommendation) AS "withRemediation",
  count(*) FILTER (f.firstSeen IS NOT NULL OR f.lastSeen IS NOT NULL) AS "withHistory",
  count(*) FILTER (affectedProduct IS NOT NULL OR detectedVersion IS NOT NULL OR targetVersion IS NOT NULL
    OR findingId IN (SELECT findingId FROM docs WHERE component IS NOT NULL)) AS "withComponents"
FROM fx f GROUP BY 1"""))
def _(spark, sf):
    sold = sold_items(spark, sf)
    found = findings(spark, sf, sold=sold)
    return digest.coverage_counts(found, intel.bound_observations(found), component_rows(spark, sf, sold))


@query("component_fallback", sql("""
SELECT findingId, CASE WHEN affectedProduct IS NOT NULL OR detectedVersion IS NOT NULL OR targetVersion IS NOT NULL
  THEN concat_ws('/', affectedProduct, detectedVersion, targetVersion) ELSE '' END AS component FROM fx"""))
def _(spark, sf):
    none = F.array().cast("array<struct<package:string,product:string,installedVersion:string,requiredVersion:string>>")
    rows = digest.component_fallback(none, c("affectedProduct"), c("detectedVersion"), c("targetVersion"))
    shown = F.array_join(F.transform(rows, lambda r: F.concat_ws("/", r["package"], r["installedVersion"], r["requiredVersion"])), ";")
    return findings(spark, sf).select("findingId", shown.alias("component"))


@query("document_paths", _docs("""
SELECT 'findings/' || findingId || '.json' AS source, 'vulnerable' AS "pathClass", unnest(['/srv/' || findingId]) AS "foundPath" FROM docs
UNION SELECT 'findings/' || findingId || '.json', 'vulnerable', unnest([filePath, '/b/x']) FROM docs WHERE filePath IS NOT NULL
UNION SELECT 'findings/' || findingId || '.json', 'install', filePath FROM docs WHERE filePath IS NOT NULL"""))
def _(spark, sf):
    found = documents.leaves(documents.parsed(bodies(spark, sf)), c("doc"), ["source"], text=c("body"))
    return digest.path_lists(found, ["source"]).select("source", "pathClass", "foundPath")
