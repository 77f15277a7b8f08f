"""Named queries on nested documents.

Spark writes one detail document per finding from the driver tables (``bodies``) and the operators read it back,
so every expected value can also be said in SQL on the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions import json_text, text
from palisade.operators import details, documents, evidence, profile
from palisade.operators.skew import first_per_key
from palisade.plans.lens import LENSES, lens, oracle, read
from palisade.plans.registry import query
from palisade.session import small_methods

DETAIL_COLUMNS = [
    "extractedAt", "hyScoreV2", "firstSeen", "remediation", "findingName", "cvssScore", "lastSeen", "epssScore",
    "component", "detectedVersion", "expectedVersion", "registryPath", "filePath", "secondFilePath", "firstCve",
    "secondCve", "providerId", "cisaKev", "assetId", "hostname",
]
DOCS_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY findingId
    ORDER BY {', '.join(f'{name} DESC NULLS LAST' for name in DETAIL_COLUMNS)}) AS rn FROM details) WHERE rn = 1"""

_CVE_TYPE = "'commonVulnerabilityExposure'"
_TITLE = """CASE WHEN component IS NULL THEN 'Finding ' || findingId
    ELSE 'Qualys VM details for "' || component || '" (QID ' || replace(findingId, '-', '') || ')' END"""
_MORE = "'Also ' || secondFilePath"
_LINES = """nullif(concat_ws('\\n', registryPath || ' LastProduct = ' || expectedVersion,
    filePath || ' Version is ' || detectedVersion), '')"""
_STAMP = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss\") || 'Z'"

_BODY = f"""to_json(named_struct(
  'findingId', findingId, 'assetId', assetId, 'hostname', 'fallback.example', 'hyScoreV2', 1.0,
  'extractedAt', {_STAMP.format('extractedAt')}, 'sourceEndpoint', '/findings/' || findingId,
  'data', named_struct('name', findingName,
    'searchFinding', named_struct('assetEffectiveName', hostname, 'status', 'OPEN', 'cisaKev', cisaKev,
      'updatedAt', {_STAMP.format('lastSeen')}, 'mitreAttackTtps', array('T1059', 'T1003'),
      'findingStatus', named_struct('score', named_struct('hyScoreV2', hyScoreV2))),
    'assessmentsRelated', named_struct(
      'activeFindingProviderInfos', filter(array(
        named_struct('providerId', providerId, 'assessmentId', 'a-' || findingId, 'assessmentType', 'SCAN',
          'firstDetection', {_STAMP.format('firstSeen')},
          'initialScore', named_struct('base', cvssScore, 'environmental', epssScore, 'effectiveScoreInfo', named_struct(
            'cvss31Base', named_struct('AV', 'N', 'AC', 'H', 'PR', 'N', 'UI', 'N', 'S', 'C', 'C', 'H', 'I', 'H',
                                       'A', CASE WHEN secondCve IS NULL THEN 'L' END),
            'hyScoreMetrics', named_struct('FINDING_EPSS', epssScore))),
          'extendedAttributesList', filter(array(
            CASE WHEN firstCve IS NOT NULL THEN named_struct('type', {_CVE_TYPE}, 'id', firstCve, 'description', 'First',
              'references', '[{{"name":"NVD","url":"https://example.test/' || firstCve || '"}},"plain"]',
              'qid', CAST(NULL AS BIGINT), 'plugin-id', CAST(NULL AS STRING),
              'nested', CAST(NULL AS STRUCT<ruleId: STRING>), 'rule_id', CAST(NULL AS STRING)) END,
            CASE WHEN secondCve IS NOT NULL THEN named_struct('type', 'CommonVulnerabilityExposure', 'id', lower(secondCve),
              'description', CAST(NULL AS STRING), 'references', 'not json', 'qid', CAST(NULL AS BIGINT),
              'plugin-id', CAST(NULL AS STRING), 'nested', CAST(NULL AS STRUCT<ruleId: STRING>),
              'rule_id', CAST(NULL AS STRING)) END,
            named_struct('type', 'scanner', 'id', 'x', 'description', CAST(NULL AS STRING),
              'references', CAST(NULL AS STRING), 'qid', CAST(replace(findingId, '-', '') AS BIGINT),
              'plugin-id', 'p' || findingId, 'nested', CAST(NULL AS STRUCT<ruleId: STRING>),
              'rule_id', CAST(NULL AS STRING))), x -> x IS NOT NULL),
          'technicalDetails', named_struct('components', array(
            named_struct('package', component, 'installedVersion', detectedVersion, 'requiredVersion', expectedVersion,
              'language', 'Java', 'installPath', filePath, 'packageName', CAST(NULL AS STRING),
              'detected_version', CAST(NULL AS STRING), 'location', CAST(NULL AS STRING)),
            named_struct('package', CAST(NULL AS STRING), 'installedVersion', CAST(NULL AS STRING),
              'requiredVersion', CAST(NULL AS STRING), 'language', CAST(NULL AS STRING),
              'installPath', CAST(NULL AS STRING), 'packageName', component,
              'detected_version', detectedVersion, 'location', secondFilePath))),
          'details', CAST(NULL AS STRUCT<product: STRING, fixedVersion: STRING>),
          'vulnerableFilePaths', array('/srv/' || findingId),
          'sharedDetailsLocal', named_struct('assessmentName', 'Assessment', 'remediation', remediation,
            'extendedAttributesList', filter(array(
              CASE WHEN firstCve IS NOT NULL THEN named_struct('type', {_CVE_TYPE}, 'id', firstCve, 'description', 'First',
                'references', '[{{"name":"NVD","url":"https://example.test/' || firstCve || '"}},"plain"]') END,
              CASE WHEN secondCve IS NOT NULL THEN named_struct('type', 'CommonVulnerabilityExposure',
                'id', lower(secondCve), 'description', CAST(NULL AS STRING), 'references', 'not json') END,
              named_struct('type', 'scanner', 'id', 'CVE-1999-0001', 'description', 'other', 'references', '[]'),
              named_struct('type', {_CVE_TYPE}, 'id', 'CVE-1999-001', 'description', 'short', 'references', '[]')),
              x -> x IS NOT NULL), 'i18n', named_struct(
            'zz', named_struct('more', named_struct('text', {_MORE}), 'text', ' ' || {_TITLE} || ' '),
            'en', named_struct('content', named_struct('children', array(
              named_struct('children', array(named_struct('text', {_LINES})), 'text', CAST(NULL AS STRING)),
              named_struct('children', CAST(NULL AS ARRAY<STRUCT<text: STRING>>), 'text', {_TITLE}))))))),
        CASE WHEN filePath IS NOT NULL THEN named_struct('providerId', 'NESSUS', 'assessmentId', 'b-' || findingId,
          'assessmentType', CAST(NULL AS STRING), 'firstDetection', {_STAMP.format("firstSeen + INTERVAL 10 DAY")},
          'initialScore', named_struct('base', 1.5D, 'environmental', CAST(NULL AS DOUBLE), 'effectiveScoreInfo',
            CAST(NULL AS STRUCT<cvss31Base: STRUCT<AV: STRING, AC: STRING, PR: STRING, UI: STRING, S: STRING, C: STRING,
              I: STRING, A: STRING>, hyScoreMetrics: STRUCT<FINDING_EPSS: DOUBLE>>)),
          'extendedAttributesList', array(
            named_struct('type', CAST(NULL AS STRING), 'id', CAST(NULL AS STRING), 'description', CAST(NULL AS STRING),
              'references', CAST(NULL AS STRING), 'qid', CAST(NULL AS BIGINT), 'plugin-id', CAST(NULL AS STRING),
              'nested', named_struct('ruleId', 'R1'), 'rule_id', CAST(NULL AS STRING)),
            named_struct('type', CAST(NULL AS STRING), 'id', CAST(NULL AS STRING), 'description', CAST(NULL AS STRING),
              'references', CAST(NULL AS STRING), 'qid', CAST(NULL AS BIGINT), 'plugin-id', CAST(NULL AS STRING),
              'nested', CAST(NULL AS STRUCT<ruleId: STRING>), 'rule_id', 'R1')),
          'technicalDetails', CAST(NULL AS STRUCT<components: ARRAY<STRUCT<package: STRING, installedVersion: STRING,
            requiredVersion: STRING, language: STRING, installPath: STRING, packageName: STRING,
            detected_version: STRING, location: STRING>>>),
          'details', named_struct('product', component, 'fixedVersion', expectedVersion),
          'vulnerableFilePaths', array(filePath, '/b/x'),
          'sharedDetailsLocal', CAST(NULL AS STRUCT<assessmentName: STRING, remediation: STRING,
            extendedAttributesList: ARRAY<STRUCT<type: STRING, id: STRING, description: STRING, references: STRING>>, i18n: STRUCT<
            zz: STRUCT<more: STRUCT<text: STRING>, text: STRING>, en: STRUCT<content: STRUCT<children: ARRAY<STRUCT<
            children: ARRAY<STRUCT<text: STRING>>, text: STRING>>>>>>)) END), x -> x IS NOT NULL),
      'findingAuditHistory', named_struct('info', named_struct('atomInfos', array(
        named_struct('at', {_STAMP.format('firstSeen')}, 'auditId', 'evt-' || findingId, 'trigger', 'HUMAN__NEW_ASSESSMENT',
          'assessmentType', 'VULNERABILITY_SCAN', 'providerId', providerId,
          'declaredFindingStatus', named_struct('subState', 'CONFIRMED'), 'userId', 'u1'),
        named_struct('at', {_STAMP.format('lastSeen')}, 'auditId', CAST(NULL AS STRING),
          'trigger', 'ASSET_INDICATORS_CHANGED', 'assessmentType', CAST(NULL AS STRING), 'providerId', CAST(NULL AS STRING),
          'declaredFindingStatus', CAST(NULL AS STRUCT<subState: STRING>), 'userId', 'u2'))))))))"""


def bodies(spark: SparkSession, sf: str) -> DataFrame:
    """One document per finding, as JSON text with the file name it would have."""
    small_methods(spark)
    rows = first_per_key(
        lens(spark, sf, "details"), ["findingId"], [F.col(name).desc_nulls_last() for name in DETAIL_COLUMNS])
    return rows.select(F.concat(F.lit("findings/"), "findingId", F.lit(".json")).alias("source"), F.expr(_BODY).alias("body"))


def read_documents(spark: SparkSession, sf: str, *parts: str) -> DataFrame:
    """The documents with those parts of the walk that a query goes on with."""
    return documents.valid_documents(bodies(spark, sf), parts=parts)


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return details.normalize_details(read_documents(spark, sf, "texts"), "https://app.example", "N1")


def entries(spark: SparkSession, sf: str, *parts: str) -> DataFrame:
    return evidence.scanner_entries(read_documents(spark, sf, *parts))


def _docs(body: str) -> str:
    return oracle(body, "details", extra={"docs": DOCS_SQL})


@query("envelope_validity", """
SELECT CASE event_id % 6 WHEN 0 THEN 'valid' ELSE 'invalid' END AS verdict, count(*) AS documents FROM events GROUP BY 1
""")
def _(spark, sf):
    k = F.col("event_id") % 6
    body = (F.when(k == 0, F.concat(F.lit('{"findingId":"f","data":'), "props", F.lit("}")))
            .when(k == 1, F.concat(F.lit('{"findingId":"f","data":'), "props"))
            .when(k == 2, F.lit('{"findingId":"f","data":[1]}')).when(k == 3, F.lit('{"data":{"findingId":"x"}}'))
            .when(k == 4, F.lit('{"findingId":"","data":{}}')).otherwise(F.lit("")))
    checked = documents.envelopes(read(spark, sf, "events").select(body.alias("body")))
    return checked.groupBy(F.when(F.col("valid"), "valid").otherwise("invalid").alias("verdict")).agg(
        F.count(F.lit(1)).alias("documents"))


@query("leaf_paths", """
SELECT 'data.k' AS shape, 'number' AS kind, count(*) AS populated FROM events WHERE json_extract_string(props, '$.k') <> ''
""")
def _(spark, sf):
    events = read(spark, sf, "events").withColumn("doc", F.try_parse_json("props"))
    return profile.path_inventory(documents.leaves(events, F.col("doc"), ["event_id"]))


@query("document_leaf_paths", _docs("""
SELECT shape, CAST(n AS BIGINT) AS populated FROM (
  SELECT 'data.findingId' AS shape, count(*) AS n FROM docs
  UNION ALL SELECT 'data.assetId', count(assetId) FROM docs
  UNION ALL SELECT 'data.data.name', count(findingName) FROM docs
  UNION ALL SELECT 'data.data.searchFinding.mitreAttackTtps[]', 2 * count(*) FROM docs
  UNION ALL SELECT 'data.data.assessmentsRelated.activeFindingProviderInfos[].providerId',
                   count(providerId) + count(filePath) FROM docs
  UNION ALL SELECT 'data.data.assessmentsRelated.activeFindingProviderInfos[].technicalDetails.components[].package',
                   count(component) FROM docs
  UNION ALL SELECT 'data.data.assessmentsRelated.activeFindingProviderInfos[].sharedDetailsLocal.i18n.zz.more.text',
                   count(secondFilePath) FROM docs) WHERE n > 0
"""))
def _(spark, sf):
    wanted = [
        "data.findingId", "data.assetId", "data.data.name", "data.data.searchFinding.mitreAttackTtps[]",
        "data.data.assessmentsRelated.activeFindingProviderInfos[].providerId",
        "data.data.assessmentsRelated.activeFindingProviderInfos[].technicalDetails.components[].package",
        "data.data.assessmentsRelated.activeFindingProviderInfos[].sharedDetailsLocal.i18n.zz.more.text",
    ]
    docs = documents.parsed(bodies(spark, sf))
    found = profile.path_inventory(documents.leaves(docs, F.col("doc"), ["source"], text=F.col("body")))
    return found.where(F.col("shape").isin(wanted)).groupBy("shape").agg(F.sum("populated").alias("populated"))


@query("document_leaf_paths_recursive", _docs("""
SELECT CAST(2 * count(*) AS BIGINT) AS techniques, count(component) AS packages FROM docs
"""))
def _(spark, sf):
    docs = documents.parsed(bodies(spark, sf))
    found = documents.leaves(docs, F.col("doc"), ["source"], text=F.col("body"))
    return found.agg(
        F.count_if(F.col("path").contains(".mitreAttackTtps[")).alias("techniques"),
        F.count_if(F.col("key") == "package").alias("packages"))


# Documents of one to forty levels; every path of every document, leaf or not.
@query("deep_documents", """
WITH RECURSIVE e AS (SELECT event_id, CAST(1 + event_id % 40 AS INT) AS deep, event_type FROM events),
w AS (SELECT event_id, deep, event_type, 0 AS level, 'data' AS path FROM e
      UNION ALL SELECT event_id, deep, event_type, level + 1, path || CASE WHEN level % 2 = 0 THEN '.k' ELSE '[0]' END FROM w WHERE level < deep)
SELECT path, CASE WHEN level = deep THEN 'leaf' WHEN level % 2 = 0 THEN 'object' ELSE 'array' END AS kind, count(*) AS documents,
  max(CASE WHEN level = deep THEN event_type END) AS value FROM w GROUP BY 1, 2""")
def _(spark, sf):
    pairs = F.floor((1 + F.col("event_id") % 40) / 2).cast("int")
    odd = (1 + F.col("event_id") % 40) % 2 == 1
    inner = F.concat(F.lit('"'), "event_type", F.lit('"'))
    body = F.concat(F.repeat(F.lit('{"k":['), pairs), F.when(odd, F.concat(F.lit('{"k":'), inner, F.lit("}"))).otherwise(inner),
                    F.repeat(F.lit("]}"), pairs))
    docs = read(spark, sf, "events").select("event_id", F.try_parse_json(body).alias("doc"))
    value = F.col("v")
    kind = F.when(json_text.is_object(value), "object").when(json_text.is_nested(value), "array").otherwise("leaf")
    found = documents.fields(docs, F.col("doc"), ["event_id"])
    return found.groupBy("path", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("documents"), F.max(F.when(kind == "leaf", F.try_variant_get(value, "$", "string"))).alias("value"))


@query("document_cves", _docs("""
SELECT DISTINCT * FROM (SELECT 'findings/' || findingId || '.json' AS source,
  unnest([firstCve, secondCve, 'CVE-1999-0001']) AS cve FROM docs) WHERE cve IS NOT NULL"""))
def _(spark, sf):
    docs = documents.parsed(bodies(spark, sf))
    strings = documents.leaves(docs, F.col("doc"), ["source"], text=F.col("body")).where("kind = 'string'")
    return strings.select("source", F.explode(text.cve_words(F.col("value"))).alias("cve")).distinct()


@query("document_redaction", """
SELECT event_id, 'data.token' AS path, '***REDACTED***' AS value FROM events
UNION ALL SELECT event_id, 'data.inner.Password', '***REDACTED***' FROM events
UNION ALL SELECT event_id, 'data.inner.k', json_extract_string(props, '$.k') FROM events
""")
def _(spark, sf):
    body = F.concat(F.lit('{"token":"abc","inner":{"Password":["x"],"k":'),
                    F.get_json_object("props", "$.k"), F.lit("}}"))
    docs = read(spark, sf, "events").withColumn("doc", F.try_parse_json(body))
    return profile.redacted_leaves(documents.leaves(docs, F.col("doc"), ["event_id"]), ["event_id"])


@query("finding_details", _docs(r"""
SELECT findingId, assetId, hostname, findingName, 'OPEN' AS status, providerId, cvssScore, epssScore AS environmentalScore,
  coalesce(hyScoreV2, 1.0) AS hyScoreV2, epssScore, CASE WHEN secondCve IS NULL THEN '3.1' END AS cvssVersion,
  CASE WHEN secondCve IS NULL THEN 'CVSS:3.1/AV:N/AC:H/PR:N/UI:N/S:C/C:H/I:H/A:L' END AS cvssVector, cisaKev,
  '[' || concat_ws(',', '"' || firstCve || '"', '"' || secondCve || '"') || ']' AS cvesJson,
  CASE WHEN component IS NULL THEN 'Finding ' || findingId
       ELSE 'Qualys VM details for "' || component || '" (QID ' || replace(findingId, '-', '') || ')' END AS providerEvidenceTitle,
  '[' || concat_ws(',', '"' || secondFilePath || '"', CASE WHEN detectedVersion IS NOT NULL THEN '"' || filePath || '"' END) || ']' AS filePathsJson,
  '[' || coalesce(CASE WHEN expectedVersion IS NOT NULL THEN '"' || replace(registryPath, '\', '\\') || '"' END, '') || ']' AS registryPathsJson,
  '[' || coalesce(CASE WHEN filePath IS NOT NULL THEN '"' || detectedVersion || '"' END, '') || ']' AS detectedVersionsJson,
  '[' || coalesce(CASE WHEN registryPath IS NOT NULL THEN '"' || expectedVersion || '"' END, '') || ']' AS expectedVersionsJson,
  CASE WHEN providerId = 'QUALYS_VM' THEN '"' || component || '"' END AS vulnerableSoftwareJson, remediation, firstSeen,
  lastSeen, 'https://app.example/N1/assets/live-report/' || assetId || '/vuln-management/findings/finding/' || findingId
  || '/history' AS historyUrl, extractedAt
FROM docs"""))
def _(spark, sf):
    flat = details.flat_details(normalized(spark, sf))
    return flat.select(
        "findingId", "assetId", "hostname", "findingName", "status", "providerId", "cvssScore", "environmentalScore",
        "hyScoreV2", "epssScore", "cvssVersion", "cvssVector", "cisaKev", "cvesJson", "providerEvidenceTitle",
        "filePathsJson", "registryPathsJson", "detectedVersionsJson", "expectedVersionsJson", "vulnerableSoftwareJson",
        "remediation", "firstSeen", "lastSeen", "historyUrl", "extractedAt")


@query("finding_cve_details", _docs("""
SELECT findingId, assetId, firstCve AS cve, 'First' AS description FROM docs WHERE firstCve IS NOT NULL
UNION ALL SELECT findingId, assetId, secondCve, NULL FROM docs WHERE secondCve IS NOT NULL"""))
def _(spark, sf):
    return details.cve_rows(normalized(spark, sf))


@query("finding_references", _docs("""
SELECT findingId, firstCve AS cve, 'NVD' AS referenceName, 'https://example.test/' || firstCve AS referenceUrl
FROM docs WHERE firstCve IS NOT NULL
UNION ALL SELECT findingId, firstCve, NULL, 'plain' FROM docs WHERE firstCve IS NOT NULL"""))
def _(spark, sf):
    return details.cve_reference_rows(normalized(spark, sf))


@query("finding_paths", _docs("""
SELECT findingId, assetId, 'FILE' AS pathType, secondFilePath AS path, providerId FROM docs WHERE secondFilePath IS NOT NULL
UNION ALL SELECT findingId, assetId, 'FILE', filePath, providerId FROM docs WHERE filePath IS NOT NULL AND detectedVersion IS NOT NULL
UNION ALL SELECT findingId, assetId, 'REGISTRY', registryPath, providerId FROM docs
  WHERE registryPath IS NOT NULL AND expectedVersion IS NOT NULL"""))
def _(spark, sf):
    return details.path_rows(normalized(spark, sf))


@query("finding_versions", _docs("""
SELECT findingId, assetId, CASE WHEN providerId = 'QUALYS_VM' THEN component END AS component,
  CASE WHEN filePath IS NOT NULL THEN detectedVersion END AS detectedVersion,
  CASE WHEN registryPath IS NOT NULL THEN expectedVersion END AS expectedVersion
FROM docs WHERE (filePath IS NOT NULL AND detectedVersion IS NOT NULL) OR (registryPath IS NOT NULL AND expectedVersion IS NOT NULL)"""))
def _(spark, sf):
    return details.version_rows(normalized(spark, sf)).drop("sourceText")


@query("finding_providers", _docs("""
SELECT findingId, assetId, providerId, 'a-' || findingId AS assessmentId, 'SCAN' AS assessmentType,
  'Assessment' AS assessmentName, firstSeen AS firstDetection, cvssScore AS baseScore, epssScore AS environmentalScore,
  '/findings/' || findingId AS sourceEndpoint, extractedAt FROM docs
UNION ALL SELECT findingId, assetId, 'NESSUS', 'b-' || findingId, NULL, NULL, firstSeen + INTERVAL 10 DAY, 1.5, NULL,
  '/findings/' || findingId, extractedAt FROM docs WHERE filePath IS NOT NULL"""))
def _(spark, sf):
    return details.provider_rows(read_documents(spark, sf, "raw")).drop(
        "temporalScore", "hyScoreV2", "cvssVersion", "rawProviderJson")


@query("finding_scanner_references", _docs("""
SELECT findingId, assetId, providerId, 'a-' || findingId AS assessmentId, 'QID' AS referenceType,
  CAST(CAST(replace(findingId, '-', '') AS BIGINT) AS STRING) AS referenceValue, 'activeFindingProviderInfos[0].extendedAttributesList['
  || CAST(CAST(firstCve IS NOT NULL AS INT) + CAST(secondCve IS NOT NULL AS INT) AS STRING) || '].qid' AS sourcePath FROM docs
UNION ALL SELECT findingId, assetId, providerId, 'a-' || findingId, 'PLUGIN_ID', 'p' || findingId,
  'activeFindingProviderInfos[0].extendedAttributesList['
  || CAST(CAST(firstCve IS NOT NULL AS INT) + CAST(secondCve IS NOT NULL AS INT) AS STRING) || '].plugin-id' FROM docs
UNION ALL SELECT findingId, assetId, 'NESSUS', 'b-' || findingId, 'RULE_ID', 'R1',
  'activeFindingProviderInfos[1].extendedAttributesList[1].rule_id' FROM docs WHERE filePath IS NOT NULL"""))
def _(spark, sf):
    return evidence.scanner_reference_rows(entries(spark, sf, "ids"))


SCANNER_SQL = """CASE providerId WHEN 'QUALYS_VM' THEN 'Qualys VM' WHEN 'crowdstrike' THEN 'CrowdStrike Falcon'
  WHEN 'Azure' THEN 'Microsoft Azure' ELSE coalesce(providerId, 'UNKNOWN') END"""
_CMP_A = """'cmp-' || substr(sha256(coalesce(assetId, '') || '|' || lower(component) || '|' || coalesce(detectedVersion, '')), 1, 16)"""
_CMP_B = "'cmp-' || substr(sha256(coalesce(assetId, '') || '|' || lower(component) || '|'), 1, 16)"


@query("finding_components", _docs(f"""
SELECT findingId, coalesce(assetId, '') AS assetId, hostname, {_CMP_A} AS componentId, {SCANNER_SQL} AS scanner,
  component AS package, NULL AS product, NULL AS language, detectedVersion AS installedVersion, NULL AS requiredVersion,
  secondFilePath AS installPath, '[{{"type":"PLUGIN_ID","value":"p' || findingId || '"}},{{"type":"QID","value":"'
  || CAST(CAST(replace(findingId, '-', '') AS BIGINT) AS STRING) || '"}}]' AS scannerReferencesJson,
  'activeProviderInfos.' || coalesce(providerId, 'None') || '.technicalDetails.components[1]' AS sourcePath,
  'findings/' || findingId || '.json' AS sourcePayloadReference, extractedAt AS retrievedAt
FROM docs WHERE component IS NOT NULL
UNION ALL SELECT findingId, coalesce(assetId, ''), hostname, {_CMP_B}, 'NESSUS', NULL, component, NULL, NULL, expectedVersion,
  NULL, '[{{"type":"RULE_ID","value":"R1"}}]', 'activeProviderInfos.NESSUS.details', 'findings/' || findingId || '.json', extractedAt
FROM docs WHERE component IS NOT NULL AND filePath IS NOT NULL"""))
def _(spark, sf):
    return evidence.component_rows(evidence.candidates(entries(spark, sf, "hash", "ids", "sources"))).drop("component", "vendor", "ecosystem", "sourceHash")


def _occ(component: str, path: str) -> str:
    return f"'occ-' || substr(sha256({component} || '|' || {path}), 1, 16)"


def _loose(path: str) -> str:
    return f"'occ-' || substr(sha256(coalesce(assetId, '') || '|' || findingId || '|unassigned|' || {path}), 1, 16)"


OCCURRENCES_SQL = f"""
SELECT findingId, {_CMP_A} AS componentId, {_occ(_CMP_A, 'filePath')} AS occurrenceId, {SCANNER_SQL} AS scanner,
  component AS package, detectedVersion AS installedVersion, expectedVersion AS requiredVersion, filePath AS installPath
FROM docs WHERE component IS NOT NULL AND filePath IS NOT NULL AND detectedVersion IS NOT NULL
UNION ALL SELECT findingId, {_CMP_A}, {_occ(_CMP_A, 'secondFilePath')}, {SCANNER_SQL}, component, detectedVersion, NULL, secondFilePath
FROM docs WHERE component IS NOT NULL AND secondFilePath IS NOT NULL
UNION ALL SELECT findingId, NULL, {_loose("'/srv/' || findingId")}, {SCANNER_SQL}, NULL, NULL, NULL, '/srv/' || findingId FROM docs
UNION ALL SELECT findingId, {_CMP_B}, {_occ(_CMP_B, 'path')}, 'NESSUS', NULL, NULL, expectedVersion, path
FROM (SELECT *, unnest([filePath, '/b/x']) AS path FROM docs WHERE component IS NOT NULL AND filePath IS NOT NULL)
UNION ALL SELECT findingId, NULL, {_loose('path')}, 'NESSUS', NULL, NULL, NULL, path
FROM (SELECT *, unnest([filePath, '/b/x']) AS path FROM docs WHERE component IS NULL AND filePath IS NOT NULL)"""


@query("finding_occurrences", _docs(OCCURRENCES_SQL))
def _(spark, sf):
    return evidence.occurrence_rows(evidence.candidates(entries(spark, sf, "hash", "ids", "sources"))).select(
        "findingId", "componentId", "occurrenceId", "scanner", "package", "installedVersion", "requiredVersion", "installPath")


EVENTS_SQL = f"""
SELECT findingId, firstSeen AS eventTimestamp, 'evt-' || findingId AS eventId, 'FINDING_CREATED' AS eventType,
  'HUMAN__NEW_ASSESSMENT' AS eventLabel, 'VULNERABILITY_SCAN' AS eventSource, 'CONFIRMED' AS newStatus, 'u1' AS actor,
  {SCANNER_SQL} AS scanner FROM docs
UNION ALL SELECT findingId, lastSeen, substr(sha256(findingId || '|' || coalesce(strftime(lastSeen, '%Y-%m-%dT%H:%M:%SZ'), 'None')
  || '|ASSET_INDICATORS_CHANGED'), 1, 16), 'ASSET_INDICATORS_CHANGED', 'ASSET_INDICATORS_CHANGED', NULL, NULL, 'u2', 'UNKNOWN' FROM docs"""


@query("finding_events", _docs(EVENTS_SQL))
def _(spark, sf):
    return evidence.event_rows(documents.parsed(bodies(spark, sf))).drop("assetId", "hostname", "previousStatus", "rawEventReference")


@query("evidence_diagnostics", _docs("""
SELECT measure, CAST(value AS BIGINT) AS value FROM (
  SELECT 'findings' AS measure, count(*) AS value FROM docs
  UNION ALL SELECT 'components', count(component) + count(CASE WHEN filePath IS NOT NULL THEN component END) FROM docs
  UNION ALL SELECT 'versions', count(CASE WHEN component IS NOT NULL THEN detectedVersion END)
    + count(CASE WHEN component IS NOT NULL AND filePath IS NOT NULL THEN expectedVersion END) FROM docs
  UNION ALL SELECT 'paths', count(*) + count(CASE WHEN component IS NOT NULL THEN filePath END)
    + count(CASE WHEN component IS NOT NULL THEN secondFilePath END) + 2 * count(filePath)
    - count(CASE WHEN component IS NOT NULL AND detectedVersion IS NULL THEN filePath END) FROM docs
  UNION ALL SELECT 'scannerReferences', 2 * count(*) + count(filePath) FROM docs
  UNION ALL SELECT 'historyEvents', 2 * count(*) FROM docs)"""))
def _(spark, sf):
    return evidence.diagnostics(read_documents(spark, sf, "hash", "ids", "sources"))


@query("primary_provider", """
SELECT l_orderkey, l_suppkey, provider, texts FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY coalesce(provider = 'QUALYS_VM', false) DESC, CASE WHEN provider = 'QUALYS_VM' THEN 0 ELSE texts END DESC, place) AS rn
  FROM (SELECT l_orderkey, l_suppkey, CAST(l_quantity AS BIGINT) AS texts, CAST(l_linenumber AS BIGINT) * 1000000000 + CAST(l_extendedprice * 100 AS BIGINT) AS place,
    CASE l_suppkey % 5 WHEN 0 THEN 'QUALYS_VM' WHEN 1 THEN 'NESSUS' WHEN 2 THEN 'crowdstrike' END AS provider FROM lineitem)) WHERE rn = 1
""")
def _(spark, sf):
    entries = read(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_suppkey", "CAST(l_quantity AS BIGINT) AS texts",
        "CAST(l_linenumber AS BIGINT) * 1000000000 + CAST(l_extendedprice * 100 AS BIGINT) AS place",
        "CASE l_suppkey % 5 WHEN 0 THEN 'QUALYS_VM' WHEN 1 THEN 'NESSUS' WHEN 2 THEN 'crowdstrike' END AS provider")
    return details.primary_entries(entries, "l_orderkey", "provider", "texts", "place").drop("place")


@query("name_lists", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'k' WHEN 1 THEN event_type || ',7' WHEN 2 THEN event_type WHEN 3 THEN 'n,i' ELSE '' END AS names
FROM events
""")
def _(spark, sf):
    k = F.col("event_id") % 5
    quoted = F.concat(F.lit('"'), "event_type", F.lit('"'))
    body = (F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("["), quoted, F.lit(",null,7]")))
            .when(k == 2, quoted).when(k == 3, F.lit('[{"name":"n","id":"x"},{"value":"","id":"i"},{"other":1}]')))
    return read(spark, sf, "events").select(
        "event_id", F.array_join(json_text.names_of(F.try_parse_json(body)), ",").alias("names"))


@query("field_profile", """
SELECT 'findingId' AS path, 'string' AS kind, count(*) AS n, false AS nested FROM events
UNION ALL SELECT 'data', 'object', count(*), false FROM events
UNION ALL SELECT 'data.k', 'number', count(*), true FROM events
UNION ALL SELECT 'ip', 'null', count(*), false FROM events
""")
def _(spark, sf):
    return _event_types(spark, sf).select("path", "kind", "n", "nested")


def _event_types(spark: SparkSession, sf: str) -> DataFrame:
    body = F.concat(F.lit('{"findingId":"f","ip":null,"data":'), "props", F.lit("}"))
    docs = read(spark, sf, "events").withColumn("doc", F.try_parse_json(body))
    return profile.field_types(docs, F.col("doc"), ["event_id"])


@query("field_report", """
SELECT 'findingId' AS path, false AS "entirelyNull", count(*) AS n, '' AS terms FROM events
UNION ALL SELECT 'data', false, count(*), '' FROM events UNION ALL SELECT 'data.k', false, count(*), '' FROM events
UNION ALL SELECT 'ip', true, count(*), 'ip' FROM events
""")
def _(spark, sf):
    return profile.schema_report(_event_types(spark, sf))


@query("missing_concepts", """
SELECT unnest(['CVE', 'CVSS', 'remediation', 'description', 'provider', 'OS', 'port', 'protocol', 'dates']) AS concept
FROM (SELECT 1 FROM events LIMIT 1)
""")
def _(spark, sf):
    return profile.missing_concepts(_event_types(spark, sf))
