"""Named queries: the column functions, each over a whole driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.functions import dates, evidence_text, json_text, nulls, scoring, text
from palisade.plans.lens import AS_OF, lens, oracle, read
from palisade.plans.registry import query

c = F.col


@query("dotted_path", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k.deeper') AS missing FROM events
""")
def _(spark, sf):
    events = read(spark, sf, "events").withColumn("doc", F.try_parse_json("props"))
    return events.select("event_id", json_text.at(c("doc"), "k", "bigint").alias("k"),
                         json_text.at(c("doc"), "k.deeper").alias("missing"))


@query("first_present", oracle("""
SELECT findingId, coalesce(nullif(severity, ''), nullif(service, ''), nullif(status, ''), 'none') AS label,
       count(*) AS copies
FROM search GROUP BY ALL""", "search"))
def _(spark, sf):
    label = nulls.first_present(c("severity"), c("service"), c("status"), F.lit("none"))
    return lens(spark, sf, "search").groupBy("findingId", label.alias("label")).agg(F.count(F.lit(1)).alias("copies"))


@query("canonical_json", oracle("""
SELECT DISTINCT findingId, CAST(json_object('cve', cve, 'findingId', findingId, 'port', port, 'provider', provider)
       AS VARCHAR) AS body FROM search""", "search"))
def _(spark, sf):
    body = json_text.canonical(provider=c("provider"), port=c("port"), findingId=c("findingId"), cve=c("cve"))
    return lens(spark, sf, "search").select("findingId", body.alias("body")).distinct()


_STAMPED = """SELECT event_id, ts, CASE event_id % 5
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 3 THEN 'not a date' END AS stamp FROM events"""


@query("timestamp_text", f"""
WITH s AS ({_STAMPED}) SELECT event_id, CASE event_id % 5 WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
    WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE date_trunc('second', ts) END AS observedAt,
    CASE event_id % 5 WHEN 1 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || 'Z'
    WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS isoText FROM s
""")
def _(spark, sf):
    shown = dates.iso_seconds(c("ts"))
    kind = c("event_id") % 5
    stamp = (F.when(kind == 0, F.concat(shown, F.lit("Z"))).when(kind == 1, F.concat(shown, F.lit("+02:00")))
             .when(kind == 2, shown).when(kind == 3, "not a date"))
    parsed = dates.parse_timestamp(stamp)
    return read(spark, sf, "events").select(
        "event_id", parsed.alias("observedAt"), dates.iso_utc(parsed).alias("isoText"))


_LOOSE = """CASE l_linenumber WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || '.0'
    ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END"""
_FLAG = """CASE l_linenumber WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'no' WHEN 3 THEN '1' WHEN 4 THEN 'maybe' END"""


@query("safe_coercion", f"""
SELECT l_linenumber, {_LOOSE} AS raw, CASE WHEN l_linenumber > 2 THEN l_quantity END AS asDouble,
       CASE WHEN l_linenumber > 3 THEN CAST(l_quantity AS BIGINT) END AS asBigint,
       CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN 'false' WHEN 3 THEN 'true' END AS asBoolean,
       count(*) AS n
FROM lineitem GROUP BY ALL
""")
def _(spark, sf):
    raw, flag = F.expr(_LOOSE), F.expr(_FLAG)
    return read(spark, sf, "lineitem").groupBy(
        "l_linenumber", raw.alias("raw"), nulls.to_double(raw).alias("asDouble"),
        nulls.to_bigint(raw).alias("asBigint"), nulls.to_boolean(flag).cast("string").alias("asBoolean"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("stable_keys", oracle("""
SELECT findingId, substr(sha256(lower(trim(coalesce(remediation, '')))), 1, 24) AS textKey,
       substr(sha256(concat_ws('|', coalesce(remediation, ''), coalesce(provider, ''), coalesce(findingName, ''),
              coalesce(cve, ''), coalesce(service, ''))), 1, 24) AS compositeKey, count(*) AS copies
FROM search GROUP BY ALL""", "search"))
def _(spark, sf):
    return lens(spark, sf, "search").groupBy(
        "findingId", text.stable_key(c("remediation")).alias("textKey"),
        text.composite_key(c("remediation"), c("provider"), c("findingName"), c("cve"), c("service"))
        .alias("compositeKey"),
    ).agg(F.count(F.lit(1)).alias("copies"))


@query("distinct_trimmed", """
SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_name || '/' || p_brand
       ELSE p_name || '/' || p_brand || '/' || p_type END AS words FROM part
""")
def _(spark, sf):
    words = text.distinct_trimmed(F.array(
        F.concat(F.lit("  "), "p_name"), F.lit(" "), c("p_brand"), c("p_name"), F.concat("p_type", F.lit(" ")),
        c("p_brand"), F.lit(None).cast("string")))
    return read(spark, sf, "part").select("p_partkey", F.array_join(words, "/").alias("words"))


@query("cvss_vectors", """
SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 5 THEN 'CVSS:3.1/AV:N/AC:' || l_returnflag || '/PR:N/UI:'
       || l_linestatus || '/S:U/C:H/I:L/A:N' END AS vector FROM lineitem
""")
def _(spark, sf):
    metrics = {"AV": F.lit("N"), "AC": c("l_returnflag"), "PR": F.lit("N"), "UI": c("l_linestatus"), "S": F.lit("U"),
               "C": F.when(c("l_linenumber") == 5, "").otherwise("H"), "I": F.lit("L"), "A": F.lit("N")}
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.cvss_vector(metrics).alias("vector")).distinct()


@query("history_urls", oracle("""
SELECT DISTINCT findingId, 'https://app.example/N1/assets/live-report/' || assetId
       || '/vuln-management/findings/finding/' || findingId || '/history' AS url FROM details""", "details"))
def _(spark, sf):
    return lens(spark, sf, "details").select(
        "findingId", text.history_url("https://app.example/", "N1", c("assetId"), c("findingId")).alias("url")
    ).distinct()


# A scanner text made of the detail columns, so that what is read back is known.
_EVIDENCE = """concat_ws('\\n', 'Qualys VM details for "' || component || '" (QID ' || findingId || ')',
    registryPath || ' LastProduct = ' || expectedVersion, registryPath || ' Version is ' || detectedVersion,
    filePath || ' Version is ' || detectedVersion, 'Required version: ' || expectedVersion, secondFilePath)"""


@query("evidence_patterns", oracle("""
SELECT DISTINCT findingId, providerId, coalesce(CASE WHEN expectedVersion IS NOT NULL OR detectedVersion IS NOT NULL
              THEN registryPath END, '') AS registry,
       coalesce(concat_ws(';', CASE WHEN detectedVersion IS NOT NULL THEN filePath END,
              CASE WHEN secondFilePath <> coalesce(CASE WHEN detectedVersion IS NOT NULL THEN filePath END, '')
                   THEN secondFilePath END), '') AS files,
       coalesce(CASE WHEN registryPath IS NOT NULL OR filePath IS NOT NULL THEN detectedVersion END, '') AS detected,
       coalesce(expectedVersion, '') AS expected,
       CASE WHEN providerId = 'QUALYS_VM' THEN component END AS title,
       CASE WHEN component IS NOT NULL THEN split_part(findingId, '-', 1) END AS qid
FROM details""", "details"))
def _(spark, sf):
    body, provider = c("body"), c("providerId")
    rows = lens(spark, sf, "details").withColumn("body", F.expr(_EVIDENCE))
    return rows.select(
        "findingId", "providerId",
        F.array_join(evidence_text.registry_paths(body), ";").alias("registry"),
        F.array_join(evidence_text.file_paths(body), ";").alias("files"),
        F.array_join(evidence_text.detected_versions(body), ";").alias("detected"),
        F.array_join(evidence_text.expected_versions(body, provider), ";").alias("expected"),
        evidence_text.quoted_component(body, provider).alias("title"),
        evidence_text.qid(body).alias("qid"),
    ).distinct()


@query("document_versions", r"""
SELECT doc_id, array_to_string(list_distinct(regexp_extract_all(text,
         '(?i)\b(?:version\s+(?:is|=)?|installed(?:\s+version)?\s*[:=])\s*([0-9][\w.+~-]*(?:\.[\w.+~-]+)+)', 1)), ';')
         AS detected,
       len(regexp_extract_all(text, '(?im)(/(?:usr|opt|etc|var|lib|home)/[^\s,;]+)', 1)) > 0 AS hasPath
FROM documents
""")
def _(spark, sf):
    return read(spark, sf, "documents").select(
        "doc_id", F.array_join(evidence_text.detected_versions(c("text")), ";").alias("detected"),
        (F.size(evidence_text.file_paths(c("text"))) > 0).alias("hasPath"))


@query("hostnames", oracle("""
SELECT assetId, rtrim(lower(trim(hostname)), '.') AS fqdn, split_part(rtrim(lower(trim(hostname)), '.'), '.', 1) AS short
FROM assets""", "assets"))
def _(spark, sf):
    return lens(spark, sf, "assets").select(
        "assetId", text.normalize_hostname(c("hostname")).alias("fqdn"),
        text.short_hostname(c("hostname")).alias("short"))


@query("hostname_match", oracle("""
SELECT assetId, split_part(rtrim(lower(trim(hostname)), '.'), '.', 1) = 'customer-000000011'
       OR lower(country) = 'customer-000000011' AS byShort,
       rtrim(lower(trim(hostname)), '.') = 'customer-000000011.nation_3.example' AS byFqdn
FROM assets""", "assets"))
def _(spark, sf):
    names = [c("hostname"), c("country"), F.lit(None).cast("string")]
    return lens(spark, sf, "assets").select(
        "assetId", text.hostname_matches(names, " CUSTOMER-000000011 ").alias("byShort"),
        text.hostname_matches(names, "Customer-000000011.NATION_3.example.").alias("byFqdn"))


@query("cve_and_scanner_names", oracle(r"""
SELECT DISTINCT findingId, CASE WHEN regexp_matches(upper(trim(cve)), '^CVE-\d{4}-\d{4,}$') THEN upper(trim(cve)) END AS cve,
       CASE provider WHEN 'QUALYS_VM' THEN 'Qualys VM' WHEN 'crowdstrike' THEN 'CrowdStrike Falcon'
            WHEN 'Azure' THEN 'Microsoft Azure' ELSE coalesce(provider, 'UNKNOWN') END AS scanner
FROM search""", "search"))
def _(spark, sf):
    return lens(spark, sf, "search").select(
        "findingId", text.normalize_cve(c("cve")).alias("cve"), text.normalize_scanner(c("provider")).alias("scanner")
    ).distinct()


_BAND_SQL = """CASE WHEN coalesce(hyScoreV2, 0) >= 900 OR coalesce(cvssScore, 0) >= 9 THEN 'CRITICAL'
  WHEN coalesce(hyScoreV2, 0) >= 700 OR coalesce(cvssScore, 0) >= 7 THEN 'HIGH'
  WHEN coalesce(hyScoreV2, 0) >= 400 OR coalesce(cvssScore, 0) >= 4 THEN 'MEDIUM' ELSE 'LOW' END"""


@query("severity_rules", oracle(f"""
SELECT findingId, CASE WHEN upper(trim(severity)) IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'INFO') THEN upper(trim(severity))
            ELSE {_BAND_SQL} END AS trusted,
       CASE WHEN severity <> '' THEN upper(severity) ELSE {_BAND_SQL} END AS shown, {_BAND_SQL} AS scored, count(*) AS n
FROM search GROUP BY ALL""", "search"))
def _(spark, sf):
    trs, cvss, nothing = c("hyScoreV2"), c("cvssScore"), F.lit(None).cast("string")
    return lens(spark, sf, "search").groupBy(
        "findingId", scoring.severity(c("severity"), trs, cvss).alias("trusted"),
        scoring.severity_any_source(c("severity"), trs, cvss).alias("shown"),
        scoring.severity(nothing, trs, cvss).alias("scored"),
    ).agg(F.count(F.lit(1)).alias("n"))


_AGE_SQL = f"greatest(0, CAST(floor(date_diff('second', firstSeen, TIMESTAMP '{AS_OF}') / 86400) AS BIGINT))"


def _priority_sql(kev: str, age: str) -> str:
    return f"""CASE WHEN {kev} OR coalesce(hyScoreV2, 0) >= 900 OR coalesce(cvssScore, 0) >= 9 THEN 'P1'
      WHEN coalesce(hyScoreV2, 0) >= 700 OR coalesce(cvssScore, 0) >= 7 OR {age} THEN 'P2' ELSE 'P3' END"""


PRIORITY_SCORE_SQL = """CAST(least(100, round_even(coalesce(hyScoreV2, 0) / 10 * 0.5 + coalesce(cvssScore, 0) * 10 * 0.3
      + least(coalesce({age}, 0), 365) / 365 * 10 + CASE WHEN {kev} THEN 10 ELSE 0 END, 0)) AS INTEGER)"""


@query("priority_rules", oracle(f"""
SELECT findingId, {_priority_sql('false', 'false')} AS byScore, {_priority_sql('cisaKev', 'false')} AS byScoreAndKev,
       {_priority_sql('cisaKev', f'{_AGE_SQL} >= 180')} AS byScoreKevAndAge, {_AGE_SQL} AS ageDays,
       {PRIORITY_SCORE_SQL.format(age=_AGE_SQL, kev='cisaKev')} AS priorityScore,
       CASE {_priority_sql('cisaKev', f'{_AGE_SQL} >= 180')} WHEN 'P1' THEN 7 WHEN 'P2' THEN 30 ELSE 90 END AS dueInDays,
       count(*) AS n
FROM search GROUP BY ALL""", "search"))
def _(spark, sf):
    trs, cvss, kev = c("hyScoreV2"), c("cvssScore"), c("cisaKev")
    age = dates.age_days(c("firstSeen"), AS_OF)
    full = scoring.priority(trs, cvss, kev, age)
    return lens(spark, sf, "search").groupBy(
        "findingId", scoring.priority(trs, cvss).alias("byScore"),
        scoring.declared_priority(F.lit("none"), trs, cvss, kev).alias("byScoreAndKev"),
        full.alias("byScoreKevAndAge"), age.alias("ageDays"),
        scoring.priority_score(trs, cvss, kev, age).alias("priorityScore"),
        scoring.due_days(full).alias("dueInDays"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("derived_actions", oracle("""
SELECT DISTINCT d.findingId, CASE
  WHEN component IS NOT NULL AND expectedVersion IS NOT NULL
    THEN 'Mettre à jour ' || component || ' vers la version ' || expectedVersion || ', puis valider la disparition du finding.'
  WHEN firstCve IS NOT NULL THEN 'Appliquer le correctif éditeur associé à ' || firstCve
    || ', redémarrer si requis, puis relancer un scan de validation.'
  WHEN filePath IS NOT NULL THEN 'Corriger ou désactiver le service ' || filePath
    || ' s’il n’est pas nécessaire, puis relancer un contrôle.'
  ELSE 'Analyser la preuve du provider, appliquer le correctif recommandé par l’éditeur, puis relancer un scan de validation.'
  END AS action FROM details d""", "details"))
def _(spark, sf):
    return lens(spark, sf, "details").select("findingId", scoring.derived_action(
        c("component"), c("expectedVersion"), c("firstCve"), c("filePath")).alias("action")).distinct()


@query("internet_facing", """
SELECT event_id, event_type IN ('view', 'click') AS facing FROM events
""")
def _(spark, sf):
    key = (F.when(c("event_type") == "view", "net.external_ip").when(c("event_type") == "click", "Internet-zone")
           .otherwise(c("event_type")))
    tags = F.create_map(F.lit("owner"), c("props"), key, F.lit("1"))
    return read(spark, sf, "events").select("event_id", text.internet_facing(tags).alias("facing"))


TRIGGER = """CASE event_id % 10 WHEN 0 THEN 'HUMAN__NEW_ASSESSMENT' WHEN 1 THEN 'ASSET_INDICATORS_CHANGED'
    WHEN 2 THEN 'FINDING_REOPENED' WHEN 3 THEN 'ticket closed' WHEN 4 THEN 'ASSET_SCORE' WHEN 5 THEN 'risk_accepted'
    WHEN 6 THEN 'REMEDIATION_PLAN' WHEN 7 THEN 'threat_intel' WHEN 8 THEN event_type END"""
EVENT_TYPE_SQL = """CASE event_id % 10 WHEN 2 THEN 'FINDING_REOPENED' WHEN 3 THEN 'FINDING_RESOLVED'
    WHEN 0 THEN 'FINDING_CREATED' ELSE CASE WHEN event_type = 'signup' THEN 'FINDING_CONFIRMED'
    ELSE CASE event_id % 10 WHEN 1 THEN 'ASSET_INDICATORS_CHANGED' WHEN 4 THEN 'ASSET_INDICATORS_CHANGED'
      WHEN 5 THEN 'RISK_STATUS_CHANGED' WHEN 6 THEN 'REMEDIATION_UPDATED' WHEN 7 THEN 'FINDING_UPDATED'
      ELSE 'UNKNOWN' END END END"""


@query("event_types", f"SELECT event_id, {EVENT_TYPE_SQL} AS eventType FROM events")
def _(spark, sf):
    status = F.when(c("event_type") == "signup", "confirmed")
    return read(spark, sf, "events").select(
        "event_id", text.event_type(F.expr(TRIGGER), status).alias("eventType"))


@query("labelled_components", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN 'org.' || lower(p_type) || ':' || lower(p_type) END AS package,
       CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS STRING) || '.1' END AS installedVersion,
       CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS STRING) || '.2' END AS requiredVersion,
       CASE WHEN p_size % 3 = 0 THEN '/opt/' || lower(p_type) END AS installPath, p_size % 3 <> 2 AS found
FROM part
""")
def _(spark, sf):
    body = F.expr("""CASE p_size % 3
        WHEN 0 THEN concat('package :  ', p_name, ' \\nInstalled Version: ', p_size, '.1\\nFixed  Version: ', p_size,
                           '.2\\nInstall Path: /opt/', lower(p_type))
        WHEN 1 THEN concat('Advisory for org.', lower(p_type), ':', lower(p_type), ' is out')
        ELSE p_name END""")
    found = evidence_text.labelled_component(body)
    return read(spark, sf, "part").select(
        "p_partkey", found["package"].alias("package"), found["installed_version"].alias("installedVersion"),
        found["required_version"].alias("requiredVersion"), found["install_path"].alias("installPath"),
        found.isNotNull().alias("found"))


@query("content_ids", oracle("""
SELECT DISTINCT findingId, component, 'cmp-' || substr(sha256(concat_ws('|', coalesce(assetId, ''),
         lower(coalesce(component, 'none')), coalesce(detectedVersion, ''))), 1, 16) AS componentId,
       'occ-' || substr(sha256(concat_ws('|', 'cmp-' || substr(sha256(concat_ws('|', coalesce(assetId, ''),
         lower(coalesce(component, 'none')), coalesce(detectedVersion, ''))), 1, 16), filePath)), 1, 16) AS occurrenceId
FROM details WHERE filePath IS NOT NULL""", "details"))
def _(spark, sf):
    from palisade.operators.evidence import component_id, occurrence_id

    cid = component_id(c("assetId"), c("component"), c("detectedVersion"))
    return lens(spark, sf, "details").where("filePath IS NOT NULL").select(
        "findingId", "component", cid.alias("componentId"), occurrence_id(cid, c("filePath")).alias("occurrenceId")
    ).distinct()


@query("action_types", oracle("""
SELECT DISTINCT findingId, CASE WHEN expectedVersion <> '' THEN 'UPGRADE'
  WHEN regexp_matches(lower(coalesce(remediation, '')), 'update|upgrade|patch|kb') THEN 'PATCH'
  WHEN regexp_matches(lower(coalesce(remediation, '')), 'configure|disable') THEN 'CONFIG_CHANGE'
  ELSE 'INVESTIGATE' END AS actionType FROM details""", "details"))
def _(spark, sf):
    return lens(spark, sf, "details").select(
        "findingId", scoring.action_type(c("remediation"), c("expectedVersion")).alias("actionType")).distinct()


@query("redacted_payloads", """
SELECT event_id, '***REDACTED***' AS secretValue, json_extract_string(props, '$.k') AS plainValue FROM events
""")
def _(spark, sf):
    doc = F.from_json("props", "map<string,string>")
    full = F.map_concat(doc, F.create_map(F.lit("API_KEY"), c("props")))
    masked = text.redact_map(full)
    return read(spark, sf, "events").select(
        "event_id", masked["API_KEY"].alias("secretValue"), masked["k"].alias("plainValue"))


@query("json_or_scalar_lists", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'a,' || event_type WHEN 1 THEN event_type WHEN 2 THEN props ELSE '' END AS items
FROM events
""")
def _(spark, sf):
    kind = c("event_id") % 4
    raw = (F.when(kind == 0, F.concat(F.lit('["a","'), "event_type", F.lit('"]'))).when(kind == 1, c("event_type"))
           .when(kind == 2, F.concat(F.lit('"'), F.regexp_replace("props", '"', '\\\\"'), F.lit('"'))))
    return read(spark, sf, "events").select(
        "event_id", F.array_join(json_text.text_list(raw), ",").alias("items"))


@query("shortened_texts", """
SELECT doc_id, CASE WHEN length(text) > 220 THEN substr(text, 1, 220) || '...' ELSE text END AS title,
       CASE WHEN length(text) > 180 THEN substr(text, 1, 179) || '…' ELSE text END AS cell FROM documents
""")
def _(spark, sf):
    return read(spark, sf, "documents").select(
        "doc_id", text.shorten(c("text"), 220).alias("title"), text.shorten(c("text"), 180, "…", 179).alias("cell"))


@query("risk_bands", oracle("""
SELECT findingId, CASE WHEN coalesce(hyScoreV2, 0) >= 900 THEN 'critical' WHEN coalesce(hyScoreV2, 0) >= 700 THEN 'high'
         WHEN coalesce(hyScoreV2, 0) >= 400 THEN 'medium' ELSE 'low' END AS band,
       CASE WHEN coalesce(hyScoreV2, 0) >= 900 THEN 'Critique' WHEN coalesce(hyScoreV2, 0) >= 700 THEN 'Élevé'
         WHEN coalesce(hyScoreV2, 0) >= 400 THEN 'Modéré' ELSE 'Faible' END AS label, count(*) AS n
FROM search GROUP BY ALL""", "search"))
def _(spark, sf):
    return lens(spark, sf, "search").groupBy(
        "findingId", scoring.risk_band(c("hyScoreV2")).alias("band"), scoring.risk_label(c("hyScoreV2")).alias("label"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("split_cves", oracle("""
SELECT DISTINCT findingId, concat_ws(';', firstCve, secondCve) AS cves FROM details""", "details"))
def _(spark, sf):
    mixed = F.concat_ws(", ", F.lit("n/a"), "firstCve", F.lit("GHSA-1"), "secondCve")
    return lens(spark, sf, "details").select(
        "findingId", F.array_join(text.split_cves(mixed), ";").alias("cves")).distinct()


@query("readable_sizes", """
SELECT doc_id, n_chars, CASE
  WHEN n_chars * 37 < 1024 THEN printf('%.0f o', n_chars * 37 * 1.0)
  WHEN n_chars * 37 < 1048576 THEN CASE WHEN n_chars * 37 / 1024 < 10 THEN printf('%.1f Ko', round(n_chars * 37 / 1024, 1))
       ELSE printf('%.0f Ko', round(n_chars * 37 / 1024, 0)) END
  ELSE CASE WHEN n_chars * 37 / 1048576 < 10 THEN printf('%.1f Mo', round(n_chars * 37 / 1048576, 1))
       ELSE printf('%.0f Mo', round(n_chars * 37 / 1048576, 0)) END END AS size FROM documents
""")
def _(spark, sf):
    return read(spark, sf, "documents").select(
        "doc_id", "n_chars", text.readable_size(c("n_chars") * 37).alias("size"))


@query("http_error_types", """
WITH log AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 401 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 502 WHEN 4 THEN 418
  WHEN 5 THEN 504 END AS status FROM events)
SELECT CASE status WHEN 401 THEN 'authentication' WHEN 404 THEN 'not_found' WHEN 429 THEN 'rate_limit'
  WHEN 502 THEN 'bad_gateway' WHEN 504 THEN 'gateway_timeout' WHEN 418 THEN 'http_error' ELSE 'network_error' END AS errorType,
  count(*) AS n FROM log GROUP BY 1
""")
def _(spark, sf):
    status = F.expr("CASE event_id % 7 WHEN 0 THEN 401 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 502 WHEN 4 THEN 418 "
                    "WHEN 5 THEN 504 END")
    return read(spark, sf, "events").groupBy(text.http_error_type(status).alias("errorType")).agg(
        F.count(F.lit(1)).alias("n"))


@query("safe_cells", r"""
SELECT doc_id, substr(CASE WHEN regexp_matches(text, '^[=+\-@]') THEN '''' || text ELSE text END, 1, 32767) AS cell
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '=' || text ELSE text END AS text FROM documents)
""")
def _(spark, sf):
    body = F.when(c("doc_id") % 3 == 0, F.concat(F.lit("="), "text")).otherwise(c("text"))
    return read(spark, sf, "documents").select("doc_id", text.safe_cell(body).alias("cell"))


@query("observation_counts", oracle("""
SELECT findingId, CASE WHEN firstSeen IS NULL AND lastSeen IS NULL THEN 0
  WHEN firstSeen IS NOT NULL AND lastSeen IS NOT NULL AND firstSeen <> lastSeen THEN 2 ELSE 1 END AS observations,
  count(*) AS n FROM search GROUP BY ALL""", "search"))
def _(spark, sf):
    return lens(spark, sf, "search").groupBy(
        "findingId", scoring.observation_count(c("firstSeen"), c("lastSeen")).alias("observations")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("cve_words", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'CVE-2024-' || CAST(10000 + doc_id AS STRING) ELSE '' END AS cves FROM documents
""")
def _(spark, sf):
    body = F.when(c("doc_id") % 2 == 0, F.concat(
        "text", F.lit("\nsee cve-2024-"), (c("doc_id") + 10000).cast("string"), F.lit(", XCVE-2024-1111 and CVE-24-1"))
    ).otherwise(c("text"))
    return read(spark, sf, "documents").select("doc_id", F.array_join(text.cve_words(body), ";").alias("cves"))
