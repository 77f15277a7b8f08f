"""Named query: the report set of all assets, written in one co-partitioned pass and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.operators import report_set
from palisade.plans.intelligence import (
    _AX, _CF, _CX, _HX, _KX, _OBS, _OX, _PX, _QX, _RX, _VX, component_rows, event_rows, findings, occurrence_rows, sql)
from palisade.plans.lens import lens, sold_items
from palisade.plans.registry import ORACLES, query
from palisade.session import new_folder

# Section: its rows in SQL, and the compared fields as "name:kind" with kinds s text, i whole number, f number, t time, b truth.
_FIELDS = {
    "heads": ("""SELECT * FROM ({report_context_head}) JOIN px USING (assetId, "totalFindings", "overallPriority")
        JOIN rx USING (assetId, "top5Share") JOIN qx USING (assetId, "completenessScore")""",
              "hostname:s fqdn:s schemaVersion:s totalFindings:i uniqueCves:i critical:i high:i medium:i low:i p1:i p2:i p3:i "
              "oldestOpenFindingDays:i persistentFindings:i reopenedFindings:i overallPriority:s confirmedByMultipleSources:i "
              "totalP1P2:i top5P1P2:i topFindingIds:s missingTitle:i missingCvss:i missingRecommendation:i dateConflicts:i"),
    "findings": ("SELECT * REPLACE (CAST(to_json(cves) AS VARCHAR) AS cves) FROM fx",
                 "findingId:s scanner:s cves:s title:s severity:s trs:f cvss:f epss:f status:s firstSeen:t lastSeen:t ageDays:i "
                 "observationCount:i historyState:s affectedProduct:s detectedVersion:s targetVersion:s recommendation:s cisaKev:b priority:s"),
    "risk_drivers": ("SELECT assetId, findingId, unnest(string_split(drivers, ',')) AS driver FROM ({findings_enriched}) WHERE drivers <> ''",
                     "findingId:s driver:s"),
    "vulnerabilities": ("SELECT * FROM vx", "cve:s title:s severity:s maxTrs:f findingCount:i cvss:f epss:f cisaKev:b sources:s "
                        "sourceCount:i correlation:s confidence:s firstSeen:t lastSeen:t ageDays:i observationCount:i state:s"),
    "vulnerability_findings": ("SELECT *, unnest(cves) AS cve FROM fx", "cve:s findingId:s affectedProduct:s title:s"),
    "scan_history": ("SELECT * FROM hx", "scanDate:s scanner:s openFindings:i criticalCount:i highCount:i mediumCount:i lowCount:i "
                     "newCount:i resolvedCount:i reopenedCount:i method:s"),
    "observations": ("""SELECT *, firstSeen = "observedAt" AS "isFirst" FROM obs""", "findingId:s observedAt:t isFirst:b"),
    "risk_history": ("{asset_risk_history}", "hostname:s available:b method:s warning:s"),
    "events": ("""SELECT f.assetId, findingId, unnest([d.firstSeen, d.lastSeen]) AS "eventTimestamp" FROM docs d JOIN fx f USING (findingId)""",
               "findingId:s eventTimestamp:t"),
    "event_rollup": ("{event_rollup}", "firstVulnerabilitySeen:t latestEvent:t totalEvents:i"),
    "components": ("{components}", "componentId:s package:s product:s findingCount:i sourcePayloads:i"),
    "component_versions": ("{component_versions}", "componentId:s kind:s version:s"),
    "component_findings": ("SELECT * FROM cf", "componentId:s findingId:s scanner:s priority:s"),
    "component_risk": ("{component_risk}", "componentId:s name:s findingCount:i cveCount:i p1Count:i p2Count:i p3Count:i"),
    "component_occurrences": ("{component_occurrences}", "componentId:s occurrenceId:s installPath:s"),
    "actions": ("{remediation_actions}", "id:s order:i priority:s type:s action:s targetVersion:s findingCount:i cveCount:i product:s reason:s"),
    "action_findings": ("{remediation_action_findings}", "recommendation:s targetVersion:s findingId:s"),
    "action_cves": ("""SELECT DISTINCT assetId, trim(coalesce(recommendation, '')) AS recommendation, coalesce(targetVersion, '') AS "targetVersion",
        unnest(cves) AS cve FROM fx""", "recommendation:s targetVersion:s cve:s"),
    "campaigns": ("{remediation_campaigns}", "campaignId:s title:s product:s priority:s estimatedFindingsClosed:i cveCount:i reason:s"),
    "validation_checks": ("{validation_checks}", "kind:s checkId:s check:s expected:s"),
    "sources": ("{asset_sources}", "type:s name:s retrievedAt:t"),
    "missing_fields": ("{missing_fields}", "missing:s"),
    "date_conflicts": ("SELECT assetId, findingId FROM fx WHERE firstSeen > lastSeen", "findingId:s"),
}
# Numbers are compared in thousandths, rounded down, so that no way of printing them matters.
_SQL_TEXT = {"s": '"{0}"', "i": 'CAST("{0}" AS VARCHAR)', "f": 'CAST(CAST(floor("{0}" * 1000.0::DOUBLE) AS BIGINT) AS VARCHAR)',
             "t": """strftime("{0}", '%Y-%m-%d %H:%M:%S')""", "b": 'CAST("{0}" AS VARCHAR)'}
_SPARK_TEXT = {"s": lambda n: F.col(n), "i": lambda n: F.col(n).cast("string"),
               "f": lambda n: F.floor(F.col(n) * F.lit(1000.0)).cast("string"),
               "t": lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss"), "b": lambda n: F.col(n).cast("string")}


def _section_sql(section: str, rows: str, fields: str) -> str:
    texts = [_SQL_TEXT[kind].format(name) for name, kind in (f.split(":") for f in fields.split())]
    line = "concat_ws('|', " + ", ".join(f"coalesce({text}, '~')" for text in texts) + ")"
    return f"""SELECT assetId, '{section}' AS section, count(*) AS items,
  CAST(sum(CAST('0x' || substr(sha256({line}), 1, 12) AS BIGINT)) AS VARCHAR) AS fingerprint FROM ({rows}) GROUP BY assetId"""


_CONTENT_SQL = sql(" UNION ALL ".join(
    _section_sql(section, rows.format_map({name: ORACLES[name] for name in ORACLES}), fields) for section, (rows, fields) in _FIELDS.items()),
    px=_PX, rx=_RX, qx=_QX, vx=_VX, obs=_OBS, hx=_HX, cx=_CX, cf=_CF, ox=_OX, kx=_KX, ax=_AX)


def given(spark, sf):
    sold = sold_items(spark, sf)
    return report_set.inputs(
        lens(spark, sf, "assets"), findings(spark, sf, sold=sold), component_rows(spark, sf, sold), occurrence_rows(spark, sf, sold),
        event_rows(spark, sf, sold))


@query("report_set_content", _CONTENT_SQL)
def _(spark, sf):
    folder, out = new_folder(spark, "report-set"), None
    for section in report_set.write_report_set(given(spark, sf), folder):
        texts = [_SPARK_TEXT[kind](name) for name, kind in (f.split(":") for f in _FIELDS[section][1].split())]
        line = F.concat_ws("|", *[F.coalesce(text, F.lit("~")) for text in texts])
        own = report_set.fingerprints(spark.read.parquet(f"{folder}/{section}"), section, line)
        out = own if out is None else out.unionByName(own)
    return out
