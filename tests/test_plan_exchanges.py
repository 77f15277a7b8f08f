"""What the remediation plan moves between tasks, and the walk of a detail document."""

import re

from palisade.operators import documents, remediation_plan

KEYS = "concat('f', id % 1) AS findingId, concat('a', id % 1) AS assetId"


def moved(df):
    return re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_children_move_once(spark):
    details = spark.sql(f"SELECT {KEYS}, TIMESTAMP_NTZ '2020-01-01' AS extractedAt, 'host' AS hostname FROM range(3)")
    cves = spark.sql(f"SELECT {KEYS}, concat('CVE-', id) AS cve, 'd' AS description FROM range(3)")
    paths = spark.sql(f"SELECT {KEYS}, 'FILE' AS pathType, concat('/p', id % 2) AS path FROM range(4)")
    versions = spark.sql(f"SELECT {KEYS}, 'c' AS component, '1' AS detectedVersion, '2' AS expectedVersion FROM range(2)")
    rows = remediation_plan.remediation_findings(details, None, cves, paths, versions)
    keys = [re.sub(r"#\d+L?", "", key) for key in moved(rows)]
    assert not [key for key in keys if re.match(r"findingId, assetId, (cve|pathType|component)", key)]
    assert sorted((r.cve, r.filePath) for r in rows.collect()) == sorted((f"CVE-{i}", "/p1") for i in range(3) for _ in range(2))


def test_plan_texts_stay_out_of_the_exchange(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        ('f1', 'a1', 'C1', 'fix', 'P', 'n', CAST(NULL AS STRING), '2', 5.0D, 10.0D, true),
        ('f1', 'a1', 'C2', 'fix', 'P', 'n', NULL, '2', 6.0D, 10.0D, true),
        ('f2', 'a2', 'C1', 'fix', 'P', 'n', NULL, '2', NULL, 20.0D, false),
        ('f3', 'a2', NULL, 'fix', 'P', 'n', '', '2', 1.0D, 1.0D, NULL)
        AS t(findingId, assetId, cve, remediation, providerId, findingName, component, expectedVersion, cvssScore, hyScoreV2, cisaKev)""")
    plans = remediation_plan.plan_summary(rows)
    assert not [key for key in moved(plans) if "remediation" in key]
    found = sorted((r.component is None, r.affectedAssets, r.affectedFindings, r.distinctCves, r.maxCvss, r.cisaKevFindings)
                   for r in plans.collect())
    assert found == [(False, 1, 1, 0, 1.0, 0), (True, 2, 2, 2, 6.0, 1)]


def test_walk_asks_for_the_depth_of_deep_documents_only(monkeypatch):
    monkeypatch.setattr(documents, "_depth", lambda value: 1 / 0)
    text = """{"findingId": "f", "data": {"assessmentsRelated": {"activeFindingProviderInfos": [{"extendedAttributesList": [
        {"qid": 1, "nested": {"rule_id": "R"}, "plugin-id": "p"}], "sharedDetailsLocal": {"i18n": {"en": {"text": {"text": "below"}, "a": [
        {"text": " one "}, {"text": "two"}]}}}, "details": {"product": "x", "more": [{"path": "/p"}]}}]}}}"""
    entry = documents._walk(text)["entries"][0]
    assert [(i["key"], i["value"]) for i in entry["ids"]] == [("qid", "1"), ("rule_id", "R"), ("plugin-id", "p")]
    assert entry["texts"] == ["one", "two"]
    assert [(s["path"], s["fields"], s["text"]) for s in entry["sources"]] == [
        ("details", [("product", "x")], None), ("details.more[0]", [("path", "/p")], None),
        ("i18n[0]", None, "below"), ("i18n[1]", None, " one "), ("i18n[2]", None, "two")]
