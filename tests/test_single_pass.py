"""Documents that took work to make are gone through once, and a scanner entry is read by its fields instead of being copied whole."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from palisade.operators import details, documents, evidence


def _deep(pairs: int) -> str:
    return '{"k":[' * pairs + '"x"' + "]}" * pairs


def test_leaves_of_texts_ask_for_no_depth(spark, monkeypatch):
    texts = [_deep(3), _deep(25), '{"a":' + _deep(9) + ',"e":{},"l":[[],{"b":null}],"n":1.5}', "7", "[]", "{", None]
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, body string").withColumn(
        "doc", F.try_parse_json("body"))
    asked = documents.leaves(rows, F.col("doc"), ["id"])
    monkeypatch.setattr(documents, "levels", lambda *_: 1 / 0)
    found = documents.leaves(rows, F.col("doc"), ["id"], text=F.col("body"))
    assert found.columns == asked.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, asked.collect()))
    assert ("data" + ".k[0]" * 25, "data" + ".k[]" * 25, "x") in {(r["path"], r["shape"], r["value"]) for r in found.collect()}


def _documents(spark):
    infos = [
        "odd", {"providerId": "P", "assessmentId": "a", "initialScore": {"base": "8.5", "effectiveScoreInfo": {
            "cvss31Base": {"AV": "N"}, "hyScoreMetrics": None}}, "vulnerableFilePaths": ["/a", "", 3],
            "sharedDetailsLocal": {"assessmentName": "n", "i18n": {"text": "t"}, "extendedAttributesList": [
                5, {"type": "commonVulnerabilityExposure", "id": "cve-2024-12345", "references": None},
                {"type": "commonVulnerabilityExposure", "id": "CVE-2024-12346", "references": {"name": "r", "url": "u"}}]}},
        {"providerId": "Q", "initialScore": 3, "sharedDetailsLocal": [], "vulnerableFilePaths": "x", "firstDetection": "2024-01-02T00:00:00Z"}]
    body = {"findingId": "f", "assetId": "a1", "data": {
        "effectiveScoreInfo": {"hyScoreMetrics": {"FINDING_EPSS": 0.5}}, "searchFinding": {"status": "OPEN"},
        "assessmentsRelated": {"activeFindingProviderInfos": infos}}}
    return spark.createDataFrame([("s", json.dumps(body))], "source string, body string")


def test_entries_are_not_copied_whole(spark):
    docs = documents.valid_documents(_documents(spark))
    normalized, entries = details.normalize_details(docs, "https://a", "n"), evidence.scanner_entries(docs)
    providers = details.provider_rows(docs)
    for table in (normalized, entries, providers):
        assert "array<variant>" not in table._jdf.queryExecution().optimizedPlan().toString()
    row = normalized.collect()[0]
    assert (row["providerId"], row["cvssScore"], row["cvssAttackVector"], row["epssScore"], row["status"]) == ("P", 8.5, "N", None, "OPEN")
    assert str(row["firstSeen"]) == "2024-01-02 00:00:00"
    assert [r["cve"] for r in details.cve_rows(normalized).collect()] == ["CVE-2024-12345", "CVE-2024-12346"]
    assert [tuple(r) for r in details.cve_reference_rows(normalized).collect()] == [("f", "CVE-2024-12346", "r", "u")]
    assert [(r["providerId"], r["baseScore"], r["assessmentName"]) for r in providers.orderBy("providerId").collect()] == [
        ("P", 8.5, "n"), ("Q", None, None)]
    assert [(r["providerId"], r["assessmentId"], r["paths"]) for r in entries.orderBy("entry").collect()] == [
        ("P", "a", ["/a", "3"]), ("Q", None, [])]
