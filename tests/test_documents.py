"""Golden tests on our own small documents, with the cases that the driver tables cannot show."""

import json

import pytest
from pyspark.sql import functions as F

from palisade.functions import json_text, text
from palisade.operators import details, documents, evidence, profile
from palisade.operators import quality


def docs(spark, *bodies, source="d"):
    rows = [(f"{source}{i}", body if isinstance(body, str) else json.dumps(body)) for i, body in enumerate(bodies)]
    return documents.with_walk(documents.envelopes(spark.createDataFrame(rows, "source string, body string")))


def provider(name, **fields):
    return {"providerId": name, "assessmentId": f"as-{name}", **fields}


def envelope(providers, **data):
    return {"findingId": "f1", "assetId": "a1", "extractedAt": "2026-04-01T11:00:00Z",
            "data": {"assessmentsRelated": {"activeFindingProviderInfos": providers}, **data}}


TWO_COPIES = provider("QUALYS_VM", technicalDetails={"components": [
    {"package": "org.demo:lib", "installedVersion": "1.0", "requiredVersion": "1.2", "installPath": "/opt/a.jar"},
    {"package": "org.demo:lib", "installedVersion": "1.0", "requiredVersion": "1.2", "installPath": "/opt/b.jar"}]},
    extendedAttributesList=[{"QID": 7}, {"deep": [{"plugin-Id": "p"}]}, {"qid": ""}, {"qid": 7}])


def found(spark, *bodies):
    return evidence.candidates(evidence.scanner_entries(docs(spark, *bodies)))


def test_validity(spark):
    checked = documents.envelopes(spark.createDataFrame([
        ('{"findingId":"f","data":{}}',), ('{"findingId":"f","data":{}}}',), ('{"findingId":"f","data":[]}',),
        ('{"findingId":0,"data":{}}',), ('[]',), (None,), ('{"findingId":"f","findingId":"","data":{}}',)], "body string"))
    assert [r["valid"] for r in checked.collect()] == [True, False, False, False, False, False, False]


def test_whole_text_must_be_json(spark):
    rows = spark.createDataFrame([("1",), ("1,2",), ("",), ("{}}",), ("{}],[",), ('{"a":1},{"b":2',), ("[1]",), ('"x"',)], "t string")
    assert [r[0] for r in rows.select(json_text.is_json(F.col("t"))).collect()] == [
        True, False, False, False, False, False, True, True]


def test_walk_and_envelope_agree_on_validity(spark):
    bodies = ['{"findingId":"f","data":{}}', '{"findingId":"f","data":{}}}', '{"findingId":"f","data":[]}', '[]', '{"findingId":"","data":{}}']
    frame = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "source string, body string")
    assert [r["source"] for r in documents.valid_documents(frame).collect()] == ["0"]
    assert [r["source"] for r in documents.envelopes(frame).where("valid").collect()] == ["0"]


def test_same_component_twice_gives_two_occurrences(spark):
    rows = found(spark, envelope([TWO_COPIES]))
    component = evidence.component_rows(rows).collect()
    assert [(c["package"], c["installedVersion"], c["requiredVersion"]) for c in component] == [("org.demo:lib", "1.0", "1.2")]
    assert component[0]["installPath"] == "/opt/b.jar"
    assert {o["installPath"] for o in evidence.occurrence_rows(rows).collect()} == {"/opt/a.jar", "/opt/b.jar"}
    assert json.loads(component[0]["scannerReferencesJson"]) == [
        {"type": "PLUGIN_ID", "value": "p"}, {"type": "QID", "value": "7"}]


def test_two_scanners_give_two_component_rows(spark):
    second = dict(TWO_COPIES, providerId="CROWDSTRIKE_FALCON")
    rows = evidence.component_rows(found(spark, envelope([TWO_COPIES, second]))).collect()
    assert {r["scanner"] for r in rows} == {"Qualys VM", "CrowdStrike Falcon"}


def test_paths_of_one_component_and_of_none(spark):
    one = provider("X", details={"software": "demo", "nested": {"vendor": "v"}}, vulnerableFilePaths=["/a", "", "/b"])
    none = provider("Y", vulnerableFilePaths=["/c"])
    rows = evidence.occurrence_rows(found(spark, envelope([one, none]))).collect()
    assert sorted((r["installPath"], r["componentId"] is not None) for r in rows) == [("/a", True), ("/b", True), ("/c", False)]


def test_every_spelling_is_read(spark):
    from palisade import fixed_values as fixed

    for field, spellings in (("required_version", fixed.FIELD_SPELLINGS["required_version"]),
                             ("package", fixed.FIELD_SPELLINGS["package"])):
        infos = [provider(f"P{i}", packages=[{"product": "x", s: f"v{i}"}]) for i, s in enumerate(spellings)]
        rows = found(spark, envelope(infos)).where("isCandidate").orderBy("entry").collect()
        assert [r[field] for r in rows] == [f"v{i}" for i in range(len(spellings))]


def test_labelled_text_component(spark):
    note = {"en": {"text": "Package: demo\nInstalled Version: 1\nRequired Version: 2\nLanguage: Java\nPath: /opt/demo"}}
    row = evidence.component_rows(found(spark, envelope([provider("Z", sharedDetailsLocal={"i18n": note})]))).collect()[0]
    assert (row["package"], row["installedVersion"], row["requiredVersion"], row["ecosystem"], row["installPath"]) == (
        "demo", "1", "2", "Java", "/opt/demo")
    assert row["sourcePath"] == "activeProviderInfos.Z.i18n[0]"


def test_events(spark):
    atoms = [{"at": "2026-01-28T06:17:00Z", "auditId": "e1", "trigger": "HUMAN__NEW_ASSESSMENT",
              "declaredFindingStatus": {"subState": "CONFIRMED"}},
             {"at": "2026-04-01T12:54:00+02:00", "trigger": "ASSET_INDICATORS_CHANGED"}, "odd", {"at": "soon"}]
    body = envelope([])
    body["data"]["assessmentsRelated"]["findingAuditHistory"] = {"info": {"atomInfos": atoms}}
    rows = evidence.event_rows(docs(spark, body)).collect()
    assert [(r["eventType"], str(r["eventTimestamp"])) for r in rows] == [
        ("FINDING_CREATED", "2026-01-28 06:17:00"), ("ASSET_INDICATORS_CHANGED", "2026-04-01 10:54:00"), ("UNKNOWN", "None")]
    assert rows[0]["eventId"] == "e1" and len(rows[1]["eventId"]) == 16


def test_text_order_is_the_written_one(spark):
    notes = {"zz": {"children": [{"text": " B "}], "text": "A"}, "aa": [{"text": "C"}, {"text": "A"}, {"text": "  "}]}
    infos = [provider("X", sharedDetailsLocal={"i18n": {"t": {"text": "only"}}}), provider("Y", sharedDetailsLocal={"i18n": notes})]
    row = details.normalize_details(docs(spark, envelope(infos)), "https://app.example", "N1").collect()[0]
    assert row["providerId"] == "Y"
    assert row["providerEvidenceRaw"] == "A\n\nB\n\nC"
    assert row["historyUrl"] == "https://app.example/N1/assets/live-report/a1/vuln-management/findings/finding/f1/history"


def test_preferred_scanner_wins_over_more_text(spark):
    infos = [provider("Y", sharedDetailsLocal={"i18n": {"a": {"text": "1"}, "b": {"text": "2"}}}, firstDetection="2025-03-01T00:00:00Z"),
             provider("QUALYS_VM", initialScore={"base": 8.8, "environmental": 6.1}, firstDetection="2025-03-02T00:00:00Z")]
    row = details.normalize_details(docs(spark, envelope(infos)), "https://a", "n").collect()[0]
    assert (row["providerId"], row["cvssScore"], row["environmentalScore"]) == ("QUALYS_VM", 8.8, 6.1)
    assert str(row["firstSeen"]) == "2025-03-01 00:00:00"


def test_document_without_scanners(spark):
    shared = {"extendedAttributesList": [
        {"type": "commonVulnerabilityExposure", "id": "cve-2025-12345", "description": "A",
         "references": '[{"title":"N","href":"https://n"},"https://p",3]'},
        {"type": "commonVulnerabilityExposure", "id": "CVE-2024-9999", "references": "not json"},
        {"type": "commonVulnerabilityExposure", "id": "CVE-2024-99"}],
        "i18n": {"text": "HKLM\\Plant\\Lathe LastProduct = 7.4.2\n%ProgramFiles%\\Lathe\\feed.dll Version is 7.3.9"}}
    found_details = details.normalize_details(docs(spark, envelope([], sharedDetailsLocal=shared, cvssVector="V")), "https://a", "n")
    row = details.flat_details(found_details).collect()[0]
    assert json.loads(row["cvesJson"]) == ["CVE-2025-12345", "CVE-2024-9999"]
    assert json.loads(row["registryPathsJson"]) == ["HKLM\\Plant\\Lathe"]
    assert json.loads(row["filePathsJson"]) == ["%ProgramFiles%\\Lathe\\feed.dll"]
    assert json.loads(row["detectedVersionsJson"]) == ["7.3.9"]
    assert json.loads(row["expectedVersionsJson"]) == ["7.4.2"]
    assert row["cvssVector"] == "V"
    references = details.cve_reference_rows(found_details).collect()
    assert {(r["referenceName"], r["referenceUrl"]) for r in references} == {("N", "https://n"), (None, "https://p")}
    assert quality.nested_columns(details.flat_details(found_details).schema) == []


def test_leaves_at_any_depth(spark):
    rows = spark.createDataFrame([("1", '{"a":[1,{"b":"x","c":[]}],"d":null,"e":{}}'), ("2", None), ("3", "[[[]]]"), ("4", "7")], "id string, body string")
    rows = rows.withColumn("doc", F.try_parse_json("body"))
    flat = {(r["id"], r["path"], r["value"]) for r in documents.leaves(rows, F.col("doc"), ["id"]).collect()}
    assert flat == {("1", "data.a[0]", "1"), ("1", "data.a[1].b", "x"), ("1", "data.a[1].c", "[]"), ("1", "data.d", None), ("1", "data.e", "{}"),
                    ("2", "data", None), ("3", "data[0][0]", "[]"), ("4", "data", "7")}
    with pytest.raises(Exception, match="nested deeper"):
        documents.leaves(rows, F.col("doc"), ["id"], depth=1).collect()
    every = {(r["id"], r["path"], r["parent"], r["key"]) for r in documents.fields(rows, F.col("doc"), ["id"]).collect()}
    assert every == {("1", "data", None, None), ("1", "data.a", "data", "a"), ("1", "data.a[0]", "data.a", None), ("1", "data.a[1]", "data.a", None),
                     ("1", "data.a[1].b", "data.a[1]", "b"), ("1", "data.a[1].c", "data.a[1]", "c"), ("1", "data.d", "data", "d"),
                     ("1", "data.e", "data", "e"), ("2", "data", None, None), ("3", "data", None, None), ("3", "data[0]", "data", None),
                     ("3", "data[0][0]", "data[0]", None), ("4", "data", None, None)}


@pytest.mark.parametrize("pairs", [20, 60])
def test_deep_documents(spark, pairs):
    """Forty levels in one scan; more in several steps."""
    body = '{"k":[' * pairs + '"x"' + "]}" * pairs
    rows = spark.createDataFrame([("1", body), ("2", '{"a]{":"[{"}')], "id string, body string").withColumn("doc", F.try_parse_json("body"))
    assert documents.levels(rows, F.col("doc")) == 2 * pairs
    found = documents.leaves(rows, F.col("doc"), ["id"])
    assert {(r["id"], r["path"], r["value"]) for r in found.collect()} == {("1", "data" + ".k[0]" * pairs, "x"), ("2", "data.a]{", "[{")}
    every = documents.fields(rows, F.col("doc"), ["id"])
    assert every.count() == 2 * pairs + 1 + 2
    if pairs == 20:
        for frame in (found, every):
            assert frame._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_cves_come_from_values_not_from_keys(spark):
    body = json.dumps({"CVE-2020-1111": 1, "x": ["note\ncve-2021-2222", {"y": {"z": "CVE-2019-33333, XCVE-2018-4444"}}]})
    rows = spark.createDataFrame([(body,), ('{"a":1}',), (None,)], "body string")
    assert [r[0] for r in rows.select(documents.smallest_cve("body")).collect()] == ["CVE-2019-33333", None, None]
    strings = documents.leaves(rows.where("body IS NOT NULL").withColumn("doc", F.try_parse_json("body")), F.col("doc"), ["body"])
    cves = strings.where("kind = 'string'").select(F.explode(text.cve_words(F.col("value")))).collect()
    assert {r[0] for r in cves} == {"CVE-2019-33333", "CVE-2021-2222"}


def test_redaction_at_any_depth(spark):
    rows = spark.createDataFrame([("1", '{"a":[{"Token":{"x":1,"y":2}},{"k":"v"}],"password":"p"}')], "id string, body string")
    rows = rows.withColumn("doc", F.try_parse_json("body"))
    masked = profile.redacted_leaves(documents.leaves(rows, F.col("doc"), ["id"]), ["id"]).collect()
    assert {(r["path"], r["value"]) for r in masked} == {
        ("data.a[0].Token", "***REDACTED***"), ("data.a[1].k", "v"), ("data.password", "***REDACTED***")}


def test_lone_surrogate_halves_keep_the_document(spark):
    head = '{"findingId":"f%s","data":{"assessmentsRelated":{"activeFindingProviderInfos":[{"providerId":"p","note":"%s"}]},"description":"%s"}}'
    texts = [head % (k, t, t) for k, t in enumerate(["cut \\ud83d", "\\udc00\\ud83d\\ude00 CVE-2030-1111", "kept \\\\ud83d", "\\ud83d\\ud83d\\ude00"])]
    deep = lambda n: '{"findingId":"d","data":{"x":' + "[" * n + "]" * n + "}}"
    texts += [deep(900), deep(990), deep(3000), deep(200_000), "{", "[]", None]
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    rows = documents.valid_documents(df).select(
        F.try_variant_get("doc", "$.findingId", "string").alias("id"), F.try_variant_get("doc", "$.data.description", "string").alias("said"),
        F.get("walked.entries", F.lit(0))["raw"].alias("raw")).collect()
    said = {r["id"]: (r["said"], json.loads(r["raw"])["note"]) for r in rows if r["raw"]}
    expected = ["cut \ufffd", "\ufffd\U0001f600 CVE-2030-1111", "kept \\ud83d", "\ufffd\U0001f600"]
    assert said == {f"f{k}": (t, t) for k, t in enumerate(expected)}
    assert [r["id"] for r in rows if not r["raw"]] == ["d", "d"]
    assert {r["reason"]: r["documents"] for r in documents.rejected_documents(df).collect()} == {"too deep": 2, "no JSON": 2, "no finding": 1}
