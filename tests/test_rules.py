import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palisade.functions import evidence_text, nulls, scoring, text
from palisade.operators import intelligence as intel
from palisade.operators import quality, search, silver, worklist


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def expected_state(hits):
    """Brute force over a series of detections, the first observation being the first one ever."""
    if not hits:
        return "UNKNOWN"
    if len(hits) == 1:
        return "NEW" if hits[0] else "UNKNOWN"
    if hits[-1] and not all(hits[:-1]):
        return "REOPENED"
    if not hits[-1] and any(hits[:-1]):
        return "RESOLVED"
    return "PERSISTENT" if all(hits) else "UNKNOWN"


def test_every_short_series(spark):
    series = [s for n in range(1, 5) for s in itertools.product([True, False], repeat=n)]
    rows = [(f"f{i}", k, f"2026-01-{k + 1:02d} 00:00:00", hit) for i, s in enumerate(series) for k, hit in enumerate(s)]
    seen = spark.createDataFrame(rows, "findingId string, eventId int, observedAt string, detected boolean").withColumn(
        "observedAt", F.col("observedAt").cast("timestamp_ntz"))
    states = {r["findingId"]: r["state"] for r in intel.series_states(seen).collect()}
    assert states == {f"f{i}": expected_state(s) for i, s in enumerate(series)}
    strict = {r["findingId"]: r["state"] for r in intel.series_states(seen, strict=True).collect()}
    assert strict[f"f{series.index((False, True))}"] == "UNKNOWN"
    assert strict[f"f{series.index((True, False, True))}"] == "REOPENED"


def test_missing_value_rules(spark):
    row = one(
        spark, nulls.first_present(F.lit(""), F.lit(None).cast("string"), F.lit("0"), F.lit("x")).alias("present"),
        nulls.coalesce_truthy(F.lit(0.0), F.lit(2.0), kind="number").alias("truthy"),
        nulls.to_double(nulls.first_present(F.lit("n/a"), F.lit("5"))).alias("cast_after_choice"),
        nulls.to_bigint(F.lit("443.0")).alias("port"), nulls.to_double(F.lit("1.0d")).alias("suffix"))
    assert (row["present"], row["truthy"], row["cast_after_choice"], row["port"], row["suffix"]) == ("0", 2.0, None, None, None)


def test_registry_path_stops_at_the_keyword(spark):
    body = F.lit('HKCU\\Soft\\Acme\\Lathe Version is 4\nHKLM\\Plant\\Oven = on\nQID: 90417')
    row = one(spark, evidence_text.registry_paths(body).alias("r"), evidence_text.qid(body).alias("q"))
    assert sorted(row["r"]) == ["HKCU\\Soft\\Acme\\Lathe", "HKLM\\Plant\\Oven"] and row["q"] == "90417"


def test_scanner_names(spark):
    names = {"QUALYS_VM": "Qualys VM", "qualys": "Qualys VM", "CROWDSTRIKE_FALCON": "CrowdStrike Falcon", "azure": "Microsoft Azure",
             " Nessus ": "Nessus", "": "UNKNOWN"}
    for given_name, shown in names.items():
        assert one(spark, text.normalize_scanner(F.lit(given_name)))[0] == shown
    assert one(spark, text.normalize_scanner(F.lit(None).cast("string")))[0] == "UNKNOWN"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1000), min_size=2, max_size=2), st.floats(0, 10))
def test_priority_never_drops_when_the_score_rises(spark, scores, cvss):
    low, high = sorted(scores)
    row = one(spark, scoring.priority(F.lit(low), F.lit(cvss)).alias("a"), scoring.priority(F.lit(high), F.lit(cvss)).alias("b"))
    assert row["b"] <= row["a"]


def test_dedup_is_idempotent(spark):
    rows = spark.range(300).select(
        (F.col("id") % 5).cast("string").alias("assetId"), (F.col("id") % 7).cast("string").alias("findingId"),
        F.when(F.col("id") % 4 != 0, F.timestamp_seconds(F.col("id") % 9).cast("timestamp_ntz")).alias("lastSeen"),
        F.col("id").cast("double").alias("hyScoreV2"))
    once = silver.latest_relations(rows)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, silver.latest_relations(once).collect()))
    assert once.count() == 35


def test_overlay_prefers_details(spark):
    found = spark.createDataFrame([("a", "f", None, 1.0, True), ("a", "g", "own", 2.0, False)],
                                  "assetId string, findingId string, findingName string, hyScoreV2 double, cisaKev boolean")
    extra = spark.createDataFrame([("f", "better", None, False)], "findingId string, findingName string, hyScoreV2 double, cisaKev boolean")
    rows = {r["findingId"]: r for r in silver.overlay_details(found, extra).collect()}
    assert (rows["f"]["findingName"], rows["f"]["hyScoreV2"], rows["f"]["cisaKev"]) == ("better", 1.0, True)
    assert rows["g"]["findingName"] == "own"


def test_work_list_options(spark):
    work = worklist.work_list(spark.createDataFrame([("a", 950.0), ("b", 10.0)], "findingId string, hyScoreV2 double"))
    assert [r["findingId"] for r in worklist.select_candidates(work).collect()] == ["a"]
    assert worklist.select_candidates(work, all_findings=True).count() == 2
    assert worklist.single_finding(work, "z").first()["status"] == "OPEN"


def test_key_comparison_of_nothing_is_complete(spark):
    empty = spark.createDataFrame([], "k string")
    row = quality.key_comparison(empty, spark.createDataFrame([("x",)], "k string"), ["k"], "d").first()
    assert (row["coveragePct"], row["unexpected"]) == (100.0, 1)


def test_coverage_stays_in_range_and_gate_raises(spark):
    rows = spark.createDataFrame([("[]",), ("x",), (None,)], "c string")
    assert quality.coverage(rows, ["c"]).first()["coveragePct"] == 33.33
    quality.fail_on(spark.createDataFrame([], "rule string, entity string"))
    try:
        quality.fail_on(spark.createDataFrame([("r", "e")], "rule string, entity string"))
        raise AssertionError("the gate must raise")
    except ValueError as error:
        assert "r: e" in str(error)
    assert quality.missing_blocks(["metadata", "asset"])[0] == "current_posture"


def test_matching_column_follows_the_spelling_order():
    assert search.matching_column(["Provider", "scanner"], "scanner") == "scanner"
    assert search.matching_column(["FQDN"], "hostname") == "FQDN"
    assert search.matching_column(["x"], "cve") is None


def test_multi_scanner_correlation_and_actions(spark):
    columns = """assetId string, findingId string, scanner string, cves array<string>, title string, severity string, trs double,
        cvss double, epss double, cisaKev boolean, firstSeen timestamp_ntz, lastSeen timestamp_ntz, ageDays bigint, observationCount int,
        historyState string, affectedProduct string, targetVersion string, recommendation string, priority string"""
    row = ("a", "f1", "Qualys VM", ["CVE-2025-1234"], "T", "HIGH", 750.0, 8.0, None, None, None, None, None, 1, "UNKNOWN", None, None,
           "Install KB1", "P2")
    found = spark.createDataFrame([row, (*row[:1], "f2", "CrowdStrike Falcon", *row[3:])], columns)
    vulnerability = intel.vulnerabilities(found).first()
    assert (vulnerability["correlation"], vulnerability["confidence"], vulnerability["findingCount"]) == ("multi_source_confirmed", "HIGH", 2)
    actions = intel.actions(found)
    action = actions.first()
    assert (action["id"], action["type"], action["reason"]) == ("REM-001", "PATCH", "2 finding(s), 1 CVE, TRS max 750")
    assert intel.campaigns(actions).first()["estimatedFindingsClosed"] == 2
