"""Many patterns in many texts, matches across the seam of two findings, and files judged by their footers."""

import random

import pytest
from pyspark.sql import functions as F

from palisade.operators import dashboard, quality
from palisade.sources import files, sinks


@pytest.mark.parametrize(("shard_bytes", "each"), [(32 << 20, 50_000), (40, 7)])
def test_contained_equals_brute_force(spark, monkeypatch, shard_bytes, each):
    monkeypatch.setattr(dashboard, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(dashboard, "TEXTS_A_TASK", each)
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    texts = sorted({word(rng.randint(1, 40)) for _ in range(60)})
    patterns = sorted({word(rng.randint(1, 5)) for _ in range(40)})
    left, right = spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = [tuple(r) for r in dashboard.contained(left, right).collect()]
    assert sorted(found) == sorted((t, p) for t in texts for p in patterns if p in t)
    assert dashboard.contained(left, right.limit(0)).count() == dashboard.contained(left.limit(0), right).count() == 0


def test_pieces_hold_every_match_of_the_joined_text(spark):
    rng = random.Random(2)
    rows = [(f"a{k % 4}", f"f{k:03}", rng.choice([None, "", "Up", "x" * 60, "Update now"]), rng.choice([None, "", "C", "CVE-1"])) for k in range(120)]
    frame = spark.createDataFrame(rows, "assetId string, findingId string, remediation string, cve string")
    pieces = {}
    for r in dashboard.joined_pieces(frame).collect():
        pieces.setdefault(r["assetId"], []).append(r["text"])
    for asset in ("a0", "a1", "a2", "a3"):
        whole = " ".join(f"{r or ''} {c or ''}".lower() for a, _, r, c in rows if a == asset)
        for size in (21, 33, 45):
            inside = {whole[k : k + size] for k in range(len(whole) - size + 1)}
            assert all(any(w in p for p in pieces[asset]) for w in inside)
        assert all(p.strip() in whole for p in pieces[asset])


def test_related_across_a_seam(spark):
    findings = spark.createDataFrame(
        [("a", "h", "f1", "please install the", "newest"), ("a", "h", "f2", "release of lathe control", None), ("b", "h", "f3", "nothing", None)],
        "assetId string, hostname string, findingId string, remediation string, cve string")
    plans = spark.createDataFrame([("k1", "Newest RELEASE of lathe", 1.0), ("k2", "something else that nobody has", 9.0), ("k3", "nothing", 5.0)],
                                  "remediationKey string, remediation string, maxTrs double")
    assets = spark.createDataFrame([("a",), ("b",)], "assetId string")
    got = {(r["assetId"], r["remediationKey"], r["place"], r["direct"]) for r in dashboard.related_remediations(findings, plans, assets, 2).collect()}
    assert got == {("a", "k1", 1, True), ("b", "k2", 1, False), ("b", "k3", 2, False)}


def test_footers_answer_without_reading_pages(spark, tmp_path):
    data = spark.createDataFrame([(1, None, [1]), (2, "x", None), (None, None, [2])], "a int, b string, c array<int>")
    data.write.parquet(f"{tmp_path}/t.parquet")
    data.limit(0).write.parquet(f"{tmp_path}/none.parquet")
    names = ["t.parquet", "none.parquet", "gone.parquet"]
    report = files.footer_report(spark, str(tmp_path), names)
    rows = {(r["dataset"], r["field"]): (r["rows"], r["nonNull"], r["nullPercent"], r["nested"]) for r in report.collect()}
    assert rows["t.parquet", "a"] == (3, 2, 33.33, False) and rows["t.parquet", "b"] == (3, 1, 66.67, False)
    assert rows["t.parquet", "c"] == (3, None, None, True) and rows["none.parquet", "a"] == (0, 0, None, False)
    errors = {r["error"] for r in quality.file_errors(report, names).collect()}
    assert errors == {"missing: gone.parquet", "nested columns in t.parquet: c", "nested columns in none.parquet: c"}
    assert "missing: gone.parquet" not in {r["error"] for r in quality.file_errors(report, names, allow_missing=True).collect()}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    plan = files.footer_counts(files.footer_session(spark), f"{tmp_path}/t.parquet")[1]._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan


def test_counters_are_those_of_the_writing_job(spark, tmp_path):
    rows = spark.range(1000).withColumn("good", F.when(F.col("id") % 10 == 3, F.lit(None)).otherwise(F.col("id") % 2 == 0))
    entry = sinks.observed_run(rows, f"{tmp_path}/o", "r1", F.col("good"), "read", "wrote", "failed", drop=["good"]).collect()[0]
    assert entry["counters"] == {"read": 1000, "wrote": 500, "failed": 500} and entry["status"] == "completed_with_errors"
    assert spark.read.parquet(f"{tmp_path}/o").count() == 500 and spark.read.parquet(f"{tmp_path}/o").columns == ["id"]
    clean = sinks.observed_run(rows.where("id < 0"), f"{tmp_path}/p", "r2", F.col("good"), "read", "wrote", "failed").collect()[0]
    assert clean["status"] == "not_found" and clean["counters"]["read"] == 0 and clean["finishedAt"] >= clean["startedAt"]
