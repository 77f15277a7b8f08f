"""The report set: sections inside buckets need no exchange, large assets give the same rows by the other way."""

import re

from pyspark.sql import functions as F

from palisade.operators import report_set
from palisade.plans.report_set import given
from palisade.session import written


def _bucketed(spark, base, buckets, tag):
    return {name: report_set.bucketed(table, f"{tag}_{name}", buckets) for name, table in base.items()}


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_no_section_moves_rows(spark, sf_dir):
    base = {name: written(table, name) for name, table in given(spark, sf_dir).items()}
    tables = _bucketed(spark, base, 4, "still")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with report_set.joined_in_buckets(spark):
            moved = {name: re.findall(r"Arguments: (?:hash|range|RoundRobin)partitioning\([^)]*\)", _plan(table))
                     for name, table in report_set.sections(tables).items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in tables:
            spark.sql(f"DROP TABLE still_{name}")
    assert {name: found for name, found in moved.items() if found} == {}
    # The same sections over tables that are not dealt by asset do move rows: the pattern finds what it looks for.
    assert "hashpartitioning(assetId" in _plan(report_set.sections(base)["vulnerabilities"])


def test_large_assets_stay_out_of_the_buckets(spark, tmp_path):
    rows = [("big" if n % 3 == 0 else f"small-{n}", n) for n in range(3000)]
    table = spark.createDataFrame(rows, "assetId string, n long")
    assert [r["assetId"] for r in report_set.large_assets({"rows": table}).collect()] == ["big"]
    assert report_set.large_assets({"rows": table.where("false")}).count() == 0


def test_fingerprint_ignores_the_order(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x")], "assetId string, line string")
    one = report_set.fingerprints(rows, "s", F.col("line")).orderBy("assetId").collect()
    two = report_set.fingerprints(rows.orderBy(F.desc("line")), "s", F.col("line")).orderBy("assetId").collect()
    assert one == two and [r["items"] for r in one] == [3, 1]
    less = report_set.fingerprints(rows.distinct(), "s", F.col("line")).orderBy("assetId").collect()
    assert less[0]["fingerprint"] != one[0]["fingerprint"] and less[1] == one[1]
