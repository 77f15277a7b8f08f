"""The rows of the remediation plan and their children are dealt by finding once; joins, groups and windows stay there."""

from __future__ import annotations

import re

from palisade.operators import remediation_plan
from palisade.session import prepare, side_by_side


def test_plan_rows_stay_with_their_finding(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    side_by_side(spark)
    try:
        main = spark.createDataFrame(
            [("f", "a", "2024-01-01", "new"), ("f", "a", "2023-01-01", "old"), ("f", None, "2024-01-01", "loose"), (None, "a", None, "odd")],
            "findingId string, assetId string, extractedAt string, remediation string")
        assets = spark.createDataFrame([("a", "Linux"), ("b", None)], "assetId string, assetOsPrimary string")
        cves = spark.createDataFrame([("f", "a", "C1", "x"), ("f", "a", "C1", "y")], "findingId string, assetId string, cve string, description string")
        paths = spark.createDataFrame([("f", "a", "FILE", "/p"), ("f", "a", "FILE", "/q")], "findingId string, assetId string, pathType string, path string")
        versions = spark.createDataFrame([("f", "a", "lib", "1", "2")] * 2, "findingId string, assetId string, component string, detectedVersion string, expectedVersion string")
        rows = remediation_plan.remediation_findings(main, assets, cves, paths, versions)
        dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", rows._jdf.queryExecution().executedPlan().toString())
        by = {tuple(re.findall(r"[A-Za-z_]+(?=#)", keys)) for keys in dealt}
        assert by <= {("findingId",), ("assetId",), ("assetId", "_deal")}, by
        found = {(r["findingId"], r["assetId"], r["remediation"], r["assetOsPrimary"], r["cveDescription"], r["filePath"], r["component"])
                 for r in rows.collect()}
        assert found == {("f", "a", "new", "Linux", "y", "/q", "lib"), ("f", None, "loose", None, None, None, None),
                         (None, "a", "odd", "Linux", None, None, None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        prepare(spark)
