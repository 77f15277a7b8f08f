"""Documents of an export: many paths in one pass and CVE ids in the JVM say what the single reads and the Arrow function say."""

import json

from pyspark.sql import functions as F

from palisade.functions.json_text import at, at_once, is_object
from palisade.operators.documents import smallest_cve, smallest_cve_of
from palisade.sources import export

DOCS = ['{"a":"x","b":{"c":1.50,"d":[1,{"k":2}],"e":null}}', '{"a":{"z":1},"b":[1]}', '{"a":null,"b":"text"}', '{"a":true,"b":{"c":{"y":"Y"}}}',
        '[{"a":1}]', '"a"', "null", "7", None]


def test_paths_at_once_equal_single_paths(spark):
    rows = spark.createDataFrame([(t,) for t in DOCS], "t string").select(F.try_parse_json("t").alias("doc"))
    doc, paths = F.col("doc"), ("a", "b.c", "b.d", "b.e", "none.c")
    found = rows.select(at_once(doc, *paths).alias("o"), *[at(doc, p).alias(p.replace(".", "_")) for p in paths], is_object(doc).alias("is")).select(
        "is", *[F.col(f"o.{p}").eqNullSafe(F.col(p.replace(".", "_"))).alias(p.replace(".", "_") + "_same") for p in paths]).collect()
    assert [r["is"] for r in found] == [True] * 4 + [False] * 5
    assert all(r[f"{p.replace('.', '_')}_same"] for r in found for p in paths)


def test_cves_in_the_jvm_equal_those_of_the_arrow_function(spark):
    values = ["see\ncve-2020-1234 x", "xCVE-2020-1111", "CVE-2020-12345:", ["a", ":CVE-2019-9999", "CVE-2018-123"], "a\\CVE-2017-0001", "\u0001CVE-2016-0001",
              "\"CVE-2015-0001\":", {"CVE-2000-0001": "none", "k": ["cve-2014-0001", {"CVE-2001-0001": 1}]}, "éCVE-2013-0001", "CVE-2012-0001é é CVE-2012-0002",
              "_CVE-2011-0001", "CVE-2010-٠٠٠٠", 5, None, {"note": "cve-"}, [":", "CVE-2009-0001", '":']]
    rows = spark.createDataFrame([(json.dumps({"v": v}, ensure_ascii=False),) for v in values], "t string")
    raw = rows.select(F.to_json(F.try_parse_json("t")).alias("raw"))
    found = raw.select("raw", smallest_cve("raw").alias("python"), smallest_cve_of(F.col("raw")).alias("here")).collect()
    assert [r.here for r in found] == [r.python for r in found]
    assert {"CVE-2020-1234", "CVE-2019-9999", "CVE-2017-0001", "CVE-2015-0001", "CVE-2014-0001", "CVE-2009-0001"} <= {r.here for r in found}


def test_a_finding_is_read_in_one_pass(spark):
    doc = {"assetId": "a", "findings": {"searchFindings": [5, {"id": "f", "hyScoreV2": "", "metrics": {"hyScoreV2": 7}, "activeProviderInfos": {"name": "P"},
           "dedupInfos": {"IP_ADDRESS": "1.1.1.1"}, "assessmentsRelated": {"byExtendedAttributes": [3, {"description": ""}, {"description": "d"}]}}]}}
    exported = spark.createDataFrame([(json.dumps(doc),)], "t string").select(F.try_parse_json("t").alias("doc"))
    rows = export.normalize_findings(export.open_findings(exported))
    flat = rows.select("findingId", "hyScoreV2", "provider", "description")
    assert flat.collect() == [("f", 7.0, "P", "d")]
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get(finding") <= 1
    assert export.normalize_assets(exported).select("ipAddress").collect() == [(None,)]
