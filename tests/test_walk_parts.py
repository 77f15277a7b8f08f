"""What a query does not go on with is not computed: unasked parts of a walk, and texts parsed for their depth alone."""

import pytest
from pyspark.sql import functions as F

from palisade.operators import documents

TEXT = """{"findingId": "f", "data": {"assessmentsRelated": {"activeFindingProviderInfos": [{"providerId": "P",
    "extendedAttributesList": [{"qid": 1}], "details": {"product": "x"}, "sharedDetailsLocal": {"i18n": {"text": "one"}}}]}}}"""


@pytest.mark.parametrize("parts", [(), ("ids",), ("texts",), ("hash", "ids", "sources"), ("raw",)])
def test_walk_gathers_what_is_asked(monkeypatch, parts):
    whole = documents._walk(TEXT)
    for part, helper in {"hash": "_spaced", "texts": "_texts", "sources": "_sources", "raw": "_canonical"}.items():
        if part not in parts:
            monkeypatch.setattr(documents, helper, lambda *_: 1 / 0)
    walked = documents._walk(TEXT, parts)
    assert walked["valid"] and walked["reject"] is None
    for part in ("hash", "texts"):
        assert walked[part] == (whole[part] if part in parts else None)
    kept = {"index", "provider", *parts} - {"hash"}
    assert walked["entries"] == [{k: v for k, v in entry.items() if k in kept} for entry in whole["entries"]]


def test_every_reason_is_given_without_parts():
    assert [documents._walk(text, ())["reject"] for text in ("{", "[]", "[" * 1001 + "]" * 1001)] == ["no JSON", "no finding", "too deep"]


def test_depth_is_read_off_the_text(spark):
    rows = spark.createDataFrame([('{"a]{\\\\":[{"b":"\\"[["},[]]}',), ("7",), (None,)], "body string")
    assert documents.levels(rows, F.raise_error(F.lit("parsed")), F.col("body")) == 3


@pytest.mark.parametrize("broken", ["[" * 20, "[" * 500, "]]][[["])
def test_text_that_is_no_json_loses_nothing(spark, broken):
    deep = '{"k":[' * 25 + '"x"' + "]}" * 25
    rows = spark.createDataFrame([(1, deep), (2, broken)], "id int, body string").withColumn("doc", F.try_parse_json("body"))
    found = documents.leaves(rows, F.col("doc"), ["id"], text=F.col("body")).where("value IS NOT NULL")
    assert [(r["id"], r["path"], r["value"]) for r in found.collect()] == [(1, "data" + ".k[0]" * 25, "x")]
