"""Steps that many queries share: what they move between tasks, and that they say the same as before."""

import glob
import re

from pyspark.sql import functions as F

from palisade.functions.json_text import text_list
from palisade.operators import context, intelligence, silver
from palisade.operators.skew import listed
from palisade.plans.intelligence import findings
from palisade.plans.lens import lens, sold_items
from palisade.session import prepare, side_by_side
from palisade.sources import sinks


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def sightings(spark):
    return spark.sql("""SELECT * FROM VALUES
        ('a1', 'h1', 'f1', 'n1', 1.0D, TIMESTAMP_NTZ '2020-01-01'), ('a1', 'h1', 'f1', 'n1', 1.0D, TIMESTAMP_NTZ '2020-01-01'),
        ('a2', 'h2', 'f1', 'n2', 2.0D, TIMESTAMP_NTZ '2020-01-02'), ('a1', 'h1', 'f2', 'n3', 3.0D, NULL), ('a3', 'h3', 'f3', 'n4', NULL, NULL),
        (NULL, 'h4', 'f3', 'n5', 5.0D, NULL), ('a9', 'h9', NULL, 'n6', 1.0D, NULL)
        AS t(assetId, hostname, findingId, findingName, hyScoreV2, lastSeen)""")


def test_sighted_facts_equal_facts_of_the_newest_relations(spark):
    assets = spark.sql("SELECT * FROM VALUES ('a1'), ('a2') AS t(assetId)")
    for known in (None, assets):
        old = silver.facts(silver.latest_relations(sightings(spark)), known).drop("hostname")
        new = silver.sighted_facts(sightings(spark), known).select(*old.columns)
        assert sorted(map(str, old.collect())) == sorted(map(str, new.collect()))


def test_findings_stay_with_their_details(spark):
    side_by_side(spark)
    try:
        details = spark.sql("SELECT 'f1' AS findingId, 'a1' AS assetId, 1 AS d FROM range(3)").repartition("findingId").distinct()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = silver.sighted_facts(sightings(spark), None).join(details, ["findingId", "assetId"], "left")
        assert set(re.findall(r"hashpartitioning\((.*?), \d+\)", plan(joined))) == {"findingId"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        prepare(spark)


def test_short_lists_are_read_as_the_parser_does(spark):
    texts = ["[]", '["a"]', '["a","b,c"]', '[""]', '["a", "b"]', '["a\\"b"]', '["a"]x', '["a"', '[1,"a"]', "plain", '"a"', "", None, '["a"]\n', '[null]']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.l for r in rows.select("t", text_list(F.col("t")).alias("l")).collect()}
    assert found == {"[]": [], '["a"]': ["a"], '["a","b,c"]': ["a", "b,c"], '[""]': [""], '["a", "b"]': ["a", "b"], '["a\\"b"]': ['a"b'],
                     '["a"]x': ['["a"]x'], '["a"': ['["a"'], '[1,"a"]': ["1", "a"], "plain": ["plain"], '"a"': ["a"], "": [], None: [],
                     '["a"]\n': ["a"], "[null]": [None]}


def test_lists_do_the_work_before_them_once(spark):
    parts = listed(spark.sql("SELECT id % 3 AS k, CAST(id AS STRING) AS v FROM range(30)"), ["k"], "v", rows=4)
    assert "Range" not in plan(parts)
    assert sum(r["items"] for r in parts.collect()) == 30


def test_sources_and_events_take_one_pass(spark):
    found = spark.sql("""SELECT * FROM VALUES ('a1', 'f1', 's1', TIMESTAMP_NTZ '2020-01-01', TIMESTAMP_NTZ '2020-02-01'),
        ('a1', 'f2', NULL, TIMESTAMP_NTZ '2020-01-02', NULL), ('a2', 'f3', 's1', NULL, NULL), (NULL, 'f1', 's1', NULL, NULL)
        AS t(assetId, findingId, scanner, firstSeen, lastSeen)""")
    assets = spark.sql("SELECT * FROM VALUES ('a1', TIMESTAMP_NTZ '2021-01-01'), ('a2', TIMESTAMP_NTZ '2022-01-01') AS t(assetId, lastSeen)")
    rows = intelligence.sources(found, assets)
    assert {(r.assetId, r.type, r.name, r.retrievedAt.year) for r in rows.collect()} == {
        ("a1", "PLATFORM", "Platform", 2020), ("a1", "SCANNER", "s1", 2020), ("a1", "SCANNER", None, 2020),
        ("a2", "PLATFORM", "Platform", 2022), ("a2", "SCANNER", "s1", 2022)}
    events = spark.sql("SELECT 'f1' AS findingId, TIMESTAMP_NTZ '2020-03-01' AS eventTimestamp FROM range(2)")
    rolled = intelligence.event_rollup(events, found)
    assert {(r.assetId, r.latestEvent is None, r.totalEvents) for r in rolled.collect()} == {("a1", False, 2), ("a2", True, 0), (None, True, 0)}
    assert plan(rolled).count("Scan") + plan(rolled).count("LocalTableScan") <= 4


def test_blocks_move_once_and_documents_are_packed(spark, tmp_path):
    table = spark.sql("SELECT concat('a', id % 2) AS assetId, id FROM range(25)").unionByName(spark.sql("SELECT 'b' AS assetId, 1L AS id"))
    blocks = context.context_blocks({"findings": table}, rows=5)
    assert "_deal" not in plan(blocks)
    found = blocks.collect()
    assert sum(r["items"] for r in found) == 26 and {r.parts for r in found if r.assetId == "a0"} == {3}
    heads = spark.sql("SELECT 'b' AS assetId, 1 AS x")
    sinks.write_documents(heads, blocks, f"{tmp_path}/out", buckets=2, files=1)
    assert glob.glob(f"{tmp_path}/out/*/*.gz") and not glob.glob(f"{tmp_path}/out/*/*.json")
    assert spark.read.json(f"{tmp_path}/out").count() == len(found) + 1


def test_sold_items_move_as_plain_columns(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prepare(spark)
        moved = plan(findings(spark, sf_dir, known=False))
        keys = re.findall(r"Exchange hashpartitioning\((.*), \d+\)", moved)
        # Sightings (two branches), their pairs (two) and details; nothing is dealt by the finding's text again.
        assert sum(key.startswith("concat(cast(l_orderkey as string), -") for key in keys) == 5
        assert not [key for key in keys if "findingId" in key]
        rows = {name: lens(spark, sf_dir, name, sold_items(spark, sf_dir)) for name in ("search", "details")}
        for name, dealt in rows.items():
            plain = lens(spark, sf_dir, name)
            assert dealt.columns == plain.columns
            assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        prepare(spark)
