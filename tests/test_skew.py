from collections import Counter

from pyspark.sql import functions as F

from palisade.operators import skew


def hot_rows(spark):
    """A third of the rows share one key, some have none."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 700)
        .alias("k"), F.col("id").alias("v"))


def test_hot_keys_are_few(spark):
    assert [r["k"] for r in skew.hot_keys(hot_rows(spark).select("k").where("k IS NOT NULL"), ["k"]).collect()] == [-1]


def test_hot_safe_join_equals_plain_join(spark):
    fact = hot_rows(spark)
    dim = spark.range(-1, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    for how in ("inner", "left"):
        plain = fact.join(dim, "k", how).select("k", "v", "d").collect()
        safe = skew.hot_safe_join(fact, dim, ["k"], how).select("k", "v", "d").collect()
        assert Counter(map(tuple, plain)) == Counter(map(tuple, safe))


def test_first_per_key_cuts_before_the_exchange(spark):
    plan = skew.first_per_key(hot_rows(spark), ["k"], [F.col("v").desc()])._jdf.queryExecution().toString()
    physical = plan.split("Physical Plan")[1]
    assert "row_number(), 1, Partial" in physical
    assert physical.index("Partial") > physical.index("Exchange")


def test_ordinals_count_in_order_and_run_no_job_when_planned(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    spark.sparkContext.setJobGroup("ordinals", "planning")
    numbered = skew.ordinals(rows, ["k"], ["t"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ordinals")
    by_key = {}
    for r in sorted(numbered.collect(), key=lambda r: r["t"]):
        by_key.setdefault(r["k"], []).append(r["ordinal"])
    assert all(own == list(range(1, len(own) + 1)) for own in by_key.values())


def test_listed_splits_large_keys_and_keeps_everything(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, "big").otherwise("small").alias("k"),
                                    (F.col("id") % 800).cast("string").alias("v"))
    parts = skew.listed(rows, ["k"], "v", rows=100).collect()
    import json

    items = {}
    for part in parts:
        items.setdefault(part["k"], []).extend(json.loads(part["itemsJson"]))
        assert part["items"] < 200
    assert sorted(items["big"]) == sorted(str(i) for i in range(800))
    assert len([p for p in parts if p["k"] == "small"]) == 1
