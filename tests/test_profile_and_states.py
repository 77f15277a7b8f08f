"""Dataset profile from stored sketches, and strict states whose quiet keys are cleared."""

import json

import pytest
from pyspark.sql import functions as F

from palisade.sources import dataset_profile as dp
from palisade.streaming import findings as streams
from palisade.streaming import quiet_keys as quiet


@pytest.fixture
def parts(spark, tmp_path):
    """A dataset of two files: ids 0-999 with ten kinds, one of them in half of the rows."""
    rows = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, "common").otherwise(F.concat(F.lit("kind"), (F.col("id") % 9).cast("string"))).alias("kind"),
        F.when(F.col("id") < 100, F.col("id") / 4).alias("score"), F.array("id").alias("list"), F.lit("h").alias("FQDN"))
    path = str(tmp_path / "data")
    rows.where("id < 600").coalesce(1).write.parquet(path)
    return rows, path


def test_profile_counts_estimates_and_new_files(spark, parts, tmp_path):
    rows, path = parts
    store, data = str(tmp_path / "store"), {"d": path}
    assert dp.update(spark, store, data) == 1
    assert dp.update(spark, store, data) == 0
    rows.where("id >= 600").coalesce(1).write.mode("append").parquet(path)
    assert dp.update(spark, store, data) == 1
    got = {r["column"]: r for r in dp.profile(spark, store, data).collect()}
    assert [got[c]["place"] for c in rows.columns] == list(range(5))
    assert {r["rows"] for r in got.values()} == {1000}
    assert (got["score"]["nullCount"], got["score"]["nullPct"], got["id"]["nullCount"]) == (900, 90.0, 0)
    assert abs(got["id"]["distinctEstimate"] - 1000) <= 50 and got["kind"]["distinctEstimate"] == 10
    low, _, middle, _, high = got["id"]["quantiles"]
    assert (low, high) == (0.0, 999.0) and abs(middle - 500) <= 40
    assert got["kind"]["quantiles"] is None and got["score"]["quantiles"][-1] == 24.75
    assert (got["kind"]["topValues"][0]["item"], got["kind"]["topValues"][0]["count"]) == ("common", 500)
    assert got["FQDN"]["usefulKey"] == "hostname" and got["id"]["usefulKey"] is None
    assert [r["column"] for r in dp.high_null_columns(dp.profile(spark, store, data)).collect()] == ["score"]


def test_samples_are_the_smallest_hashes_of_the_whole(spark, parts, tmp_path):
    rows, path = parts
    store, data = str(tmp_path / "store"), {"d": path}
    dp.update(spark, store, data, sample=4, keys={"d": "id"})
    rows.where("id >= 600").coalesce(2).write.mode("append").parquet(path)
    dp.update(spark, store, data, sample=4, keys={"d": "id"})
    # A run that broke off between samples and sketches is made up: its samples are there twice.
    dp.sample_rows(spark.read.parquet(path), "d", 4, "id").write.mode("append").parquet(f"{store}/samples")
    want = [r["id"] for r in rows.orderBy(F.md5(F.col("id").cast("string"))).limit(4).collect()]
    assert [json.loads(r["row"])["id"] for r in dp.samples(spark, store, data, 4).orderBy("n").collect()] == want


def test_replaced_files_new_columns_and_no_rows(spark, tmp_path):
    path, none, store = str(tmp_path / "my data=1%"), str(tmp_path / "none"), str(tmp_path / "store")
    data = {"d": path, "none": none}
    spark.createDataFrame([], "a int, b string").coalesce(1).write.parquet(none)
    spark.createDataFrame([(1, "x" * 100), (2, "x" * 99 + "y")], "a int, b string").coalesce(1).write.parquet(path)
    dp.update(spark, store, data)
    spark.createDataFrame([(7, None, True)], "a int, b string, extra boolean").coalesce(1).write.mode("append").parquet(path)
    dp.update(spark, store, data)
    got = {(r["dataset"], r["column"]): r for r in dp.profile(spark, store, data).collect()}
    assert [got["d", c]["nullCount"] for c in ("a", "b", "extra")] == [0, 1, 2]
    assert got["d", "b"]["distinctEstimate"] == 2
    assert (got["none", "a"]["rows"], got["none", "a"]["nullPct"], got["none", "a"]["topValues"]) == (0, None, None)
    spark.createDataFrame([(9, "z")], "a int, b string").coalesce(1).write.mode("overwrite").parquet(path)
    dp.update(spark, store, data)
    got = {(r["dataset"], r["column"]): r for r in dp.profile(spark, store, data).collect()}
    assert (got["d", "a"]["rows"], got["d", "a"]["quantiles"][0], ("d", "extra") in got) == (1, 9.0, False)


def write_events(spark, rows, path):
    frame = spark.createDataFrame(rows, "event_id long, seconds long, user_id long, event_type string")
    frame.select("event_id", F.timestamp_seconds("seconds").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
                 F.lit(1.0).alias("value"), F.lit("{}").alias("props")).coalesce(1).write.parquet(path)


def truth(rows):
    """Strict states from the definition: whole series, ordered by time and id."""
    found = {}
    for user in {r[2] for r in rows}:
        series = sorted((r[1], r[0], r[3] is not None and r[3] != "error") for r in rows if r[2] == user)
        hits, last = [h for _, _, h in series], series[-1][2]
        first = {flag: min((t for t, _, h in series if h == flag), default=None) for flag in (True, False)}
        if len(hits) == 1:
            state = "NEW" if last else "UNKNOWN"
        elif last and not all(hits[:-1]) and None not in first.values() and first[True] < first[False]:
            state = "REOPENED"
        elif not last and any(hits[:-1]):
            state = "RESOLVED"
        else:
            state = "PERSISTENT" if all(hits) else "UNKNOWN"
        found[user] = (len(hits), sum(hits), last, state)
    return found


@pytest.mark.parametrize("quiet_ms", [1, 3_600_000])
def test_batches_out_of_order_with_and_without_clearing(spark, tmp_path, quiet_ms):
    kinds = ["view", "error", "click", None]
    rows = [(i, (i * 37) % 211, None if i % 29 == 0 else (1 if i % 3 == 0 else i % 23), kinds[(i * i + i // 7) % 4]) for i in range(300)]
    rows += [(1000, 5, 777, "view"), (1001, 9, 778, "view"), (1002, 12, 778, "error"), (1003, 15, 778, "view"), (1003, 15, 778, "view")]
    for part in range(5):
        write_events(spark, [r for r in rows if (r[0] * 7) % 5 == part], str(tmp_path / f"in{part}"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = streams.event_stream(spark, str(tmp_path) + "/in*", "*.parquet", per_batch=1)
    run = quiet.advance_states(stream, out, checkpoint, quiet_ms)
    got = {r["user_id"]: tuple(r)[1:] for r in quiet.strict_states(spark, out).collect()}
    assert got == truth(rows)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    seen = len({r[2] for r in rows})
    if quiet_ms == 1:
        assert held[-1] < seen
    else:
        assert max(held) == seen
    changes = quiet.state_changes(spark, out)
    assert changes.where("previous = state").count() == 0 and changes.where("previous IS NULL").count() >= seen
    # The job goes on from its checkpoint: nothing is counted twice, and a key that was cleared comes back.
    more = [(2000, 300, 777, "error"), (2001, 301, 1, "view")]
    write_events(spark, more, str(tmp_path / "in9"))
    quiet.advance_states(stream, out, checkpoint, quiet_ms)
    got = {r["user_id"]: tuple(r)[1:] for r in quiet.strict_states(spark, out).collect()}
    assert got == truth(rows + more) and got[777][3] == "RESOLVED"


def test_a_batch_that_is_run_again_replaces_its_folder(spark, tmp_path):
    rows = [(i, i, i % 4, "error" if i % 5 == 2 else "view") for i in range(40)]
    for part in range(2):
        write_events(spark, [r for r in rows if r[0] % 2 == part], str(tmp_path / f"in{part}"))
    out, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    stream = streams.event_stream(spark, str(tmp_path) + "/in*", "*.parquet", per_batch=1)
    quiet.advance_states(stream, out, str(checkpoint), 1)
    before = quiet.strict_states(spark, out).collect()
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()  # as if the driver was lost after the batch was written and before it was committed
    for crc in (checkpoint / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    quiet.advance_states(stream, out, str(checkpoint), 1)
    after = quiet.strict_states(spark, out).collect()
    assert sorted(map(str, after)) == sorted(map(str, before))
    assert {r["user_id"]: tuple(r)[1:] for r in after} == truth(rows)
