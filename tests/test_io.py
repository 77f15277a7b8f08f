import gzip
import json

import pytest
from pyspark.sql import functions as F

from palisade.operators import context, search
from palisade.sources import export, files, sinks
from palisade.streaming import findings as streams

MACHINE = {
    "id": "M77", "assetAbsoluteName": "press-4.plant.test", "assetStatus": {"score": {"hyScoreV2": 612.5}}, "zone": "hall B",
    "operatingSystem": {"primary": "Debian 12"}, "organization": {"businessUnit": "Stamping"},
    "findings": {"searchFindings": [
        7,
        {"id": "W-1", "status": "CLOSED", "hyScoreV2": "88", "solution": "see cve-2031-0042 and CVE-2030-7777", "port": 8443,
         "protocol": "udp", "cvss": {"score": 3.25}, "detectedAt": "2031-05-06T07:08:09-03:00", "dedupInfos": {"IP_ADDRESS": "198.51.100.7"}},
        {"hint": ["nothing to see"]},
        {"findingId": "W-2", "findingStatus": {"status": "OPEN", "score": {"hyScoreV2": 31}}, "port": "21.5", "detectedAt": "soon"}]}}


def check(exported):
    asset = export.normalize_assets(exported).first()
    assert (asset["assetId"], asset["assetHyScoreV2"], asset["assetOsPrimary"], asset["businessUnit"]) == ("M77", 612.5, "Debian 12", "Stamping")
    rows = {r["findingId"]: r for r in export.normalize_findings(export.open_findings(exported)).collect()}
    closed, open_ = rows["W-1"], rows["W-2"]
    assert (closed["cve"], closed["cvssScore"], closed["port"], closed["status"], closed["hyScoreV2"]) == ("CVE-2030-7777", 3.25, 8443, "CLOSED", 88.0)
    assert str(closed["firstSeen"]) == "2031-05-06 10:08:09"
    assert (open_["cve"], open_["port"], open_["firstSeen"], open_["hostname"]) == (None, None, None, "press-4.plant.test")
    assert [r["findingId"] for r in export.finding_id_rows(export.open_findings(exported)).collect()] == ["W-2"]


def test_export_as_lines_and_as_array(spark, tmp_path):
    (tmp_path / "lines.jsonl").write_text(json.dumps(MACHINE) + "\n\n")
    (tmp_path / "array.json").write_text(json.dumps([MACHINE, {"assetId": "M78"}], indent=1))
    check(export.read_lines(spark, str(tmp_path / "lines.jsonl")))
    both = export.read_array(spark, str(tmp_path / "array.json"))
    assert both.count() == 2
    check(both.where("try_variant_get(doc, '$.id', 'string') = 'M77'"))
    assert [r[0] for r in both.select(F.try_variant_get("doc", "$.zone", "string")).collect()] == ["hall B", None]


def test_array_beyond_the_size_of_a_variant(spark, tmp_path):
    filler = "x, ]\\\"[}" + "words " * 600_000
    with open(tmp_path / "large.json", "w") as out:
        out.write("[\n")
        for k in range(40):
            out.write((",\n" if k else "") + json.dumps({"id": f"M{k}", "list": [k, {"a": []}], "pad": filler}))
        out.write("\n]\n")
    assert (tmp_path / "large.json").stat().st_size > 130 << 20
    found = export.read_array(spark, str(tmp_path / "large.json")).select(
        F.try_variant_get("doc", "$.id", "string").alias("id"), F.length(F.try_variant_get("doc", "$.pad", "string")).alias("n"))
    assert {(r["id"], r["n"]) for r in found.collect()} == {(f"M{k}", len(filler)) for k in range(40)}


def test_array_files_of_other_forms(spark, tmp_path):
    texts = {"empty": " [ ] ", "none": "", "object": '{"id":"o","l":[1,2]}\n', "mixed": '\ufeff[1,"a,]\\\\",[2,[3,4]],{"id":"m, \\"n"},null]', "single": '[{"id":"s"}]'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = export.read_array(spark, str(tmp_path)).select(F.to_json("doc")).collect()
    assert sorted(str(r[0]) for r in got) == sorted(['{"id":"o","l":[1,2]}', "1", '"a,]\\\\"', "[2,[3,4]]", '{"id":"m, \\"n"}', "null", '{"id":"s"}'])
    for text, said in {'[{"id":"s"},{"id"': "does not end", '[{"id":"s"}': "does not end", '[{"id":"s"}{}]': "no comma", '[{"id":"s"},]': "MALFORMED"}.items():
        (tmp_path / "cut.json").write_text(text)
        with pytest.raises(Exception, match=said):
            export.read_array(spark, str(tmp_path / "cut.json")).collect()


def test_incremental_files_give_their_findings(spark, tmp_path):
    with gzip.open(tmp_path / "M9.json.gz", "wt") as out:
        json.dump({"asset": {"id": "M9", "hostname": "h9"}, "findings": [{"findingId": "W-5", "status": "OPEN"}, 3]}, out)
    read = export.read_incremental(spark, str(tmp_path))
    row = read.select(F.size("listed").alias("n"), "source").first()
    assert row["n"] == 2 and row["source"].endswith("M9.json.gz")
    found = export.normalize_findings(export.open_findings(read)).collect()
    assert [(r["assetId"], r["hostname"], r["findingId"], r["status"]) for r in found] == [("M9", "h9", "W-5", "OPEN")]


def test_envelope_folder_and_error_log(spark, tmp_path):
    (tmp_path / "f1.json").write_text('{"findingId":"f1","data":{}}')
    (tmp_path / "_report.json").write_text("{}")
    assert [r["source"].split("/")[-1] for r in files.read_envelopes(spark, str(tmp_path)).collect()] == ["f1.json"]
    log = tmp_path / "errors.jsonl"
    log.write_text('{"findingId":"a","httpStatus":404}\n{"findingId":"b","httpStatus":null}\n{"findingId":"c","httpStatus":418}\n')
    assert {r["findingId"]: r["errorType"] for r in files.read_error_log(spark, str(log)).collect()} == {
        "a": "not_found", "b": "network_error", "c": "http_error"}


def test_catalog_layers(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "gold" / "t"))
    (tmp_path / "x.csv").write_text("a\n")
    entries = files.catalog(spark, str(tmp_path))
    gold = entries.where("format = 'PARQUET'").agg(F.sum("rows")).first()[0]
    assert gold == 5
    assert {(r["format"], r["layer"]) for r in entries.where("name NOT LIKE '%.crc' AND name <> '_SUCCESS'").collect()} == {
        ("PARQUET", "gold"), ("CSV", "source")}
    assert files.discover(spark, str(tmp_path)).count() >= 1
    keys = {r["logicalKey"] for r in search.join_keys(files.column_table(spark, {
        "a": spark.createDataFrame([], "assetId string, cve string"), "b": spark.createDataFrame([], "asset_id string")})).collect()}
    assert keys == {"asset_id"}


def test_spreadsheet_cells_and_parts(spark, tmp_path):
    rows = spark.createDataFrame([("=1+1", float("nan"), ["a"]), ("ok", 1.5, [])], "t string, d double, l array<string>")
    cells = sinks.spreadsheet(rows).collect()
    assert cells[0]["t"] == "'=1+1" and cells[0]["d"] is None and cells[0]["l"] == '["a"]'
    index = sinks.write_spreadsheet(spark.range(25).coalesce(1), str(tmp_path / "s"), rows=10).collect()
    assert sorted(r["rows"] for r in index) == [5, 10, 10]


def test_flat_tables_empty_tables_and_run_log(spark, tmp_path):
    nested = spark.createDataFrame([(1, [1, 2], {"k": None})], "id int, l array<int>, m map<string,string>")
    assert [f.dataType.simpleString() for f in sinks.flat(nested).schema] == ["int", "string", "string"]
    assert sinks.flat(nested).first()["m"] == '{"k":null}'
    assert sinks.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    assert sinks.run_entry(spark, "r", "s", "f", {"assets": 1}, ["x"]).first()["status"] == "completed_with_errors"
    assert sinks.run_entry(spark, "r", "s", None, {}, []).first()["status"] == "running"
    sinks.write_report(nested, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report" / "csv")).count() == 1


def test_context_blocks_keep_every_item(spark):
    rows = spark.range(700).select(F.when(F.col("id") < 650, "hot").otherwise("cold").alias("assetId"), "id")
    parts = context.context_blocks({"findings": rows}, rows=50).collect()
    assert max(p["items"] for p in parts) < 150
    ids = sorted(item["id"] for p in parts for item in json.loads(p["itemsJson"]))
    assert ids == list(range(700))


def split_events(spark, sf_dir, folder, n=4):
    """The event table as several input files that arrive out of order."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(n):
        events.where(F.col("event_id") % n == i).coalesce(1).write.parquet(str(folder / f"in{i}"))
    return str(folder) + "/in*"


def test_states_over_several_batches_equal_one_batch(spark, sf_dir, tmp_path):
    many = streams.run_states(spark, split_events(spark, sf_dir, tmp_path), files="*.parquet", per_batch=1)
    whole = streams.run_states(spark, sf_dir)
    assert sorted(map(str, many.select(*sorted(many.columns)).collect())) == sorted(
        map(str, whole.select(*sorted(whole.columns)).collect()))


def test_ingest_resumes_without_repeating(spark, tmp_path):
    events = spark.range(10).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    events.where("event_id < 5").write.parquet(source)
    streams.ingest(streams.event_stream(spark, source, "*.parquet").drop("at"), out, checkpoint)
    events.where("event_id >= 5").write.mode("append").parquet(source)
    streams.ingest(streams.event_stream(spark, source, "*.parquet").drop("at"), out, checkpoint)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == list(range(10))


def test_late_events_of_a_later_batch_count(spark, sf_dir, tmp_path):
    folder = split_events(spark, sf_dir, tmp_path)
    many = streams.run_daily_counts(spark, folder, per_batch=1, files="*.parquet")
    whole = streams.run_daily_counts(spark, sf_dir)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, whole.collect()))
    assert streams.run_dedup(spark, folder, files="*.parquet", per_batch=1).count() == streams.run_dedup(spark, sf_dir).count()


def test_workers_find_the_package_from_another_folder(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    code = ("import sys; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
            "print('ROWS', e.queries()['document_cves'](spark, e.SMOKE_DIR).count())")
    run = subprocess.run([sys.executable, "-c", code, str(Path(__file__).resolve().parents[1])], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS" in run.stdout, run.stderr[-2000:]
