"""Structured Streaming over raw files and audit events.

Every job runs to the end of its input with ``availableNow`` and can be started again from its checkpoint: files that
were read are not read twice, and a rerun of a batch replaces that batch's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions.scoring import series_state
from palisade.session import new_folder

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, files: str = "events.parquet", per_batch: int | None = None) -> DataFrame:
    """Audit events as a stream, with the event time that watermarks need."""
    reader = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", files)
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder).withColumn("at", F.col("ts").cast("timestamp"))


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Exactly-once copy of new input files into a Parquet table."""
    _run(stream.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint)


def _by_batch(stream: DataFrame, out: str, checkpoint: str, mode: str) -> None:
    """Write each batch into its own folder; a repeated batch overwrites its folder."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    _run(stream.writeStream.foreachBatch(write).outputMode(mode), checkpoint)


def newest_per_key(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last written state of each key."""
    rows = spark.read.parquet(out)
    values = [name for name in rows.columns if name not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def daily_counts(stream: DataFrame) -> DataFrame:
    """Events per day and type: ordinary aggregates with one small state row per day and type, so late events count in any batch."""
    return stream.groupBy(
        F.window("at", "1 day").alias("day"), "event_type"
    ).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("misses")).select(
        F.date_format("day.start", "yyyy-MM-dd").alias("day"), "event_type", "events", "misses")


def run_daily_counts(spark: SparkSession, folder: str, per_batch: int | None = None, files: str = "events.parquet") -> DataFrame:
    """Updated windows are written per batch, and the newest row of each is the result: no window and no late event is left out."""
    out = new_folder(spark, "daily")
    _by_batch(daily_counts(event_stream(spark, folder, files, per_batch)), out, new_folder(spark, "cp"), "update")
    return newest_per_key(spark, out, ["day", "event_type"])


def running_states(stream: DataFrame) -> DataFrame:
    """Counters that decide the history state of each entity.

    They are ordinary aggregates, so Spark combines a hot entity in the map tasks and keeps one small state row
    per entity; late events are counted too, whatever the batch they come in.
    """
    hit = F.col("event_type") != "error"
    return stream.withColumn("hit", hit).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"),
        F.max_by("hit", F.struct("ts", "event_id")).alias("last"))


def run_states(spark: SparkSession, folder: str, files: str = "events.parquet", per_batch: int | None = None) -> DataFrame:
    out = new_folder(spark, "states")
    _by_batch(running_states(event_stream(spark, folder, files, per_batch)), out, new_folder(spark, "cp"), "update")
    newest = newest_per_key(spark, out, ["user_id"])
    return newest.withColumn("state", series_state(F.col("n"), F.col("hits"), F.col("last")))


def run_ingest(spark: SparkSession, folder: str, files: str = "events.parquet") -> DataFrame:
    out = new_folder(spark, "ingested")
    ingest(event_stream(spark, folder, files).drop("at"), out, new_folder(spark, "cp"))
    return spark.read.schema(EVENT_SCHEMA).parquet(out)


def run_dedup(spark: SparkSession, folder: str, key: str = "event_id", delay: str | None = None, files: str = "events.parquet",
              per_batch: int | None = None) -> DataFrame:
    """Events with the first copy of each id kept, whatever the batch it comes in.

    The state is one key per id. With a ``delay`` it is held for that long only; copies that are further apart are then
    both kept, and events later than the delay are dropped: that is the feature of a bounded state.
    """
    out = new_folder(spark, "distinct")
    stream = event_stream(spark, folder, files, per_batch)
    if delay is None:
        stream = stream.dropDuplicates([key])
    else:
        stream = stream.withWatermark("at", delay).dropDuplicatesWithinWatermark([key])
    ingest(stream.drop("at"), out, new_folder(spark, "cp"))
    return spark.read.schema(EVENT_SCHEMA).parquet(out)
