"""Strict history states with per-key state that is cleared when a key has been quiet for a while.

The counters of a key merge in any order, so a key that was cleared and comes back opens a new segment, and the merged
segments are the whole history: clearing loses nothing and the state holds the active keys only.

Defined cases: a null key is a key of its own; an event without type is a miss; without time or id it sorts first; repeated
events count each time; events may arrive in any order and in any batch; no input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from palisade.functions.scoring import series_state
from palisade.session import new_folder
from palisade.streaming.findings import event_stream

NEVER, ALWAYS = 2 ** 63 - 1, -(2 ** 63)
FIELDS = ("n", "hits", "lastAt", "lastId", "lastHit", "firstHit", "firstMiss")
COUNTERS = "n long, hits long, lastAt long, lastId long, lastHit boolean, firstHit long, firstMiss long"


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of counters per key and Arrow batch, so that a hot key doesn't send its events to one task."""
    for batch in batches:
        events = pa.Table.from_batches([batch]).sort_by([("lastAt", "ascending"), ("lastId", "ascending")])
        counted = events.group_by("user_id", use_threads=False).aggregate([
            ("n", "sum"), ("hits", "sum"), ("lastAt", "last"), ("lastId", "last"), ("lastHit", "last"),
            ("firstHit", "min"), ("firstMiss", "min")])
        names = {"n_sum": "n", "hits_sum": "hits", "lastAt_last": "lastAt", "lastId_last": "lastId", "lastHit_last": "lastHit",
                 "firstHit_min": "firstHit", "firstMiss_min": "firstMiss"}
        counted = counted.rename_columns([names.get(c, c) for c in counted.column_names])
        yield from counted.select(["user_id", *FIELDS]).to_batches()


def _merged(a: tuple, b: tuple) -> tuple:
    newest = max(a, b, key=lambda x: x[2:4])
    return (a[0] + b[0], a[1] + b[1], *newest[2:5], min(a[5], b[5]), min(a[6], b[6]))


def _advance(quiet_ms: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()  # the key's last counters were written with its last batch
            return
        fresh, counters = not state.exists, None if not state.exists else tuple(state.get)
        for frame in frames:
            for row in frame[list(FIELDS)].itertuples(index=False, name=None):
                counters = row if counters is None else _merged(counters, row)
        counters = (*map(int, counters[:4]), bool(counters[4]), *map(int, counters[5:]))
        state.update(counters)
        state.setTimeoutDuration(quiet_ms)
        row = pd.DataFrame([counters], columns=list(FIELDS))
        row.insert(0, "user_id", pd.array([None if pd.isna(key[0]) else int(key[0])], dtype="Int64"))
        yield row.assign(fresh=fresh)

    return step


def segments(stream: DataFrame, quiet_ms: int) -> DataFrame:
    """Counters of every touched key after each batch; ``fresh`` marks the first row of a segment."""
    hit, at = F.coalesce(F.col("event_type") != "error", F.lit(False)), F.coalesce(F.unix_micros("at"), F.lit(ALWAYS))
    rows = stream.select(
        "user_id", F.lit(1).cast("long").alias("n"), hit.cast("long").alias("hits"), at.alias("lastAt"),
        F.coalesce("event_id", F.lit(ALWAYS)).alias("lastId"), hit.alias("lastHit"),
        F.when(hit, at).otherwise(F.lit(NEVER)).alias("firstHit"), F.when(hit, F.lit(NEVER)).otherwise(at).alias("firstMiss"))
    partial = rows.mapInArrow(_combined, f"user_id long, {COUNTERS}")
    return partial.groupBy("user_id").applyInPandasWithState(
        _advance(quiet_ms), f"user_id long, {COUNTERS}, fresh boolean", COUNTERS, "update", GroupStateTimeout.ProcessingTimeTimeout)


def advance_states(stream: DataFrame, out: str, checkpoint: str, quiet_ms: int) -> StreamingQuery:
    """Run to the end of the input; a repeated batch replaces the folder it wrote."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    conf, setting = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(setting)
    conf.set(setting, "false")  # with timeouts by the clock, batches without data would follow each other for ever
    try:
        query = segments(stream, quiet_ms).writeStream.foreachBatch(write).outputMode("update").option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(setting, before)  # the started query keeps its own copy of the settings
    query.awaitTermination()
    return query


def _rows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"user_id long, {COUNTERS}, fresh boolean, batch long").parquet(out)


def _state() -> Column:
    return series_state(F.col("n"), F.col("hits"), F.col("lastHit"), strict=True, hit_before_miss=F.col("firstHit") < F.col("firstMiss"))


def strict_states(spark: SparkSession, out: str) -> DataFrame:
    """(user_id, n, hits, lastHit, state) of every key that was ever seen: the ends of its segments, merged."""
    later = Window.partitionBy("user_id").orderBy("batch")
    ends = _rows(spark, out).withColumn("next", F.lead("fresh").over(later)).where("coalesce(next, true)")
    whole = ends.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max_by("lastHit", F.struct("lastAt", "lastId")).alias("lastHit"),
        F.min("firstHit").alias("firstHit"), F.min("firstMiss").alias("firstMiss"))
    return whole.select("user_id", "n", "hits", "lastHit", _state().alias("state"))


def state_changes(spark: SparkSession, out: str) -> DataFrame:
    """(batch, user_id, previous, state): keys whose open segment changed its state; ``previous`` is null where a segment opens."""
    by_key = Window.partitionBy("user_id").orderBy("batch")
    rows = _rows(spark, out).withColumn("state", _state())
    rows = rows.withColumn("previous", F.when(~F.col("fresh"), F.lag("state").over(by_key)))
    return rows.where("previous IS NULL OR previous <> state").select("batch", "user_id", "previous", "state")


def run_strict_states(spark: SparkSession, folder: str, files: str = "events.parquet", per_batch: int | None = None,
                      quiet_ms: int = 3_600_000) -> DataFrame:
    out = new_folder(spark, "segments")
    advance_states(event_stream(spark, folder, files, per_batch), out, new_folder(spark, "cp"), quiet_ms)
    return strict_states(spark, out)
