"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows and bytes of one Arrow batch: a Python worker holds one batch of texts, however long single texts are.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare_arrow(spark: SparkSession) -> SparkSession:
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. ASCII texts take the fast built-in, which changes the same letters there."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_key(text: Column, doc_id: Column) -> Column:
    """A key of a document row: the id with the text's hash. Rows that repeat share it, other rows of one id don't."""
    return F.struct(F.coalesce(doc_id, F.lit(-(2**63))).alias("id"), F.xxhash64(text).alias("h"))


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it has at most ``rows`` rows, else as it is.

    The count is one job over ``df``; give a written table. Beyond the bound Spark joins by shuffle.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spaced_words(text: Column) -> Column:
    """The maximal runs of other than space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
