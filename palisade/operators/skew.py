"""Joins, ordinals and lists that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.session import written

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE hot keys:
# that is the proven size of the broadcast below.
HOT_SHARE = 500
SPLITS = 32
LIST_ROWS = 10_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], name: str = "_place") -> DataFrame:
    """One row per key. The rank filter makes Spark cut each key to one row per task before the exchange."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) == 1).drop(name)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """The first ``n`` rows per key with their place; also cut to ``n`` per task before the exchange."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def hot_keys(keys_only: DataFrame, keys: list[str]) -> DataFrame:
    """Keys above 1/HOT_SHARE of all rows; fewer than HOT_SHARE of them can exist."""
    counted = keys_only.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = keys_only.agg(F.count(F.lit(1)).alias("_total"))
    return counted.where(F.col("_n") * HOT_SHARE > total.scalar()).select(*keys)


def hot_safe_join(fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner",
                  keys_from: DataFrame | None = None) -> DataFrame:
    """Equi join of a fact side whose keys may be hot with a side of one row per key.

    Rows of a hot key are dealt over SPLITS sub-keys and only the matching dimension rows are copied, so no
    task gets a whole hot key and the rest of the dimension moves once. ``keys_from`` is a cheaper relation to
    count keys on; which keys are called hot changes the speed only, never the result.
    """
    if how not in ("inner", "left"):
        raise ValueError("hot_safe_join keeps the fact side: inner or left")
    hot = F.broadcast(hot_keys((fact if keys_from is None else keys_from).select(*keys), keys).withColumn("_hot", F.lit(True)))
    hashable = [name for name, kind in fact.dtypes if "map<" not in kind and "variant" not in kind]
    deal = F.pmod(F.xxhash64(*hashable), F.lit(SPLITS)).cast("int")
    # Rows with a null key match nothing, so they are dealt out as well.
    spread = F.coalesce(F.col("_hot"), F.lit(False))
    for key in keys:
        spread = spread | F.col(key).isNull()
    left = fact.join(hot, keys, "left").withColumn("_deal", F.when(spread, deal).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SPLITS - 1))).otherwise(F.array(F.lit(0)))
    right = dim.join(hot, keys, "left").withColumn("_deal", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_deal"], how).drop("_deal")


def ordinals(df: DataFrame, keys: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """1-based place of each row inside its key, in ascending order. ``order`` must be unique within a key.

    Give rows that are already reduced to one per (key, order): they are sorted by key, and a sort spills.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def portable_bucket(text: Column, buckets: Column) -> Column:
    """A bucket number any engine can recompute: the first 32 bits of md5, modulo ``buckets``."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), buckets)


def listed(df: DataFrame, keys: list[str], value: str, rows: int = LIST_ROWS) -> DataFrame:
    """Distinct values per key as sorted JSON lists: one list per key, or several parts for a large key.

    A key with n distinct values has ceil(n / rows) parts and a value goes to a part by its hash, so no task
    ever holds a whole large key and no value is left out.
    """
    # Read for the sizes, the hot keys and the lists: what ``df`` takes is done once.
    pairs = written(df.where(F.col(value).isNotNull()).select(*keys, value).distinct(), "listed")
    sizes = pairs.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows).cast("bigint").alias("parts"))
    spread = hot_safe_join(pairs, sizes, keys)
    return (
        spread.withColumn("part", portable_bucket(F.col(value).cast("string"), F.col("parts")))
        .groupBy(*keys, "parts", "part")
        .agg(F.to_json(F.array_sort(F.collect_list(value))).alias("itemsJson"), F.count(F.lit(1)).alias("items"))
    )
