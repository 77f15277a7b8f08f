"""Profile of Parquet datasets from sketches that are kept per file and merged: a new file costs only itself.

Exact: rows, null counts, smallest and largest number, sample rows. Estimates: distinct values (HyperLogLog), quantiles (KLL)
and frequent values with their counts. Estimates of quantiles may differ between runs.

Defined cases: a dataset without rows keeps its columns with zero rows and null figures; a column that older files lack counts as
null there; nested columns are profiled by their JSON text; texts over 64 characters are counted as their first 31 characters
and their hash, so that different texts stay different; NaN takes no part in the quantiles; replaced and removed files no longer count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade import fixed_values as fixed
from palisade.sources.files import NESTED

SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)
VERSION = ("file", "size", "modified")
#: Values followed for the frequent ones; a count is off by at most about 3.5 / TRACKED of the rows of a file.
TRACKED = 1000


def _version() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified")]


def listing(spark: SparkSession, path: str) -> DataFrame:
    """The data files of a dataset with size and time of change; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", *_version())


def _text(name: str, kind: T.DataType) -> Column:
    column = F.col(name)
    text = F.to_json(F.struct(column.alias("v"))) if isinstance(kind, NESTED) else column.cast("string")
    text = F.when(column.isNotNull(), text)
    return F.when(F.length(text) <= 64, text).otherwise(F.concat(F.left(text, F.lit(31)), F.lit("#"), F.md5(text)))


def column_sketches(df: DataFrame, dataset: str) -> DataFrame:
    """One row per file and column: row count, filled values and the sketches, from one pass over the rows."""
    fields = df.schema.fields
    places = df.select(*_version(), *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)])
    per_file = places.groupBy(*VERSION).agg(F.count(F.lit(1)).alias("rows"), *[F.struct(
        F.lit(f.name).alias("column"), F.count(f"c{i}").alias("nonNull"),
        F.hll_sketch_agg(_text(f"c{i}", f.dataType), 12).alias("distinct"),
        (F.kll_sketch_agg_double(F.col(f"c{i}").cast("double")) if isinstance(f.dataType, T.NumericType)
         else F.lit(None).cast("binary")).alias("numbers"),
        F.call_function("approx_top_k_accumulate", _text(f"c{i}", f.dataType), F.lit(TRACKED)).alias("frequent"),
    ).alias(f"s{i}") for i, f in enumerate(fields)])
    listed = per_file.select(*VERSION, "rows", F.explode(F.array(*[f"s{i}" for i in range(len(fields))])).alias("s"))
    return listed.select(F.lit(dataset).alias("dataset"), *VERSION, "rows", "s.*")


def sample_rows(df: DataFrame, dataset: str, size: int, key: str | None = None) -> DataFrame:
    """The rows of each file with the smallest hash of the row, or of a key; the smallest of all files are the dataset's."""
    row = F.to_json(F.struct(*[F.col(f"`{n}`") for n in df.columns]), {"ignoreNullFields": "false"})
    place = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) if key else F.md5(row)
    rows = df.select(F.lit(dataset).alias("dataset"), *_version(), place.alias("place"), row.alias("row"))
    rank = F.row_number().over(Window.partitionBy(*VERSION).orderBy("place", "row"))
    return rows.withColumn("nth", rank).where(F.col("nth") <= size)


def _known(spark: SparkSession, store: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{store}/columns").select("dataset", *VERSION).distinct()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "dataset string, file string, size long, modified timestamp")


def update(spark: SparkSession, store: str, datasets: dict[str, str], sample: int = 3, keys: dict[str, str] | None = None) -> int:
    """Profile the files that the store doesn't hold yet, and return how many there were.

    Samples are written before the sketches that mark a file as known, so a run that breaks off is made up by the next one.
    The driver holds the paths of the new files of one dataset, as Spark's own file index does.
    """
    done = 0
    for name, path in datasets.items():
        known = _known(spark, store).where(F.col("dataset") == name)
        new = [r["path"] for r in listing(spark, path).join(known, list(VERSION), "left_anti").select("path").collect()]
        if not new:
            continue
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
        data = spark.read.schema(schema).parquet(*new)
        sample_rows(data, name, sample, (keys or {}).get(name)).write.mode("append").parquet(f"{store}/samples")
        column_sketches(data, name).write.mode("append").parquet(f"{store}/columns")
        done += len(new)
    return done


def _current(spark: SparkSession, stored: DataFrame, datasets: dict[str, str]) -> DataFrame:
    files = None
    for name, path in datasets.items():
        rows = listing(spark, path).withColumn("dataset", F.lit(name))
        files = rows if files is None else files.unionByName(rows)
    return stored.join(files, ["dataset", *VERSION], "left_semi")


def _useful(column: str) -> str | None:
    """The logical key that a column spells, if any."""
    return next((key for key, names in fixed.KEY_ALIASES.items() if column.lower() in [n.lower() for n in names]), None)


def profile(spark: SparkSession, store: str, datasets: dict[str, str], top: int = 3) -> DataFrame:
    """One row per column of each dataset, from the stored sketches of the files that are there now; no data file is read."""
    stored = _current(spark, spark.read.parquet(f"{store}/columns"), datasets).dropDuplicates(["dataset", *VERSION, "column"])
    merged = stored.groupBy("dataset", "column").agg(
        F.sum("nonNull").alias("nonNull"), F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("numbers").alias("numbers"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"))
    totals = stored.select("dataset", *VERSION, "rows").distinct().groupBy("dataset").agg(F.sum("rows").alias("rows"))
    fields = [(name, i, f.name, f.dataType.simpleString(), _useful(f.name)) for name, path in datasets.items()
              for i, f in enumerate(spark.read.option("mergeSchema", True).parquet(path).schema)]
    columns = spark.createDataFrame(fields, "dataset string, place int, column string, type string, usefulKey string")
    rows, filled = F.coalesce("rows", F.lit(0)), F.coalesce("nonNull", F.lit(0))
    numbers = F.when(F.kll_sketch_get_n_double("numbers") > 0, F.col("numbers"))
    return columns.join(totals, "dataset", "left").join(merged, ["dataset", "column"], "left").select(
        "dataset", "place", "column", "type", "usefulKey", rows.alias("rows"), (rows - filled).alias("nullCount"),
        F.when(rows > 0, F.round(100 * (rows - filled) / rows, 2)).alias("nullPct"),
        F.hll_sketch_estimate("distinct").alias("distinctEstimate"),
        F.kll_sketch_get_quantile_double(numbers, F.array(*map(F.lit, SHARES))).alias("quantiles"),
        F.when(filled > 0, F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top))).alias("topValues"))


def high_null_columns(profiled: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Columns of datasets with rows whose share of nulls reaches the threshold."""
    return profiled.where((F.col("rows") > 0) & (F.col("nullCount") / F.col("rows") >= threshold))


def samples(spark: SparkSession, store: str, datasets: dict[str, str], size: int = 3) -> DataFrame:
    """(dataset, n, row): the sample rows of each dataset from those of its files, equal rows as often as they occur there."""
    stored = spark.read.parquet(f"{store}/samples")
    newest = _current(spark, stored, datasets).dropDuplicates(["dataset", *VERSION, "nth"])  # a run made up writes its samples again
    rank = F.row_number().over(Window.partitionBy("dataset").orderBy("place", "row", "file"))
    return newest.withColumn("n", rank).where(F.col("n") <= size).select("dataset", "n", "row")
