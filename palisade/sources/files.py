"""Detail documents on disk, error logs, dataset discovery and the dataset catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.text import http_error_type

NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
LAYERS = ("bronze", "silver", "gold", "exports")


def read_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per detail document with its path; names that start with ``_`` are no documents."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder)
    named = files.select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_name").alias("name"))
    return named.where(~F.col("name").startswith("_")).drop("name")


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines error log with the error type derived from the status."""
    rows = spark.read.schema(
        "findingId string, assetId string, timestamp string, httpStatus int, message string, retryCount int").json(path)
    return rows.withColumn("errorType", http_error_type(F.col("httpStatus")))


def discover(spark: SparkSession, root: str, suffix: str = "parquet", excluded: tuple[str, ...] = ("smoke",)) -> DataFrame:
    """Data files below a folder with their sizes, without reading them; excluded folder names are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", f"*.{suffix}").load(root).select("path", "length")
    skip = F.lit(False)
    for name in excluded:
        skip = skip | F.col("path").contains(f"/{name}/")
    return files.where(~skip).distinct()


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """Name, format, layer, size, rows and fields of every dataset below a folder: a file, or a folder of part files.

    Schemas and row counts come from the file footers; the loop is over datasets, not over their files or rows.
    """
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    folder = F.regexp_extract("path", r"^(.*\.parquet)/[^/]+$", 1)
    files = parts.groupBy(F.coalesce(F.nullif(folder, F.lit("")), F.col("path")).alias("path")).agg(F.sum("length").alias("length"))
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    lowered, layer = F.lower("path"), None
    for name in LAYERS:
        hit = lowered.contains(f"/{name}/")
        layer = F.when(hit, name) if layer is None else layer.when(hit, name)
    described = files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path",
        F.upper(F.coalesce(F.nullif(suffix, F.lit("")), F.lit("file"))).alias("format"),
        layer.otherwise("source").alias("layer"), F.col("length").alias("sizeBytes"))
    rows, fields = None, []
    for file in described.where("format = 'PARQUET'").select("path").toLocalIterator():
        data = spark.read.parquet(file["path"])
        counted = data.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(file["path"]).alias("path"), "rows")
        rows = counted if rows is None else rows.unionByName(counted)
        fields += [(file["path"], i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(data.schema)]
    if rows is None:
        return described.withColumns({"rows": F.lit(None).cast("bigint"), "fields": F.lit("")})
    listed = spark.createDataFrame(fields, "path string, place int, field string, type string, nullable boolean")
    texts = listed.groupBy("path").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "field", "type"))), lambda x: F.concat(x["field"], F.lit(":"), x["type"])),
        " ").alias("fields"))
    return described.join(rows, "path", "left").join(texts, "path", "left")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose Parquet counts come from file footers."""
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers


def footer_counts(footers: SparkSession, path: str) -> tuple[T.StructType, DataFrame]:
    """The schema of a dataset, and one row of its row count and the non-null count of every flat column."""
    data = footers.read.parquet(path)
    flat = [f.name for f in data.schema if not isinstance(f.dataType, NESTED)]
    return data.schema, data.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{n}`")).alias(n) for n in flat])


def footer_report(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """(dataset, field, type, nested, rows, nonNull, nullPercent) of every column of Parquet datasets below a folder; none of a missing one.

    Row and null counts come from the file footers by aggregate push-down; no data page is read. The loop is over datasets. Nested
    columns have no null count in a footer.
    """
    footers, rows = footer_session(spark), []
    for name in names:
        try:
            schema, counts = footer_counts(footers, f"{root}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        counted = {k: n or 0 for k, n in counts.first().asDict().items()}
        rows += [(name, i, f.name, f.dataType.simpleString(), f.name not in counted, counted["_rows"], counted.get(f.name))
                 for i, f in enumerate(schema)]
    table = spark.createDataFrame(rows, "dataset string, place int, field string, type string, nested boolean, rows long, nonNull long")
    return table.withColumn("nullPercent", F.when(F.col("rows") > 0, F.round(100.0 * (F.col("rows") - F.col("nonNull")) / F.col("rows"), 2)))


def catalog_totals(entries: DataFrame) -> DataFrame:
    return entries.agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.coalesce("rows", F.lit(0))).alias("rows"), F.sum("sizeBytes").alias("bytes"))


def catalog_search(entries: DataFrame, layer: str = "", needle: str = "") -> DataFrame:
    """Entries of a layer whose name, path or field names contain a text."""
    rows = entries.where(F.col("layer") == layer) if layer else entries
    text = F.lower(F.concat_ws(" ", "name", "path", F.regexp_replace(F.coalesce("fields", F.lit("")), r":\S+", "")))
    return rows.where(text.contains(needle.strip().lower())) if needle.strip() else rows


def column_table(spark: SparkSession, datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column) of every dataset, from schemas only."""
    return spark.createDataFrame(
        [(name, column) for name, df in datasets.items() for column in df.columns], "dataset string, column string")
