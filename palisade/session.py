"""Session settings the plans rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Naive timestamps are UTC by convention.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a later aggregate then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # ``side_by_side`` sets these two otherwise, for its own query.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.codegen.hugeMethodLimit": "65535",
    # A repeated key keeps its last value, as JSON readers usually do.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cpus: int | str = "*", app: str = "palisade", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PALISADE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created, and give its Python workers this package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    _ship(spark)
    return spark


def side_by_side(spark: SparkSession) -> None:
    """Until the next ``prepare``: sides dealt by one key of a join stay where they are, instead of being dealt again by all its keys.

    Code for very wide rows is kept in methods small enough for the JVM to compile.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    small_methods(spark)


def small_methods(spark: SparkSession) -> None:
    """Until the next ``prepare``: no generated method beyond what the JVM compiles; longer ones would be interpreted."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Once per application: the package as a zip file, so that workers import it wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="palisade-")) / "palisade.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is only chosen on a local master with nothing configured.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="palisade-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and continue from the files.

    Used where a result is read several times or where a value such as a partition number must not
    change when a lost executor makes Spark recompute a stage.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
