"""Session start and the shared folder for tables written between stages."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def start_session(app_name: str, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` adds or overrides settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, or a local one where none is named (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context = spark.sparkContext
    if not hasattr(context, "_tastegraph_folder"):
        context._tastegraph_folder = tempfile.mkdtemp(prefix="tastegraph-")
    return context._tastegraph_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that later steps read more than once, and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what is stored.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(*tables: DataFrame) -> None:
    """Delete the folders that ``stage`` wrote for tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        root = shared_folder(spark).rstrip("/")
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.Path(name)
            if jvm.Path(root).toUri().getPath() == path.getParent().toUri().getPath():
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for clusters that do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tastegraph_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tastegraph-code-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._tastegraph_shipped = True
