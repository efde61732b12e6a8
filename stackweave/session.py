"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid
from functools import cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator here relies on. Partition counts and memory belong to
# the cluster and are left as they are.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Texts are long: what a Python worker holds at once is bounded by bytes as well as rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}

STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Sessions of a busy process are merged inside each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


@cache
def _send_package(application: str) -> None:
    """Hand this package to Spark, which copies it to the Python workers of all executors.

    Without it the codecs and stateful operators would only run where the package is
    installed or the workers happen to start in its folder.
    """
    package = pathlib.Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(pathlib.Path(tempfile.mkdtemp(prefix="stackweave-code-")) / "stackweave"),
        "zip",
        root_dir=package.parent,
        base_dir=package.name,
    )
    context = SparkContext.getOrCreate()
    context.addPyFile(archive)
    # The worker that starts a stateful stream runs beside the driver and gets no files.
    known = context.environment.get("PYTHONPATH")
    context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(package.parent), known]))


def prepare(spark: SparkSession, streaming: bool = False) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    _send_package(spark.sparkContext.applicationId)
    for key, value in {**RUNTIME, **(STREAMING if streaming else {})}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, name: str = "stackweave", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME, **STREAMING, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _send_package(spark.sparkContext.applicationId)
    return spark


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="stackweave-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(context.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several branches read, and read it back.

    Each branch then scans the columns it needs, and losing an executor costs a rescan
    instead of the whole lineage.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
