"""Session settings the operators are written for."""

from __future__ import annotations

import uuid
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split even where the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(app="millrace", master=None, shuffle_partitions=None, extra=None):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ship(spark):
    """Give the workers this package, from whatever folder the driver was started; once per application.

    The archive lies in the driver's own folder of shipped files, from where Spark serves it.
    """
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(SparkFiles.getRootDirectory()) / "source" / "millrace.zip"
    archive.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._millrace_shipped = True


def scratch(spark, label):
    """Fresh folder for written tables in a place that driver and executors share.

    That is the session's ``spark.checkpoint.dir``, or else its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    if not folder:
        raise ValueError("set spark.checkpoint.dir or spark.sql.warehouse.dir to a folder that all machines share")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df, label):
    """Write ``df`` once as Parquet to a fresh shared folder and read it back.

    For a costly table that a plan reads several times: later reads prune its
    columns, and a lost executor costs a re-read instead of the whole lineage.
    """
    path = scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
