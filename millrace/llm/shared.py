"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, label):
    """A fresh path below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df, label, path=None):
    """Write ``df`` and read it back: its lineage ends at files that outlive any executor."""
    path = path or folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
