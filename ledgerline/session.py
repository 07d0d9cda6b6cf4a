"""Folders shared by all executors."""

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse, which every executor reaches as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
