"""Files that a query writes and reads again, in the folder that all machines share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.errors import ConfigError


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a local master gets a new local one, a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ConfigError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/quire-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: many branches of a plan can read it, and it outlives any executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
