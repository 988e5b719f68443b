"""Tables between the parts of a run: written once, read by what follows, and the plan before them is gone."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder all executors share, by spark.checkpoint.dir; on one machine that names none, one of our own."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-newslode-")
        known = _own[app]
    return known.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
