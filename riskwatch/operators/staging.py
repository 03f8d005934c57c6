"""Cutting a plan where a costly intermediate is used more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Folders written by this interpreter's sessions, by application.
_staged: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the session names for data that all executors share."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else None


def stage(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table once, so that every later use reads that.

    Branches that need different columns of an aggregate would otherwise each
    prune their own copy of it and scan its input again. The table is in shared
    storage, so a lost executor costs a re-read; its size is known, so Spark
    broadcasts it in joins exactly when it is small. Where the session names no
    folder the plan stays lazy as it is, on a cluster and locally: same rows,
    more scans. ``drop_staged`` removes the tables again.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        return df
    path = f"{folder}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Removes the tables this session staged; call it when results are written."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
