"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the chunked plans are written for; results never depend on them.

    Joins on (keys, chunk, time) may then use tables already partitioned by (keys, chunk) instead of
    shuffling them again. Chunks bound the rows per (keys, chunk), so this adds no skew.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def build_session(name: str = "barflow", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local sessions."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="barflow-"))
    return context.getCheckpointDir()


_STAGES: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted when it ends, also by an error."""
    first = len(_STAGES)
    try:
        yield
    finally:
        for name in _STAGES[first:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        del _STAGES[first:]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors.

    Parquet keeps column pruning and filter pushdown for whatever reads the stage next.
    """
    path = new_path(df.sparkSession, name)
    _STAGES.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
