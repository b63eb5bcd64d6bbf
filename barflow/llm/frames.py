"""Helpers shared by the text operators: column-wise Arrow maps, folds, bounded samples."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

TEXT = "_text_in"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it.

    On a cluster without a shared home ship the package as usual (``--py-files``); this does no harm then.
    """
    home, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])
    return spark


def released(run: Callable) -> Callable:
    """``run`` over the batches of a task, after which its memory goes back to the system.

    Python workers serve many tasks of different operators; what one of them held must not add up.
    """
    def task(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)

    return task


def fields(spec: str) -> StructType:
    return _parse_datatype_string(spec)


def map_texts(df: DataFrame, fn: Callable[[list], dict], spec: str, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``df`` as they are, then the columns of ``spec`` that ``fn`` makes from the texts.

    ``fn`` gets the texts of one Arrow batch (None where null) and returns one list or array per new
    column. Other columns of ``df`` are not read. Rows stay where they are: there is no shuffle.
    """
    added = fields(spec)
    if clash := set(keep) & set(added.names):
        raise ValueError(f"columns {sorted(clash)} exist already")
    keep = list(keep)
    rows = df.select(*keep) if text in keep else df.select(*keep, F.col(text).alias(TEXT))
    schema = StructType([rows.schema[c] for c in keep] + added.fields)
    arrow = to_arrow_schema(added)
    kept, at = len(keep), keep.index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch.column(at).to_pylist())
            new = [pa.array(made[f.name], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *new], [*keep, *arrow.names])

    return rows.mapInArrow(released(run), schema)


HOT = 256  # a key with more than one row in HOT is joined by broadcast


def join_spread(rows: DataFrame, table: DataFrame, key: str, other: str, size: str) -> DataFrame:
    """Inner join of ``rows``, of which one key may hold a large part, with ``table``, one row per key.

    Both are stored tables. ``size`` says how many rows have the key. Those with more than 1 / HOT of all rows,
    fewer than HOT keys, are broadcast, so that their rows stay where they are; all other rows are shuffled.
    """
    total, same = rows.count(), F.col(key) == F.col(other)
    hot = F.col(size) * HOT > total
    few = F.broadcast(table.where(hot).drop(size))
    rest = rows.join(few.select(other), same, "left_anti").join(table.where(~hot).drop(size), same)
    return rows.join(few, same).unionByName(rest)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows a model is tested on: crc32 of the id as text is a multiple of 5; false for null ids."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def training_rows(doc_id: str = "doc_id") -> Column:
    """True for the rows a model may learn from; a row without an id is in neither part."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def bounded_sample(rows: DataFrame, stratum: str, key: str, per_stratum: int) -> DataFrame:
    """About ``per_stratum`` rows of each stratum, all of it where it has fewer.

    A row stays if the hash of its key lies below a threshold, so the sample does not depend on the
    partitioning. Counting is one aggregate over two narrow columns.
    """
    counts = rows.groupBy(stratum).count().collect()
    share = F.lit(0.0)
    for value, n in counts:
        share = F.when(F.col(stratum) == F.lit(value), F.lit(min(1.0, per_stratum / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(draw < share)
