"""Order-dependent work in bounded chunks instead of one task per series.

A series is cut into chunks along its position (microseconds, or a row number). Rows that a frame of a
neighbouring chunk needs are copied there, the frame is computed per (keys, chunk), and the copies are
dropped again. The result equals the unchunked window; one shuffle serves all frames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barflow.functions.timeline import floor_div, micros
from barflow.operators.scan import GROUP, before_each, group_of
from barflow.series import Series
from barflow.session import shuffle_width

AT, CHUNK = "_at", "_chunk"


def spread(df: DataFrame, at: Column, unit: int, chunk_steps: int, back: int = 0, ahead: int = 0) -> DataFrame:
    """Add position and chunk. A row within ``back`` units of the next chunk, or within the first
    ``ahead`` units of its own, is emitted for that neighbour too."""
    if max(back, ahead) > chunk_steps:
        raise ValueError("a chunk must be at least as long as the frames computed on it")
    span = unit * chunk_steps
    df = df.withColumn(AT, at)
    own = floor_div(F.col(AT), span)
    if not (back or ahead):
        return df.withColumn(CHUNK, own)
    offset = F.pmod(F.col(AT), F.lit(span))
    first = own - F.when(offset < ahead * unit, F.lit(1)).otherwise(F.lit(0))
    last = own + F.when(offset >= span - back * unit, F.lit(1)).otherwise(F.lit(0))
    return df.withColumn(CHUNK, F.explode(F.sequence(first, last)))


def owned(unit: int, chunk_steps: int) -> Column:
    """True on a row's own chunk, false on its copies."""
    return floor_div(F.col(AT), unit * chunk_steps) == F.col(CHUNK)


def chunk_window(keys) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(AT)


def _carried(wide: DataFrame, series: Series, back: int) -> DataFrame:
    """For each chunk copies of the ``back`` rows before it, however long ago they are.

    ``wide`` is already shuffled by (keys, chunk); a plan that uses it twice reads and shuffles its rows once. Each chunk
    hands on its last rows, at most ``back``. In the sequence of these tails a row is copied to the chunks among
    the next ``back`` rows, which is where looking back stops. Sequences of ``group_chunks`` chunks come first; what
    crosses their borders is found among the first and last ``back`` tail rows of each group.
    """
    keys = list(series.keys)
    own = owned(series.step_us, series.chunk_steps)
    # copies of later rows stand behind a chunk's own rows
    more = F.coalesce(F.lead(own, back).over(chunk_window(keys)), F.lit(False))
    tails = wide.withColumn("_more", more).where(own & ~F.col("_more")).drop("_more")
    tails = tails.withColumn(GROUP, group_of(F.col(CHUNK), series.chunk_group))
    # the chunks of the next rows, not their contents, are collected
    coming = lambda w: F.collect_set(CHUNK).over(w.rowsBetween(1, back))
    inside = Window.partitionBy(*keys, GROUP).orderBy(AT)
    placed = tails.withColumns({
        "_to": coming(inside), "_edge": F.lag(AT, back).over(inside).isNull() | F.lead(AT, back).over(inside).isNull(),
    })
    crossing = F.filter(
        coming(Window.partitionBy(*keys).orderBy(AT)), lambda c: group_of(c, series.chunk_group) != F.col(GROUP)
    )
    sent = placed.withColumn("_to", F.array_remove("_to", F.col(CHUNK))).unionByName(
        placed.where("_edge").withColumn("_to", crossing)
    )
    copies = sent.withColumn(CHUNK, F.explode("_to")).select(*wide.columns)
    return copies.repartition(shuffle_width(wide.sparkSession), *keys, CHUNK)


def over_rows(
    df: DataFrame,
    series: Series,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int = 0,
    ahead: int = 0,
) -> DataFrame:
    """Apply ``compute(df, window)`` chunk-wise to series with or without missing steps.

    Row frames may reach ``back`` rows before their row, whatever time lies between. The window is ordered
    by microseconds, so range frames may look for exact times, up to ``ahead`` steps later. Repeated times of
    a series raise an error. The rows are read and shuffled once, besides the last ``back`` rows of each chunk.
    """
    if back > series.chunk_steps:
        raise ValueError("a chunk must be at least as long as the frames computed on it")
    wide = spread(df, micros(df, series.ts), series.step_us, series.chunk_steps, 0, ahead)
    # A fixed width: the size of the shuffled rows says little about the work of the frames. Both parts of the
    # union have it, so that the windows need no further shuffle.
    wide = wide.repartition(shuffle_width(df.sparkSession), *series.keys, CHUNK)
    if back:
        wide = wide.unionByName(_carried(wide, series, back))
    w = chunk_window(series.keys)
    done = compute(wide.withColumn("_previous", F.lag(AT).over(w)), w)
    return single_times(done.where(owned(series.step_us, series.chunk_steps))).drop(AT, CHUNK)


def single_times(df: DataFrame) -> DataFrame:
    """The rows without ``_previous``; an error if that time equals the row's own."""
    message = F.concat(F.lit("duplicate time in a series, microseconds "), F.col(AT).cast("string"))
    repeated = F.col("_previous") == F.col(AT)
    return df.where(F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("_previous")


def row_position(df: DataFrame, series: Series, name: str) -> DataFrame:
    """Number the rows of each series from 1 by time.

    Rows are numbered inside their time chunk; the rows of all earlier chunks are added from a two-level scan
    over one count per chunk.
    """
    keys = list(series.keys)
    placed = spread(df, micros(df, series.ts), series.step_us, series.chunk_steps)
    counts = placed.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = before_each(counts, keys, CHUNK, series.chunk_group, sums={"_before": "_n"}).drop("_n")
    inside = placed.withColumn("_inside", F.row_number().over(chunk_window(keys)))
    return (
        inside.join(offsets, [*keys, CHUNK], "left")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop(AT, CHUNK, "_inside", "_before")
    )
