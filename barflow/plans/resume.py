"""Gap filling and features of appended bars, without reading the history again.

A run leaves a state: the last filled rows of every series, and the rows of the second source later than those. The
next run puts them before its own rows. Parts given in order of time add up to one run over everything.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barflow.functions.timeline import micros
from barflow.operators.features import BACK, complete_rows, steps_ahead
from barflow.plans.prepare import all_features, fill_bars
from barflow.series import HORIZON, Bars, Series
from barflow.session import stage


@dataclass(frozen=True)
class FillState:
    """``rows``: the last filled bars of each series; ``pending``: rows of the second source after them."""

    rows: DataFrame
    pending: DataFrame


def history_steps(series: Series, horizon: timedelta = HORIZON) -> int:
    """Steps a state must hold for ``resume_features``: the frames of the oldest row whose label was still open."""
    return BACK + steps_ahead(horizon, series)


def _with_last(df: DataFrame, rows: DataFrame, series: Series) -> DataFrame:
    """``df`` with the last time in ``rows`` of its series in microseconds, ``_last``; null for other series."""
    last = rows.groupBy(*series.keys).agg(F.max(micros(rows, series.ts)).alias("_last"))
    if not series.keys:
        return df.withColumn("_last", F.lit(last.first()[0]).cast("long"))
    return df.join(last, list(series.keys), "left")


def _later(df: DataFrame, rows: DataFrame, series: Series) -> DataFrame:
    """The rows of ``df`` after the last of their series in ``rows``; all of series that have none."""
    late = F.coalesce(micros(df, series.ts) <= F.col("_last"), F.lit(False))
    return _with_last(df, rows, series).where(~late).select(*df.columns)


def resume_fill(
    primary: DataFrame, aux: DataFrame, state: FillState | None, series: Series, bars: Bars = Bars(),
    history: int = 1, duplicates: str = "error", flags: bool = False,
) -> tuple[DataFrame, FillState]:
    """(filled, state): the bars after those of earlier runs, dense to the last primary time, and what the next run needs.

    Rows of either source at or before the last filled step of their series come too late and are left out. The state
    holds ``history`` steps of each series, and rows of the second source until the primary reaches them. Both results
    are stored tables. ``flags`` as in ``fill_bars``.
    """
    if history < 1:
        raise ValueError("a state holds one step of each series at least")
    columns = [*series.row_key, *bars.all]
    primary, aux = primary.select(*columns), aux.select(*columns)
    if state is None:
        filled = stage(fill_bars(primary, aux, series, bars, duplicates, flags), "filled")
        known = filled.select(*columns)
    else:
        rows = state.rows.select(*columns)
        seeds = _with_last(rows, rows, series).where(micros(rows, series.ts) == F.col("_last")).select(*columns)
        aux = stage(state.pending.select(*columns).unionByName(_later(aux, rows, series)), "second")
        grown = fill_bars(seeds.unionByName(_later(primary, rows, series)), aux, series, bars, duplicates, flags)
        filled = stage(_later(grown, rows, series), "filled")
        known = rows.unionByName(filled.select(*columns))
    kept = _with_last(known, known, series).where(
        micros(known, series.ts) > F.col("_last") - F.lit(history * series.step_us)
    )
    kept = stage(kept.select(*columns), "state")
    return filled, FillState(kept, stage(_later(aux, kept, series), "pending"))


def resume_features(
    filled: DataFrame, before: FillState | None, series: Series, bars: Bars = Bars(), horizon: timedelta = HORIZON
) -> DataFrame:
    """Features and labels that the bars of ``filled`` complete, those of earlier rows with an open label among them.

    ``before`` is the state the bars were filled with, of ``history_steps`` at least.
    """
    if before is None:
        return complete_rows(all_features(filled, series, bars, horizon))
    columns = [*series.row_key, *bars.all]
    rows = before.rows.select(*columns)
    done = complete_rows(all_features(rows.unionByName(filled.select(*columns)), series, bars, horizon))
    opened: Column = F.col("_last") - F.lit(steps_ahead(horizon, series) * series.step_us)
    new = F.coalesce(micros(done, series.ts) > opened, F.lit(True))
    return _with_last(done, rows, series).where(new).select(*done.columns)


# --- stored states --------------------------------------------------------------------------------

def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of complete states, oldest first; the second of its tables is written last."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(folder))
    done = lambda name: files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/pending/_SUCCESS"))
    return [name for name in names if name.startswith("state-") and done(name)]


def write_state(state: FillState, path: str) -> None:
    """A new version beside the earlier ones: a run that fails leaves the last complete one as it was."""
    spark = state.rows.sparkSession
    earlier = _versions(spark, path)
    number = int(earlier[-1].split("-")[1]) + 1 if earlier else 1
    state.rows.write.mode("overwrite").parquet(f"{path}/state-{number:08d}/rows")
    state.pending.write.mode("overwrite").parquet(f"{path}/state-{number:08d}/pending")


def read_state(spark: SparkSession, path: str) -> FillState | None:
    """The last complete state under ``path``, None if there is none."""
    found = _versions(spark, path)
    if not found:
        return None
    return FillState(*(spark.read.parquet(f"{path}/{found[-1]}/{name}") for name in ("rows", "pending")))
