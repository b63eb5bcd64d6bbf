"""Yearly profiles and run comparisons: the tables behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barflow.operators import runs as R
from barflow.operators.profiles import period_profile
from barflow.series import GK, Bars


def yearly_profile(df: DataFrame, ts: str, bars: Bars = Bars(), unit: str = "year") -> DataFrame:
    """Volatility, volume, open and close of every period, in one aggregation over the table."""
    return period_profile(df, ts, {
        "avg_gk_vol": F.avg(GK),
        "total_volume": F.sum(bars.volume), "avg_volume": F.avg(bars.volume),
        "avg_open": F.avg(bars.open), "min_open": F.min(bars.open), "max_open": F.max(bars.open),
        "avg_close": F.avg(bars.close), "min_close": F.min(bars.close), "max_close": F.max(bars.close),
    }, unit)


def compare_runs(
    matrix: DataFrame, workers=R.WORKERS, fractions=R.FRACTIONS, at_workers: int = R.REPORT_WORKERS,
    at_fraction: int = R.REPORT_FRACTION, models=R.MODELS,
) -> dict[str, DataFrame]:
    """Four reports. ``workers``, ``fractions`` and ``models`` are listed even without a run; times by workers and recalls
    are those at ``at_fraction`` percent of the data, the reports by fraction and recalls those with ``at_workers``."""
    runs = R.flatten_runs(matrix)
    return {
        "time_by_workers": R.report_time_by_workers(runs, models, workers, at_fraction),
        "accuracy_by_fraction": R.report_accuracy_by_fraction(runs, models, fractions, at_workers),
        "time_by_fraction": R.report_time_by_fraction(runs, models, fractions, at_workers),
        "recall_by_model": R.report_recall(runs, models, at_workers, at_fraction),
    }
