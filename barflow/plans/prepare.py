"""Gap filling, features, lag features and scaling as jobs from DataFrame to DataFrame."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from barflow.functions.timeline import is_ntz
from barflow.operators.chunks import chunk_window, over_rows
from barflow.operators.features import BACK, complete_rows, lag_features, steps_ahead, with_features, with_label
from barflow.operators.gapfill import FROM_AUX, MISSING, dense_chunks, own_rows
from barflow.operators.scaling import feature_columns, standard_scale
from barflow.series import HORIZON, LABEL, Bars, Series, lr_features
from barflow.session import stage


def fill_bars(
    primary: DataFrame, aux: DataFrame, series: Series, bars: Bars = Bars(),
    duplicates: str = "error", flags: bool = False,
) -> DataFrame:
    """Dense bars: own values, else those of ``aux``, else the last price and zero volume.

    ``flags`` keeps two columns that say which rows were missing and which of them ``aux`` filled.
    """
    chunked = dense_chunks(primary, aux, series, bars, duplicates=duplicates)
    filled = own_rows(chunked, series, is_ntz(primary, series.ts))
    return filled if flags else filled.drop(MISSING, FROM_AUX)


def all_features(filled: DataFrame, series: Series, bars: Bars = Bars(), horizon: timedelta = HORIZON) -> DataFrame:
    """Features, label and helper columns of every row, before rows are dropped."""
    def compute(df, w):
        return with_label(with_features(df, w, bars), w, bars.close, horizon)
    return over_rows(filled, series, compute, back=BACK, ahead=steps_ahead(horizon, series))


def build_features(filled: DataFrame, series: Series, bars: Bars = Bars(), horizon: timedelta = HORIZON) -> DataFrame:
    """Features and label of bars that may lack steps: one shuffle of the rows for all windows and the label."""
    return complete_rows(all_features(filled, series, bars, horizon))


def bars_to_features(
    primary: DataFrame, aux: DataFrame, series: Series, bars: Bars = Bars(),
    horizon: timedelta = HORIZON, duplicates: str = "error",
) -> DataFrame:
    """``fill_bars`` and ``build_features`` in one stage: each source is shuffled once, nothing else is."""
    chunked = dense_chunks(primary, aux, series, bars, BACK, steps_ahead(horizon, series), duplicates)
    w = chunk_window(series.keys)
    done = with_label(with_features(chunked.drop(MISSING, FROM_AUX), w, bars), w, bars.close, horizon)
    return complete_rows(own_rows(done, series, is_ntz(primary, series.ts)))


def build_lr_features(
    features: DataFrame, series: Series, bars: Bars = Bars(), label: str = LABEL,
    scale: bool = True, fit_on: DataFrame | None = None,
) -> DataFrame:
    """Keys, time, label and 17 inputs (12 + 5 lags of the close), scaled.

    Lags count rows of the cleaned table, which may lack steps. ``fit_on`` must hold the 17 inputs; without
    it the lagged rows are staged, as fitting and scaling both read them.
    """
    columns = lr_features(bars)
    lagged = lag_features(features, series, bars.close).na.drop(subset=columns)
    chosen = lagged.select(*series.row_key, label, *columns)
    if not scale:
        return chosen
    return standard_scale(chosen if fit_on is not None else stage(chosen, "lagged"), columns, fit_on)


def scale_features(
    features: DataFrame, series: Series, label: str = LABEL, fit_on: DataFrame | None = None
) -> DataFrame:
    """Keys, time, label, then every other column scaled under its own name; rows with nulls go.

    The label column may be written in lower case.
    """
    found = label if label in features.columns else label.lower()
    columns = feature_columns(features, [*series.row_key, label, label.lower()])
    clean = features.na.drop().select(*series.row_key, F.col(found).alias(label), *columns)
    return standard_scale(clean, columns, fit_on)
