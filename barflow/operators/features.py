"""Trailing features, lags and the fixed-horizon label.

Functions with a window argument are for ``over_rows``, which supplies the window.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, WindowSpec, functions as F

from barflow.functions import market
from barflow.operators.chunks import over_rows
from barflow.series import (
    GK, HORIZON, LABEL, LAG_COUNT, MICROSECOND, SMA_LENGTHS, VOL_STD, VOLATILITY_LENGTH, Bars, Series, lag_name, sma_name,
)

LOG_RETURN, FUTURE = "Log_Return", "FutureClose"
REQUIRED = [LOG_RETURN, *map(sma_name, SMA_LENGTHS), GK, VOL_STD, FUTURE, LABEL]
BACK = VOLATILITY_LENGTH + 1  # the oldest return of the frame needs one more close


def steps_ahead(horizon: timedelta, series: Series) -> int:
    return -(-horizon // series.step)


def with_features(df: DataFrame, w: WindowSpec, bars: Bars = Bars()) -> DataFrame:
    close = F.col(bars.close)
    df = df.withColumns({
        LOG_RETURN: market.log_return(close, w),
        **{sma_name(n): market.relative_deviation(close, market.trailing_mean(close, w, n)) for n in SMA_LENGTHS},
        GK: market.garman_klass(*(F.col(c) for c in (bars.open, bars.high, bars.low, bars.close))),
    })
    return df.withColumn(VOL_STD, market.trailing_std(F.col(LOG_RETURN), w, VOLATILITY_LENGTH))


def with_label(df: DataFrame, w: WindowSpec, value: str, horizon: timedelta = HORIZON) -> DataFrame:
    """Label from the row exactly ``horizon`` later, found in the ordered chunk without a join."""
    df = df.withColumn(FUTURE, market.value_at(F.col(value), w, horizon // MICROSECOND))
    return df.withColumn(LABEL, market.direction(F.col(value), F.col(FUTURE)))


def complete_rows(df: DataFrame) -> DataFrame:
    """Drop rows without full history or future, and the helper columns."""
    return df.na.drop(subset=REQUIRED).drop(LOG_RETURN, FUTURE)


def log_returns(df: DataFrame, series: Series, value: str, name: str = LOG_RETURN) -> DataFrame:
    return over_rows(df, series, lambda d, w: d.withColumn(name, market.log_return(F.col(value), w)), back=1)


def rolling_mean(df: DataFrame, series: Series, value: str, lengths=SMA_LENGTHS) -> DataFrame:
    """Relative deviation of ``value`` from its trailing means."""
    def compute(d, w):
        v = F.col(value)
        return d.withColumns(
            {sma_name(n): market.relative_deviation(v, market.trailing_mean(v, w, n)) for n in lengths}
        )
    return over_rows(df, series, compute, back=max(lengths))


def rolling_std(df: DataFrame, series: Series, value: str, n: int = VOLATILITY_LENGTH) -> DataFrame:
    """Sample deviation of the trailing log returns of ``value``."""
    def compute(d, w):
        d = d.withColumn(LOG_RETURN, market.log_return(F.col(value), w))
        return d.withColumn(VOL_STD, market.trailing_std(F.col(LOG_RETURN), w, n)).drop(LOG_RETURN)
    return over_rows(df, series, compute, back=n + 1)


def lag_features(df: DataFrame, series: Series, value: str, n: int = LAG_COUNT) -> DataFrame:
    """Values of the 1..n rows before."""
    def compute(d, w):
        return d.withColumns({lag_name(i): F.lag(value, i).over(w) for i in range(1, n + 1)})
    return over_rows(df, series, compute, back=n)


def horizon_label(df: DataFrame, series: Series, value: str, horizon: timedelta = HORIZON) -> DataFrame:
    """Label by self-join on the exact future time; works with missing steps, duplicates fan out."""
    future = df.select(
        *series.keys, (F.col(series.ts) - F.lit(horizon)).alias(series.ts), F.col(value).alias(FUTURE)
    )
    joined = df.join(future, list(series.row_key), "left")
    return joined.withColumn(LABEL, market.direction(F.col(value), F.col(FUTURE)))


def drop_stats(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows before, after and removed by dropping null or NaN in ``required``, in one pass."""
    whole, kinds = F.lit(True), dict(df.dtypes)
    for c in required:
        whole = whole & F.col(c).isNotNull()
        if kinds.get(c) in ("double", "float"):
            whole = whole & ~F.coalesce(F.isnan(c), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("kept"), F.count_if(~whole).alias("dropped")
    )
