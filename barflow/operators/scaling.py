"""Standard scaling on plain columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Scaler:
    """Mean and sample deviation per column; applying it is a projection inside generated code."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(self.columns, self.means, self.deviations)
        return df.withColumns({
            c: (F.col(c) - F.lit(m)) / F.lit(s) if s else F.when(F.col(c).isNotNull(), F.lit(0.0)) for c, m, s in fitted
        })


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    """One aggregation; two numbers per column reach the driver."""
    rows, *row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)),
        *(F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)),
    ).first()
    n = len(columns)
    if n and not rows:
        raise ValueError("cannot fit a scaler on a table without rows")
    return Scaler(tuple(columns), tuple(row[:n]), tuple(s or 0.0 for s in row[n:]))


def standard_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale ``columns`` in place. Fit on ``fit_on`` (the training rows), or on the whole table."""
    return fit_scaler(df if fit_on is None else fit_on, columns).transform(df)


def feature_columns(df: DataFrame, excluded) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def assemble(df: DataFrame, columns: list[str], out: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid=invalid).transform(df)


def unpack_vector(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    values = vector_to_array(vector)
    rest = [c for c in df.columns if c != vector and c not in names]
    return df.select(*rest, *(values[i].alias(n) for i, n in enumerate(names)))
