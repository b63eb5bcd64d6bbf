"""Stored aggregates that merge: counts, means, squared deviations and ranges per period and column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barflow.operators.profiles import period_of
from barflow.operators.scaling import Scaler

PART = "part"


def moments(df: DataFrame, columns: list[str], ts: str, unit: str = "year") -> DataFrame:
    """One row per period and column: rows, values, mean, m2 (summed squared deviations), min, max. One aggregation.

    Nulls are no values; a column without values in a period has a count of 0 and nulls. NaN spreads, as in averages.
    """
    wide = df.groupBy(period_of(ts, unit).alias(unit)).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"),
            (F.var_pop(c) * F.count(c)).alias("m2"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        ).alias(f"_{i}") for i, c in enumerate(columns)),
    )
    return wide.select(unit, "rows", F.inline(F.array(*(f"_{i}" for i in range(len(columns))))))


def merge_moments(parts: DataFrame, keys=()) -> DataFrame:
    """Moments of everything in ``parts``, per ``keys`` (the period, or nothing: the whole table) and column.

    Deviations are taken from the common mean, so nothing cancels. Groups hold one row per part and period.
    """
    w = Window.partitionBy(*keys, "column")
    centre = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(w), F.sum("n").over(w))
    off = F.col("mean") - F.col("_centre")
    return parts.withColumn("_centre", centre).groupBy(*keys, "column").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("_centre").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"),
    )


def write_moments(df: DataFrame, folder: str, part: str) -> None:
    """Store the moments of one part under its name; written again, a part replaces itself and counts once."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{PART}={part}")


def read_moments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def scaler_of(merged: DataFrame, columns: list[str]) -> Scaler:
    """The scaler of a whole table from its merged moments (``merge_moments`` without keys); one row per column is collected."""
    found = {r["column"]: r for r in merged.select("column", "n", "mean", "m2").collect()}
    if missing := [c for c in columns if c not in found]:
        raise ValueError(f"no moments of {missing}")
    deviation = lambda r: (r["m2"] / (r["n"] - 1)) ** 0.5 if r["n"] > 1 else 0.0
    return Scaler(tuple(columns), tuple(found[c]["mean"] for c in columns), tuple(deviation(found[c]) for c in columns))


def profile_of(merged: DataFrame, unit: str, measures: dict[str, tuple[str, str]]) -> DataFrame:
    """A row per period from merged moments: each measure is a column and one of avg, total, min, max."""
    kinds = {"avg": F.col("mean"), "total": F.col("mean") * F.col("n"), "min": F.col("min"), "max": F.col("max")}
    return merged.groupBy(unit).agg(*(
        F.max(F.when(F.col("column") == c, kinds[kind])).alias(name) for name, (c, kind) in measures.items()
    )).orderBy(unit)
