"""Table profiles: each is one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barflow.series import GK, Bars


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def time_range(df: DataFrame, ts: str, keys=()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"), F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count and percentage, one row per column; all columns in a single pass."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)))
    lines = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(cols)))
    return counted.select("rows", F.inline(lines)).select(
        "column", "nulls", F.try_divide(F.col("nulls") * 100.0, F.col("rows")).alias("null_pct")
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    # the window runs over one row per class
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def period_of(ts: str, unit: str) -> Column:
    if unit == "year":
        return F.year(ts)
    if unit == "month":
        return F.trunc(ts, "month")
    if unit == "month_of_year":
        return F.month(ts)
    if unit == "day":
        return F.to_date(ts)
    raise ValueError(f"unknown period {unit!r}")


def period_profile(df: DataFrame, ts: str, measures: dict[str, Column], unit: str = "year") -> DataFrame:
    grouped = df.groupBy(period_of(ts, unit).alias(unit)).agg(*(m.alias(n) for n, m in measures.items()))
    return grouped.orderBy(unit)


def volatility_by_period(df: DataFrame, ts: str, unit: str = "year", col: str = GK) -> DataFrame:
    return period_profile(df, ts, {"avg_gk_vol": F.avg(col)}, unit)


def volume_by_period(df: DataFrame, ts: str, unit: str = "year", col: str = Bars.volume) -> DataFrame:
    return period_profile(df, ts, {"total_volume": F.sum(col), "avg_volume": F.avg(col)}, unit)


def price_by_period(df: DataFrame, ts: str, col: str, unit: str = "year") -> DataFrame:
    return period_profile(df, ts, {"avg_price": F.avg(col), "min_price": F.min(col), "max_price": F.max(col)}, unit)
