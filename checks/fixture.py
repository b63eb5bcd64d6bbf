"""Bars derived from the events table: one series per event type."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from barflow.plans.prepare import bars_to_features, fill_bars
from barflow.series import Bars, Series
from barflow.session import configure

BARS = Bars("open", "high", "low", "close", "volume", "turnover", "wprice")
STEPS = {"hour": timedelta(hours=1), "minute": timedelta(minutes=1)}


def series(step: str) -> Series:
    # chunks short enough that the small test tables have several; those of hours in groups of two
    return Series("ts", ("sym",), STEPS[step], 240, 2) if step == "hour" else Series("ts", ("sym",), STEPS[step], 4096)


def horizon(step: str) -> timedelta:
    return 15 * STEPS[step]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def resample(events: DataFrame, step: str) -> DataFrame:
    bars = (
        events.groupBy(F.col("event_type").alias("sym"), F.window("ts", f"1 {step}").alias("w"))
        .agg(
            F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"), F.sum("value").alias("volume"),
        )
    )
    return bars.select(
        "sym", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume",
        (F.col("volume") * F.col("close")).alias("turnover"), F.col("close").alias("wprice"),
    )


def primary(spark, sf_dir, step="hour") -> DataFrame:
    return resample(table(spark, sf_dir, "events").where("user_id % 3 = 0"), step)


def whole(spark, sf_dir, step="hour") -> DataFrame:
    """Bars of all events, with the steps missing that have none."""
    return resample(table(spark, sf_dir, "events"), step)


def off_grid(spark, sf_dir) -> DataFrame:
    """Every event that is not on the hour, as a bar at its own microsecond."""
    events = table(spark, sf_dir, "events").where("ts <> date_trunc('hour', ts)")
    price = [F.col("value").alias(c) for c in BARS.all]
    return events.select(F.col("event_type").alias("sym"), "ts", *price)


def auxiliary(spark, sf_dir, step="hour") -> DataFrame:
    return resample(table(spark, sf_dir, "events").where("user_id % 3 <> 0"), step).where("volume > 0")


def filled(spark, sf_dir, step="hour", flags=False) -> DataFrame:
    return fill_bars(primary(spark, sf_dir, step), auxiliary(spark, sf_dir, step), series(step), BARS, flags=flags)


def features(spark, sf_dir, step="hour") -> DataFrame:
    return bars_to_features(
        primary(spark, sf_dir, step), auxiliary(spark, sf_dir, step), series(step), BARS, horizon(step)
    )


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, where both engines agree."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
