"""Comparison of run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barflow.sources.schemas import AVERAGE, CLASS_REPORT

# The models and runs that every report lists, whether there is such a run or not.
MODELS = ("Gradient Boosted Trees", "Random Forest", "Multilayer Perceptron")
WORKERS, FRACTIONS = (2, 3, 4), (25, 50, 75, 100)
REPORT_WORKERS, REPORT_FRACTION = 3, 100


def flatten_runs(matrix: DataFrame) -> DataFrame:
    """One row per run from the nested document ``{"3_workers": {"100%": [run, ...]}}``."""
    by_worker = matrix.select(F.explode("runs").alias("workers", "fractions"))
    by_fraction = by_worker.select("workers", F.explode("fractions").alias("fraction", "entries"))
    runs = by_fraction.select("workers", "fraction", F.posexplode("entries").alias("position", "run"))
    average = F.from_json(F.col("run.classification_report")[AVERAGE], CLASS_REPORT)
    return runs.select(
        F.split_part("workers", F.lit("_"), F.lit(1)).cast("int").alias("workers"),
        F.rtrim("fraction", F.lit("%")).cast("int").alias("fraction"),
        "position", F.col("run.model").alias("model"), F.col("run.rows").alias("rows"),
        F.col("run.time_seconds").alias("time_seconds"), F.col("run.accuracy").alias("accuracy"),
        average["precision"].alias("weighted_precision"), average["recall"].alias("weighted_recall"),
        average["f1-score"].alias("weighted_f1"),
    )


def _listed(df: DataFrame, values: list) -> DataFrame:
    """The given report lines as rows (place, value)."""
    return df.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, values))).alias("place", "value"))


def _with_others(runs: DataFrame, models) -> list[str]:
    """The given models, then those that only the runs know, by name."""
    found = runs.select("model").where(F.col("model").isNotNull()).distinct().collect()
    return [*models, *sorted({r[0] for r in found} - {*models})]


def _pivot(runs: DataFrame, by: str, value: str, models, required) -> DataFrame:
    """One column per model, one row per value of ``by``, required or found; null where there is no run.

    Of several runs of a model the last of the list counts.
    """
    latest = F.max_by(value, "position")
    table = runs.groupBy(by).pivot("model", _with_others(runs, models)).agg(latest)
    wanted = _listed(runs, list(required)).select(F.col("value").alias(by)).union(runs.select(by)).distinct()
    return wanted.join(table, by, "left").orderBy(by)


def report_time_by_workers(runs: DataFrame, models=MODELS, workers=WORKERS, fraction=REPORT_FRACTION) -> DataFrame:
    return _pivot(runs.where(F.col("fraction") == fraction), "workers", "time_seconds", models, workers)


def report_accuracy_by_fraction(runs, models=MODELS, fractions=FRACTIONS, workers=REPORT_WORKERS) -> DataFrame:
    return _pivot(runs.where(F.col("workers") == workers), "fraction", "accuracy", models, fractions)


def report_time_by_fraction(runs, models=MODELS, fractions=FRACTIONS, workers=REPORT_WORKERS) -> DataFrame:
    return _pivot(runs.where(F.col("workers") == workers), "fraction", "time_seconds", models, fractions)


def report_recall(runs, models=MODELS, workers=REPORT_WORKERS, fraction=REPORT_FRACTION) -> DataFrame:
    """Weighted recall per model, in the given order, others by name; null where there is no run."""
    chosen = runs.where((F.col("workers") == workers) & (F.col("fraction") == fraction))
    latest = chosen.groupBy("model").agg(F.max_by("weighted_recall", "position").alias("weighted_recall"))
    wanted = _listed(runs, _with_others(chosen, models)).withColumnRenamed("value", "model")
    return wanted.join(latest, "model", "left").orderBy("place").select("model", "weighted_recall")


def get_metric(runs: DataFrame, metric: str = "time_seconds") -> DataFrame:
    """Workers, fraction, model and one metric; ``f1`` is the weighted one."""
    column = "weighted_f1" if metric == "f1" else metric
    return runs.select("workers", "fraction", "position", "model", F.col(column).alias(metric))
