"""What a fit has learnt, as numbers that an untrained model would not show."""

from __future__ import annotations

import math

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

TINY = 1e-15  # probabilities are kept this far from 0 and 1 in logarithms


def fit_certificate(model: Model, rows: DataFrame, columns: list[str], label: str) -> dict:
    """Mean log-loss of a two-class model on ``rows`` against that of the base rate, and how far it is from optimal.

    ``gradient`` is the largest absolute derivative of the mean log-loss by the intercept or a weight, with inputs
    scaled to unit deviation: zero at the optimum of a logistic regression. ``spread`` is the distance of the largest
    and smallest probability: zero for a constant predictor, whose best log-loss is the base rate's. Classes are 0 and 1.
    One aggregation over the rows; a few numbers per column reach the driver.
    """
    scored = model.transform(rows).select(
        F.col(label).cast("double").alias("y"), vector_to_array("probability")[1].alias("p"),
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)),
    )
    y, p, miss = F.col("y"), F.col("p"), F.col("p") - F.col("y")
    safe = lambda c: F.log(F.greatest(c, F.lit(TINY)))
    found = scored.agg(
        F.count(F.lit(1)).alias("rows"), F.avg(y).alias("base"), F.avg(miss).alias("miss"),
        F.avg(-(y * safe(p) + (1 - y) * safe(1 - p))).alias("log_loss"), (F.max(p) - F.min(p)).alias("spread"),
        *(f(F.col(f"x{i}")).alias(f"{n}{i}") for i in range(len(columns)) for n, f in (("m", F.avg), ("s", F.stddev_samp))),
        *(F.avg(miss * F.col(f"x{i}")).alias(f"g{i}") for i in range(len(columns))),
    ).first()
    slopes = [
        abs(found[f"g{i}"] - found[f"m{i}"] * found["miss"]) / found[f"s{i}"] for i in range(len(columns)) if found[f"s{i}"]
    ]
    rate = found["base"]
    entropy = -sum(q * math.log(q) for q in (rate, 1 - rate) if q > 0)
    return {
        "rows": found["rows"], "base_rate": rate, "base_log_loss": entropy, "log_loss": found["log_loss"],
        "spread": found["spread"], "bias": abs(found["miss"]), "gradient": max([abs(found["miss"]), *slopes]),
    }
