"""Classification metrics as DataFrame aggregations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window, functions as F

from barflow.session import shuffle_width, stage

LABELS = (0, 1)


def confusion(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): all other metrics follow from these few rows."""
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def class_metrics(predictions: DataFrame, label: str, prediction: str = "prediction", labels=LABELS) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a class is never predicted or absent.

    Every class of the labels or predictions has a line, and ``labels`` have one even where they do not occur.
    Classes are whole numbers.
    """
    rows, l, p, none = F.col("rows"), F.col("label"), F.col("prediction"), F.lit(0).cast("long")
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    line = lambda name, hits, predicted, support: F.struct(
        name.cast("int").alias("label"), hits.alias("hits"), predicted.alias("predicted"), support.alias("support")
    )
    counted = confusion(predictions, label, prediction).select(F.inline(F.array(
        line(l, F.when(l == p, rows).otherwise(none), none, rows), line(p, none, rows, none)
    ))).where(F.col("label").isNotNull())
    listed = predictions.sparkSession.range(1).select(
        F.inline(F.array(*(line(F.lit(float(c)), none, none, none) for c in labels)))
    )
    lines = counted.unionByName(listed).groupBy("label").agg(
        *(F.sum(c).alias(c) for c in ("hits", "predicted", "support"))
    ).orderBy("label")
    lines = lines.withColumns({
        "precision": ratio(F.col("hits"), F.col("predicted")), "recall": ratio(F.col("hits"), F.col("support")),
    })
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return lines.select("label", "precision", "recall", f1.alias("f1"), "support", "hits", "predicted")


def summary_metrics(per_class: DataFrame) -> DataFrame:
    """Accuracy and the averages weighted by class support, with the two baselines to hold against them."""
    support = F.sum("support")
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), support)
    return per_class.agg(
        F.try_divide(F.sum("hits"), support).alias("accuracy"), weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"), weighted("f1").alias("weighted_f1"), support.alias("support"),
        F.try_divide(F.max("support"), support).alias("majority_share"),
        F.try_divide(F.max("predicted"), support).alias("predicted_share"),
    )


def auc_roc(predictions: DataFrame, score: str, label: str) -> float | None:
    """Exact area under the ROC curve as a rank sum; null if a class is absent. Rows without score or label do not count.

    Rows become counts per distinct score, which are range-partitioned and written; how many negatives lie below a
    score follows from the totals of the ranges before and a running sum inside its own. Ties count half.
    """
    value = vector_to_array(score)[1] if isinstance(predictions.schema[score].dataType, VectorUDT) else F.col(score).cast("double")
    up, part = F.count_if(F.col("label") == 1), F.col("_part")
    scored = predictions.select(value.alias("score"), F.col(label).cast("double").alias("label"))
    counts = scored.where("score IS NOT NULL AND label IS NOT NULL").groupBy("score").agg(
        up.alias("up"), (F.count(F.lit(1)) - up).alias("down")
    )
    # equal scores are one row by now, so ranges of distinct scores cannot be skewed by ties
    ranged = counts.repartitionByRange(shuffle_width(predictions.sparkSession), "score")
    ranged = stage(ranged.withColumn("_part", F.spark_partition_id()), "scores")
    # one row per range: a few times the cluster's cores
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(F.sum("down").alias("down"))
    totals = totals.select(part, F.coalesce(F.sum("down").over(before), F.lit(0)).alias("_below"))
    inside = Window.partitionBy("_part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_inside", F.coalesce(F.sum("down").over(inside), F.lit(0))).join(totals, "_part")
    won = F.col("up") * (F.col("_below") + F.col("_inside") + F.col("down") / 2.0)
    return rows.agg(F.try_divide(F.sum(won), F.sum("up").cast("double") * F.sum("down"))).first()[0]
