"""Fitted models as stored artefacts with a column contract, and scoring with them."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

MODEL, CONTRACT = "model", "contract"


@dataclass(frozen=True)
class StoredModel:
    model: PipelineModel
    kind: str
    columns: tuple[str, ...]
    label: str


def save_model(spark: SparkSession, stored: StoredModel, path: str) -> None:
    """The pipeline and, written last, what it expects. An earlier model in ``path`` is replaced."""
    stored.model.write().overwrite().save(f"{path.rstrip('/')}/{MODEL}")
    contract = json.dumps({"kind": stored.kind, "columns": list(stored.columns), "label": stored.label})
    spark.createDataFrame([(contract,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/{CONTRACT}")


def load_model(spark: SparkSession, path: str) -> StoredModel:
    row = spark.read.text(f"{path.rstrip('/')}/{CONTRACT}", wholetext=True).first()
    if row is None:
        raise ValueError(f"{path} holds no complete model")
    contract = json.loads(row[0])
    model = PipelineModel.load(f"{path.rstrip('/')}/{MODEL}")
    return StoredModel(model, contract["kind"], tuple(contract["columns"]), contract["label"])


def check_contract(df: DataFrame, stored: StoredModel) -> None:
    """The table must have every input of the model, as a number. Other columns do not matter."""
    missing = [c for c in stored.columns if c not in df.columns]
    if missing:
        raise ValueError(f"the {stored.kind} model needs columns {missing}")
    if other := [c for c in stored.columns if not isinstance(df.schema[c].dataType, NumericType)]:
        raise ValueError(f"inputs of the {stored.kind} model that are not numbers: {other}")


def score(df: DataFrame, stored: StoredModel, keep) -> DataFrame:
    """``keep``, prediction and probability (per class) of every row; a projection without shuffles.

    Rows with a null or NaN input stay and have null in both.
    """
    check_contract(df, stored)
    keep = list(keep)
    if clash := {"prediction", "probability"} & set(keep):
        raise ValueError(f"columns {sorted(clash)} exist already")
    inputs = {c: F.col(c).cast("double").alias(f"_in{i}") for i, c in enumerate(stored.columns)}
    plain = df.select(*(F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)), *inputs.values())
    names = [f"_in{i}" for i in range(len(inputs))]
    known = F.lit(True)
    for c in names:
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    assembler = VectorAssembler(inputCols=names, outputCol=stored.model.stages[0].getOutputCol(), handleInvalid="keep")
    scored = PipelineModel([assembler, *stored.model.stages[1:]]).transform(plain)
    return scored.select(
        *(F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)),
        F.when(known, F.col("prediction")).alias("prediction"),
        F.when(known, vector_to_array("probability")).alias("probability"),
    )
