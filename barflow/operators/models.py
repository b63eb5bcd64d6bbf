"""Classifiers of the training jobs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

# Names under which runs are recorded, and the training parameters.
NAMES = {
    "gbt": "Gradient Boosted Trees",
    "rf": "Random Forest",
    "mlp": "Multilayer Perceptron",
    "lr": "Logistic Regression (AR)",
}
SEED = 42
HIDDEN = [128, 64, 32, 16, 8] * 3


def _gbt(n, label, **over):
    return GBTClassifier(**{"labelCol": label, "maxIter": 10, **over})


def _rf(n, label, **over):
    # node ids are kept per row: each level of 100 deep trees need not walk them from the root again
    return RandomForestClassifier(
        **{"labelCol": label, "numTrees": 100, "maxDepth": 10, "seed": SEED, "cacheNodeIds": True, **over}
    )


def _mlp(n, label, hidden=HIDDEN, classes=2, **over):
    layers = [n, *hidden, classes]
    return MultilayerPerceptronClassifier(
        **{"labelCol": label, "layers": layers, "maxIter": 10, "blockSize": 128, "seed": SEED, **over}
    )


def _lr(n, label, **over):
    return LogisticRegression(**{"labelCol": label, "maxIter": 100, **over})


ESTIMATORS: dict[str, Callable] = {"gbt": _gbt, "rf": _rf, "mlp": _mlp, "lr": _lr}


def pipeline(kind: str, columns: list[str], label: str, **over) -> Pipeline:
    """Vector assembly and the classifier; ``over`` replaces its parameters."""
    estimator = ESTIMATORS[kind](len(columns), label, **over)
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), estimator])


def timed_fit(estimator: Pipeline, train: DataFrame) -> tuple[Model, float]:
    start = time.perf_counter()
    model = estimator.fit(train)
    return model, time.perf_counter() - start
