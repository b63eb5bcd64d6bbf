"""Train, score and record one classifier."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from barflow.operators.certificates import fit_certificate
from barflow.operators.metrics import auc_roc, class_metrics, summary_metrics
from barflow.operators.models import NAMES, pipeline, timed_fit
from barflow.operators.splits import newest_fraction, oldest_fraction, random_split, stratified_split, time_split
from barflow.series import LABEL, Bars, Series, base_features, lr_features
from barflow.sources.runs import runs_frame

TRAIN_SHARE = 0.8


@dataclass(frozen=True)
class Outcome:
    model: Model
    predictions: DataFrame
    record: dict
    certificate: dict | None = None
    columns: tuple[str, ...] = ()

    def frame(self) -> DataFrame:
        return runs_frame(self.predictions.sparkSession, [self.record])


def choose_rows(df: DataFrame, kind: str, series: Series, percent: float | None) -> DataFrame:
    """The share of the table a model is given: the newest rows for rf and mlp, else the oldest."""
    if not percent:
        return df
    if not 0 < percent <= 100:
        raise ValueError("percent must be from 0 (all rows) to 100")
    return (newest_fraction if kind in ("rf", "mlp") else oldest_fraction)(df, percent, series)


def split(df: DataFrame, kind: str, series: Series, label: str = LABEL, mode: str = "hash"):
    """The split each model uses: by time (lr), at random (gbt), or at random within classes (rf, mlp)."""
    if kind == "lr":
        return time_split(df, TRAIN_SHARE, series)
    if kind == "gbt":
        return random_split(df, TRAIN_SHARE, series, mode=mode)
    return stratified_split(df, label, TRAIN_SHARE, series, mode=mode)


def run_record(kind: str, rows: int, seconds: float, predictions: DataFrame, label: str, columns: list[str]) -> dict:
    """Metrics of the predictions in the exchanged layout. Two small rows per class reach the driver."""
    per_class = class_metrics(predictions, label)
    lines = {str(r["label"]): r for r in per_class.collect()}
    total = summary_metrics(predictions.sparkSession.createDataFrame(list(lines.values()), per_class.schema)).first()
    report = {
        name: {"precision": r["precision"], "recall": r["recall"], "f1-score": r["f1"], "support": r["support"]}
        for name, r in lines.items()
    }
    report["accuracy"] = total["accuracy"]
    report["weighted avg"] = {
        "precision": total["weighted_precision"], "recall": total["weighted_recall"],
        "f1-score": total["weighted_f1"], "support": total["support"],
    }
    record = {
        "model": NAMES[kind], "rows": rows, "time_seconds": seconds, "accuracy": total["accuracy"],
        "classification_report": report, "timestamp": int(time.time()),
        "majority_share": total["majority_share"], "predicted_share": total["predicted_share"],
    }
    if kind == "lr":
        record |= {"auc_roc": auc_roc(predictions, "rawPrediction", label), "features": columns}
    return record


def train(
    df: DataFrame, kind: str, series: Series, percent: float | None = None, columns: list[str] | None = None,
    label: str = LABEL, bars: Bars = Bars(), mode: str = "hash", certify: bool = False, **parameters,
) -> Outcome:
    """Slice, split, fit, score and evaluate. ``df`` is a stored feature table (see ``session.stage``).

    ``certify`` adds what the fit has learnt from the training rows (``fit_certificate``).

    Training and test rows are kept in executor storage while they are read repeatedly; a lost block
    is computed again from the stored table.
    """
    columns = columns or (lr_features if kind == "lr" else base_features)(bars)
    needed = df.select(*series.row_key, F.col(label), *columns)
    train_rows, test_rows = split(choose_rows(needed, kind, series, percent), kind, series, label, mode)
    train_rows = train_rows.select(*columns, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = train_rows.count()
        model, seconds = timed_fit(pipeline(kind, columns, label, **parameters), train_rows)
        certificate = fit_certificate(model, train_rows, columns, label) if certify else None
    finally:
        train_rows.unpersist()
    predictions = model.transform(test_rows)
    scored = predictions.select(label, "prediction", "rawPrediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        record = run_record(kind, rows, seconds, scored, label, columns)
    finally:
        scored.unpersist()
    return Outcome(model, predictions, record, certificate, tuple(columns))
