"""Declared schemas of the exchanged files; nothing is inferred unless asked for."""

from __future__ import annotations

from pyspark.sql import types as T

from barflow.series import LABEL, LAG_COUNT, Bars, base_features, lag_name

TS = "Timestamp"


def _doubles(names) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _keys(keys) -> list[T.StructField]:
    return [T.StructField(k, T.StringType()) for k in keys]


def _timed(ts: str, keys) -> list[T.StructField]:
    return [*_keys(keys), T.StructField(ts, T.TimestampType())]


def raw_bars(bars: Bars = Bars(), ts: str = TS, keys=()) -> T.StructType:
    """Primary bars: the time is text in a given pattern. Key columns, if any, come first in all layouts."""
    return T.StructType([*_keys(keys), T.StructField(ts, T.StringType()), *_doubles(bars.all)])


def raw_aux(keys=()) -> T.StructType:
    """Auxiliary bars with Unix seconds, which some exports write as 1325412060.0."""
    # Layout of the auxiliary file.
    names = ["Timestamp", "Open", "High", "Low", "Close", "Volume"]
    return T.StructType([*_keys(keys), *_doubles(names)])


def filled_bars(bars: Bars = Bars(), ts: str = TS, keys=()) -> T.StructType:
    return T.StructType([*_timed(ts, keys), *_doubles(bars.all)])


def feature_table(bars: Bars = Bars(), ts: str = TS, keys=()) -> T.StructType:
    """Column order of a written feature table."""
    return T.StructType([*_timed(ts, keys), *_doubles(base_features(bars)), T.StructField(LABEL, T.IntegerType())])


def scaled_table(bars: Bars = Bars(), ts: str = TS, keys=()) -> T.StructType:
    return T.StructType([*_timed(ts, keys), T.StructField(LABEL, T.IntegerType()), *_doubles(base_features(bars))])


def lr_table(bars: Bars = Bars(), ts: str = TS, keys=()) -> T.StructType:
    return T.StructType([
        *scaled_table(bars, ts, keys).fields, *_doubles(lag_name(i) for i in range(1, LAG_COUNT + 1))
    ])


# Field names of the run records as they are exchanged in JSON.
CLASS_REPORT = T.StructType([
    T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
    T.StructField("f1-score", T.DoubleType()), T.StructField("support", T.LongType()),
])
AVERAGE, ACCURACY = "weighted avg", "accuracy"
# metrics by class, under its number, and their average
REPORT = T.MapType(T.StringType(), CLASS_REPORT)
RUN = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("time_seconds", T.DoubleType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("auc_roc", T.DoubleType()), T.StructField("classification_report", REPORT),
    T.StructField("features", T.ArrayType(T.StringType())), T.StructField("timestamp", T.LongType()),
    T.StructField("majority_share", T.DoubleType()), T.StructField("predicted_share", T.DoubleType()),
])
# As written: besides classes the report holds the accuracy, a plain number, so its entries are read as text.
RUN_TEXT = T.StructType([
    T.StructField(f.name, T.MapType(T.StringType(), T.StringType())) if f.dataType == REPORT else f for f in RUN.fields
])
# {workers: {percent: [run, ...]}}, one document
RUN_MATRIX = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(RUN_TEXT)))
