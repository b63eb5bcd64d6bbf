"""Run records: appended as JSON lines, compared from one nested document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from barflow.sources.schemas import ACCURACY, CLASS_REPORT, RUN, RUN_MATRIX, RUN_TEXT


def runs_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Records with a report of any classes as rows; the accuracy inside the report is that of the record."""
    def classes(record):
        report = record.get("classification_report") or {}
        return {**record, "classification_report": {c: m for c, m in report.items() if c != ACCURACY}}
    return spark.createDataFrame([_complete(classes(r), RUN) for r in records], RUN)


def _complete(value, kind):
    """Dictionaries to rows of the declared type; absent fields are null."""
    if value is None:
        return None
    if isinstance(kind, T.MapType):
        return {k: _complete(v, kind.valueType) for k, v in value.items()}
    if not isinstance(kind, T.StructType):
        return value
    return Row(*(_complete(value.get(f.name), f.dataType) for f in kind.fields))


def as_text(df: DataFrame) -> DataFrame:
    """Records as JSON objects, one per row, in the exchanged layout: the report also holds the accuracy."""
    name = "classification_report"
    rest = F.to_json(F.struct(*(c for c in df.columns if c != name)))
    body = F.regexp_replace(F.coalesce(F.to_json(name), F.lit("{}")), r"^\{|\}$", "")
    parts = F.array(F.when(body != "", body), F.concat(F.lit(f'"{ACCURACY}":'), F.col(ACCURACY).cast("string")))
    report = F.concat(F.lit(f',"{name}":{{'), F.array_join(parts, ","), F.lit("}}"))
    return df.select(F.concat(F.regexp_replace(rest, r"\}$", ""), report).alias("value"))


def append_run(df: DataFrame, path: str) -> None:
    as_text(df).coalesce(1).write.mode("append").text(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.schema(RUN_TEXT).json(path)
    return read.withColumn("classification_report", class_reports(F.col("classification_report")))


def class_reports(report: Column) -> Column:
    """Metrics by class from the entries of a report as text."""
    classes = F.filter(F.map_entries(report), lambda e: e["key"] != ACCURACY)
    return F.map_from_entries(F.transform(classes, lambda e: F.struct(e["key"], F.from_json(e["value"], CLASS_REPORT))))


def compact_runs(spark: SparkSession, path: str, target: str) -> None:
    """All records of a log, which holds one file per run, as one file in ``target``."""
    spark.read.text(path).coalesce(1).write.text(target)


def read_run_matrix(spark: SparkSession, path: str) -> DataFrame:
    """The nested document {workers: {percent: [run, ...]}} as one map column ``runs``."""
    return parse_run_matrix(spark.read.text(path, wholetext=True))


def parse_run_matrix(text: DataFrame) -> DataFrame:
    return text.select(F.from_json("value", RUN_MATRIX).alias("runs"))
