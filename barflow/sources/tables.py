"""CSV and Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barflow.functions.timeline import epoch_to_timestamp, parse_timestamp
from barflow.series import Bars
from barflow.sources.schemas import TS, raw_aux, raw_bars


BAD, FILE = "_bad_line", "_file"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, checked: bool = False) -> DataFrame:
    """Header CSV. Without a schema the types are inferred, which reads the file once more.

    With a schema the header must name its columns in the same order. ``checked`` adds the line of every malformed
    row (a cell that is not of its type, too few or too many cells) and the file of every row; stage the result before
    columns are chosen from it, as the reader only sees what is wrong with the columns it is asked for.
    """
    reader = spark.read.option("header", True)
    if not schema:
        return reader.csv(path, inferSchema=True)
    reader = reader.option("enforceSchema", False)
    if not checked:
        return reader.schema(schema).csv(path)
    marked = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    read = reader.option("columnNameOfCorruptRecord", BAD).schema(marked).csv(path)
    return read.withColumn(FILE, F.col("_metadata.file_path"))


def bad_cells(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per file of a staged checked table: rows, malformed rows, and malformed cells per column apart from empty ones.

    The kept lines of malformed rows are split once more, as text; a cell that holds text where the typed column is
    null is malformed. Lines with too few or too many cells are malformed rows, if all their cells are right.
    """
    names = [f.name for f in schema.fields]
    cells = F.from_csv(BAD, ", ".join(f"`{c}` string" for c in names))
    split = df.withColumn("_cells", F.when(F.col(BAD).isNotNull(), cells))
    wrong = lambda c: F.col(c).isNull() & (F.length(F.trim(F.col("_cells")[c])) > 0)
    return split.groupBy(F.col(FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(BAD).isNotNull()).alias("bad_rows"),
        *(F.count_if(wrong(c)).alias(f"bad_{c}") for c in names),
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def load_bars(
    spark: SparkSession, path: str, ts_format: str = "dd-MM-yyyy HH:mm", bars: Bars = Bars(), ts: str = TS, keys=(),
    checked: bool = False,
) -> DataFrame:
    """Primary bars; times that do not parse become null and are counted by ``load_profile``.

    ``checked`` keeps the lines of malformed rows and the files beside them (``read_csv``).
    """
    raw = read_csv(spark, path, raw_bars(bars, ts, keys), checked)
    return raw.withColumn(ts, parse_timestamp(F.col(ts), ts_format))


def load_profile(df: DataFrame, ts: str, cols: list[str]) -> DataFrame:
    """Row count, time range, unparsed times and nulls per column, all in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"),
        F.count_if(F.col(ts).isNull()).alias("bad_ts"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols),
    )


def aux_bars(raw: DataFrame, bars: Bars = Bars(), ts: str = TS, keys=()) -> DataFrame:
    """Auxiliary bars from epoch rows: turnover is volume times close, the weighted price is the close.

    Only rows with a volume above zero are kept.
    """
    volume, close = F.col("Volume"), F.col("Close")
    return raw.where(volume > 0).select(
        *keys, epoch_to_timestamp(F.col(TS)).alias(ts),
        F.col("Open").alias(bars.open), F.col("High").alias(bars.high), F.col("Low").alias(bars.low),
        close.alias(bars.close), volume.alias(bars.volume), (volume * close).alias(bars.turnover),
        close.alias(bars.weighted),
    )


def aux_counts(raw: DataFrame) -> DataFrame:
    """Rows before and after the volume filter."""
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Volume") > 0).alias("with_volume"))


def load_aux_bars(spark: SparkSession, path: str, bars: Bars = Bars(), ts: str = TS, keys=()) -> DataFrame:
    return aux_bars(require(spark, path, raw_aux(keys)), bars, ts, keys)


def require(spark: SparkSession, path: str, schema: T.StructType, checked: bool = False) -> DataFrame:
    """A CSV source that must exist."""
    try:
        return read_csv(spark, path, schema, checked)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"required source {path} does not exist; put the file there first") from error
        raise


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with header CSV; one part file only on request, and only behind a shuffle so
    that the work before it stays parallel."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
