"""A training corpus from raw documents: language, lines, near-duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of documents; between stages the rows are written to Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barflow.llm import decontaminate, language, packing, simhash, sitelines
from barflow.llm.frames import TEXT, importable
from barflow.llm.queries import tokenizer_path
from barflow.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of documents with the length of the text as it is now."""
    now = {"text": F.col(text), "n_chars": F.length(F.col(text)).cast("long")}
    return df.select(*(now.get(c, F.col(c)).alias(c) for c in COLUMNS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose words and n-grams speak for no language; ``lang`` stays as it came.

    Where no language can be learnt, everything with a letter stays.
    """
    docs = docs.select(*COLUMNS)
    model = language.fit_languages(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model, keep=COLUMNS[:1] + COLUMNS[2:] + ["text"])
    equal = 1.0 / len(model.languages) + 1e-9  # the score if all languages are equally likely
    evidence = F.lit(True) if len(model.languages) == 1 else F.col("score") > equal
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & evidence).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; a text of nothing else stays whole, and near_dedup leaves one of its copies."""
    docs = docs.select(*COLUMNS, F.col("text").alias("_whole"))
    cleaned = sitelines.drop_boilerplate(docs)
    emptied = (F.col("n_removed") > 0) & (F.length(F.trim("text")) == 0)
    kept = F.when(emptied, F.col("_whole")).otherwise(F.col("text"))
    return _documents(cleaned.withColumn("_kept", kept), "_kept")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the smallest id."""
    return simhash.one_per_group(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents of which nothing else is left go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keep = [c for c in COLUMNS if c != "text"]
    marked = decontaminate.contamination(docs.select(*COLUMNS), benchmark, keep=keep)
    cut = marked.withColumn("_cut", decontaminate.without_spans(TEXT, "spans"))
    return _documents(cut.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words"))), "_cut")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of tokens of all remaining documents, one row per piece."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontamination", decontamination), ("packing", pack),
]
#: Language models, fingerprints and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared folder and read by the next."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
