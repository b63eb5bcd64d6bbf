"""Registered queries of the text operators, over whole tables, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barflow.llm import (
    decontaminate, digests, language, negatives, packing, quality, resampling, secrets, sharding, simhash, sitelines,
    toxicity, warc,
)
from barflow.llm.frames import importable


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, d):
    return language.identify_documents(table(spark, d, "documents"))


def op2_fingerprints(spark, d):
    return digests.fingerprint_documents(table(spark, d, "documents"))


def op3_decontamination(spark, d):
    return decontaminate.contaminated_documents(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op4_line_dedup(spark, d):
    return sitelines.clean_documents(table(spark, d, "documents"))


def op5_toxicity(spark, d):
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_secret_scan(spark, d):
    return secrets.scan_documents(table(spark, d, "documents"))


def op7_warc(spark, d):
    return warc.archive_pages(table(spark, d, "pages"))


def op8_quality(spark, d):
    return quality.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer_path())


def op10_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


def op11_sharding(spark, d):
    return sharding.shard_documents(table(spark, d, "documents"))


def op12_hard_negatives(spark, d):
    return negatives.mine_negatives(table(spark, d, "embeddings"))


def op13_resampling(spark, d):
    return resampling.resample_documents(table(spark, d, "documents"), table(spark, d, "benchmark"))


def registered() -> dict:
    found = [
        op1_language_id, op2_fingerprints, op3_decontamination, op4_line_dedup, op5_toxicity, op6_secret_scan,
        op7_warc, op8_quality, op9_packing, op10_simhash, op11_sharding, op12_hard_negatives, op13_resampling,
    ]
    return {q.__name__: q for q in found}


def statements() -> dict[str, str]:
    return {
        "op4_line_dedup": sitelines.clean_documents_sql(), "op7_warc": warc.archive_pages_sql(),
        "op11_sharding": sharding.shard_documents_sql(), "op12_hard_negatives": negatives.mine_negatives_sql(),
        "op13_resampling": resampling.resample_documents_sql(),
    }
