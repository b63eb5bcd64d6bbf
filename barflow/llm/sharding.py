"""Contiguous shards of near equal bytes: prefix sums from per-partition totals, cut at equal targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barflow.llm.crcsql import CRC_TABLE, crc32_sql
from barflow.llm.positions import AT, PART, laid_out, part_of, part_totals, place_of
from barflow.session import stage

ADDED = ("size", "text_crc32", "shard", "slot")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def balanced_shards(
    docs: DataFrame, shards: int = 16, text: str = "text", order=("doc_id",), keep=("doc_id",)
) -> DataFrame:
    """The ``keep`` columns of every row with its size, the CRC32 of its text, its shard and its slot there.

    Rows lie in one global order: by ``order``, then size, checksum and hash of the text. A row's size is the
    UTF-8 bytes of its text (null and empty: none) plus 1. Shard k begins at the row border nearest to k / ``shards``
    of all bytes, so a shard misses its target by at most half a row at either end; rows larger than a target
    leave shards empty. Slots count a shard's rows from 0.

    One narrow shuffle sorts (``keep`` alone moves, so texts only if kept); it is stored once. Totals per part are
    added up over the parts, and only the parts that hold a cut, fewer than ``shards``, get sums row by row. Equal
    rows, whatever their share of the table, lie in as many parts as they need; they are interchangeable. Rows
    without an id come first. A table without rows gives none. A kept column named like an added one is returned
    as ``<name>_given``. Broadcast are one row per part (the width of the shuffle) and one per shard.
    """
    kept = list(keep)
    body = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(
        *(quoted(c).alias(f"k{i}") for i, c in enumerate(kept)), *(quoted(c).alias(f"o{i}") for i, c in enumerate(order)),
        (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("tie"),
    )
    keys = [F.col(f"o{i}") for i in range(len(order))]
    laid = laid_out(rows, *keys, F.col("size"), F.col("text_crc32"), F.col("tie"), name="sharded")
    total = laid.agg(F.sum("size")).first()[0] or 1

    def shard_at(doubled: Column) -> Column:
        """The shard of twice a distance in bytes from the start; exact beyond 64 bits."""
        scaled = doubled.cast("decimal(20,0)") * F.lit(shards).cast("decimal(10,0)")
        return F.call_function("div", scaled, F.lit(2 * total).cast("decimal(20,0)"))

    parts = part_totals(laid, bytes=F.col("size")).withColumns({
        "low": shard_at(2 * F.col("bytes_before") + 1),
        "high": shard_at(2 * (F.col("bytes_before") + F.col("bytes")) - 1),
    })
    parts = stage(parts.withColumnRenamed(PART, "p"), "parts")
    cut = F.broadcast(parts.where(F.col("low") < F.col("high")).select("p", "bytes_before", "rows_before"))
    earlier = Window.partitionBy("p").orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("bytes_before") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    inside = (
        laid.select(AT, "size").join(cut, part_of() == F.col("p"))
        .withColumn("shard", shard_at(2 * start + F.col("size")))
        .groupBy("p", "shard", "rows_before").agg(F.min(AT).alias("since"))
    )
    inside = stage(inside, "cuts")
    firsts = (
        parts.where(F.col("low") == F.col("high")).select(F.col("low").alias("shard"), F.col("rows_before").alias("row"))
        .unionByName(inside.select("shard", (F.col("rows_before") + place_of("since")).alias("row")))
        .groupBy("shard").agg(F.min("row").alias("first"))
    )
    cuts = inside.groupBy("p").agg(F.collect_list(F.struct("since", "shard")).alias("cuts"))
    spans = parts.select("p", "rows_before", "low").join(cuts, "p", "left")
    placed = laid.join(F.broadcast(spans), part_of() == F.col("p")).withColumn(
        "shard", F.expr(f"coalesce(array_max(transform(filter(cuts, c -> c.since <= {AT}), c -> c.shard)), low)")
    )
    placed = placed.join(F.broadcast(firsts.withColumnRenamed("shard", "s")), F.col("shard") == F.col("s"))
    return placed.select(
        *(F.col(f"k{i}").alias(f"{c}_given" if c in ADDED else c) for i, c in enumerate(kept)), "size", "text_crc32",
        F.col("shard").cast("int").alias("shard"), (F.col("rows_before") + place_of() - F.col("first")).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, text: str = "text", order=("doc_id",)) -> None:
    """Whole rows as Parquet, one folder per shard; the files of a folder, by name, hold its slots in order."""
    whole = balanced_shards(docs, shards, text, order, keep=docs.columns)
    whole.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame) -> DataFrame:
    """16 shards of documents by bytes, with the columns of the contract."""
    return balanced_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents_sql() -> str:
    return f"""
    WITH {CRC_TABLE}, sized AS (
        SELECT doc_id, coalesce(text, '') AS body, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size FROM documents),
    placed AS (
        SELECT doc_id, size, {crc32_sql('body')} AS text_crc32, sum(size) OVER () AS total,
            sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS upto
        FROM sized, crc_table),
    cut AS (SELECT *, CAST((2 * upto - size) * 16 // (2 * total) AS INTEGER) AS shard FROM placed)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM cut"""
