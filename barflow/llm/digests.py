"""Document fingerprints: quartile digests of hashed byte triplets, compared by a bounded difference."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

BUCKETS = 128
REACH = 4  # a triplet lies within REACH + 1 bytes
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4))  # offsets of the second and third byte from the first
PIECE = 1 << 20  # bytes worked on at once
LENGTH_STEPS = 8  # steps of the length code per doubling
OPPOSITE = 6  # difference of the lowest from the highest quartile; others differ by their distance
# Mean difference of two independent digests: per bucket 6/16 * 1 + 4/16 * 2 + 2/16 * OPPOSITE.
UNRELATED = BUCKETS * (6 * 1 + 4 * 2 + 2 * OPPOSITE) / 16
LENGTH_BOUND = 64  # most that the lengths add to a difference
STEPS = np.array([0, 1, 2, OPPOSITE], np.int64)


def _packed(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, owner of the triplets that start at each byte or -1) in arrays of about PIECE bytes."""
    parts, owners, total = [], [], 0
    for i, data in enumerate(texts):
        for at in range(0, max(len(data) - REACH, 0), PIECE):
            part = data[at : at + PIECE + REACH]
            parts.append(part)
            owners.append((i, len(part)))
            total += len(part)
            if total >= PIECE:
                yield _joined(parts, owners)
                parts, owners, total = [], [], 0
    if parts:
        yield _joined(parts, owners)


def _joined(parts, owners):
    which = np.repeat(np.array([[i, -1] for i, _ in owners]).ravel(),
                      np.array([[n - REACH, REACH] for _, n in owners]).ravel())
    return np.frombuffer(b"".join(parts), np.uint8), which


def triplet_counts(texts: list[bytes]) -> np.ndarray:
    """How many triplets of each text fall into each bucket; texts under REACH + 1 bytes have none."""
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    for data, owner in _packed(texts):
        low, high = owner[0], owner.max()
        base = np.where(owner < 0, high + 1, owner)[:-REACH].astype(np.int64) - low
        base *= BUCKETS
        x = data.astype(np.uint32)
        first, second, third = x * np.uint32(0x9E3779B1), x * np.uint32(0x85EBCA77), x * np.uint32(0xC2B2AE3D)
        n, size = len(x) - REACH, (high - low + 2) * BUCKETS
        found = np.zeros(size, np.int64)
        for salt, (j, k) in enumerate(TRIPLETS):
            h = first[:n] + second[j : j + n] + third[k : k + n] + np.uint32(0x27D4EB2F * salt & 0xFFFFFFFF)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h >>= np.uint32(25)
            found += np.bincount(base + h, minlength=size)
        counts[low : high + 1] += found.reshape(-1, BUCKETS)[:-1]
    return counts


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(quartile 0..3 of every bucket's count, length code) of each text."""
    counts = triplet_counts(texts)
    at = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    cuts = np.partition(counts, at, axis=1)[:, at] if len(texts) else np.zeros((0, 3))
    quartile = sum((counts > cuts[:, [i]]).astype(np.uint8) for i in range(3))
    size = np.fromiter(map(len, texts), np.float64, len(texts))
    return quartile, np.rint(LENGTH_STEPS * np.log2(size + 1)).astype(np.int64)


def as_text(quartile: np.ndarray, length: np.ndarray) -> list[str]:
    """Length code as 4 hex digits, then 2 bits for each bucket."""
    quads = quartile.reshape(len(quartile), BUCKETS // 4, 4)
    body = (quads[:, :, 0] << 6 | quads[:, :, 1] << 4 | quads[:, :, 2] << 2 | quads[:, :, 3]).astype(np.uint8)
    return [f"{n:04x}{row.tobytes().hex()}" for n, row in zip(length.tolist(), body)]


def difference(a, b) -> np.ndarray:
    """From 0 for equal digests to OPPOSITE * BUCKETS + LENGTH_BOUND."""
    body = STEPS[np.abs(a[0].astype(np.int64) - b[0].astype(np.int64))].sum(axis=1)
    return body + np.minimum(np.abs(a[1] - b[1]), LENGTH_BOUND)


def likeness(a, b) -> np.ndarray:
    """1 for equal digests, 0 from the mean difference of unrelated ones on."""
    return np.maximum(0.0, 1.0 - difference(a, b) / UNRELATED)


def edited(text: str, following: str) -> str:
    """The last third of the text gives way to as many first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


OUT = (
    "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def neighbours(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", per_bucket: int = 500, most: int = 4096):
    """Documents in buckets of neighbouring ids, each with the first document of the bucket that follows.

    Columns doc_id, text, ``bucket``, ``guest``: rows in order of (bucket, guest, id and text descending)
    have their next document behind them; a guest only closes its bucket. Buckets are cut at quantiles of
    the ids; the driver sees one row per bucket, at most ``most``. Rows without an id have no place in
    the order, negative buckets and no next document.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = docs.select(F.col(doc_id).alias("doc_id")).where(F.col("doc_id").isNotNull())
    wanted = max(1, min(most, ids.count() // per_bucket))
    place = ids.select(F.col("doc_id").cast("double").alias("_place"))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = sorted(set(place.approxQuantile("_place", shares, 0.25 / wanted))) if shares else []
    cuts = cuts or [0.0]  # a cut anywhere will do
    cutter = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol="_place", outputCol="_cut", handleInvalid="keep"
    )

    def cut(df):
        placed = cutter.transform(df.withColumn("_place", F.col("doc_id").cast("double")))
        loose = -1 - F.pmod(F.xxhash64(F.col("text")), F.lit(64)) if "text" in df.columns else F.lit(-1)
        own = F.when(F.col("doc_id").isNull(), loose).otherwise(F.col("_cut").cast("long"))
        return placed.withColumn("bucket", own).drop("_place", "_cut")

    tops = sorted(
        (tuple(r) for r in cut(ids).groupBy("bucket").agg(F.max("doc_id")).collect()), reverse=True
    )
    # the top of each bucket follows the bucket above it, and the top of all follows the lowest bucket
    hosts = {tops[i][1]: tops[i - 1][0] for i in range(len(tops))}
    spark = docs.sparkSession
    guests = spark.createDataFrame(
        [(i, b) for i, b in hosts.items()], f"doc_id {docs.schema[doc_id].dataType.simpleString()}, _host long"
    )
    placed = cut(rows).join(F.broadcast(guests), "doc_id", "left")  # at most ``most`` rows
    stays = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    visits = F.struct(F.col("_host").alias("bucket"), F.lit(True).alias("guest"))
    seats = F.when(F.col("_host").isNull(), F.array(stays)).otherwise(F.array(stays, visits))
    return placed.select("doc_id", "text", F.explode(seats).alias("_seat")).select("doc_id", "text", "_seat.*")


def _with_next(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Digest each row with the row behind it; the last row of a batch waits for the next one."""
    waiting = None

    def made(rows: pa.RecordBatch, last: bool):
        n = rows.num_rows - (0 if last else 1)
        texts = rows.column(1).to_pylist()
        bucket, guest = rows.column(2).to_pylist(), rows.column(3).to_pylist()
        own = [i for i in range(n) if not guest[i]]
        follower = [i + 1 if i + 1 < len(texts) and bucket[i] == bucket[i + 1] and bucket[i] >= 0 else -1 for i in own]
        changed = [edited(texts[i], texts[j] if j >= 0 else "") for i, j in zip(own, follower)]
        raw = [t.encode("utf-8") for t in changed]
        base = digests([*(t.encode("utf-8") for t in texts), b""])
        mine, behind = ([a[k] for a in base] for k in (np.array(own, int), np.array(follower, int)))
        other = digests(raw)
        return pa.RecordBatch.from_arrays([
            rows.column(0).take(pa.array(own, pa.int64())),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
            pa.array(as_text(*mine), pa.string()), pa.array(as_text(*other), pa.string()),
            pa.array(likeness(mine, other)), pa.array(likeness(mine, behind)),
        ], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        yield made(batch, False)
        waiting = batch.slice(batch.num_rows - 1)
    if waiting is not None:
        yield made(waiting, True)


def fingerprint_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Digest of every whole text and of its edited form, with their likeness and that to the next document.

    The next document is the one with the next smaller id, after the smallest the largest; rows of one id
    are ordered by text. Null and empty texts have the digest of no bytes. A row without an id has no next
    document: it is edited with, and compared to, the empty text. A single document is its own next one.

    One shuffle of the texts by buckets of neighbouring ids; rows then stream past in order.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    from barflow.llm.frames import fields

    schema = fields(OUT.format(id=docs.schema[doc_id].dataType.simpleString()))
    arrow = to_arrow_schema(schema)
    order = ["bucket", "guest", F.desc_nulls_last("doc_id"), F.desc("text")]
    rows = neighbours(docs, text, doc_id).repartition("bucket").sortWithinPartitions(*order)
    return rows.mapInArrow(lambda batches: _with_next(batches, arrow), schema)


def likeness_of(a: str, b: str) -> float:
    """The likeness of two fingerprints given as text."""
    def parsed(s):
        body = np.frombuffer(bytes.fromhex(s[4:]), np.uint8)
        quads = np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], axis=1).reshape(1, -1)
        return quads, np.array([int(s[:4], 16)])
    return float(likeness(parsed(a), parsed(b))[0])
