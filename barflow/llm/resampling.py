"""Target-distribution importance resampling: hashed word windows weigh documents towards a target's texts."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from barflow.llm.crcsql import CRC_TABLE, crc32_sql
from barflow.llm.frames import TEXT, fields, released
from barflow.llm.positions import laid_out, numbered
from barflow.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of text whose A-Z are lower case
BUCKETS = 10_000
GROUP = 1 << 20  # UTF-8 bytes of texts worked on at once, besides the last text
PIECE = 1 << 18  # characters given to the pre-tokenizer at once
LONG = 48  # bytes of a word from which it is hashed by itself


@lru_cache(1)
def splitter() -> Split:
    """Keeps the words and their offsets, drops what lies between; nothing is learnt."""
    return Split(Regex(WORD), "removed", invert=True)


def _separators(codes: np.ndarray) -> np.ndarray:
    """True for the code points that are in no word."""
    return (codes < 48) | ((codes > 57) & (codes < 97)) | ((codes > 122) & (codes < 128))


def offsets(text: str) -> np.ndarray:
    """(start, end) of the words of a text in characters, from the pre-tokenizer.

    Long texts are handed over in pieces that end at a separator, so no word is cut.
    """
    found, at, size = [], 0, len(text)
    while at < size:
        end = min(at + PIECE, size)
        while end < size:
            codes = np.frombuffer(text[end - 1 : end - 1 + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
            gaps = np.flatnonzero(_separators(codes))
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + PIECE - 1, size)
        spans = [span for _, span in splitter().pre_tokenize_str(text[at:end])]
        found.append(np.array(spans, np.int64).reshape(-1, 2) + at)
        at = end
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def byte_offsets(raw: bytes, text: str, spans: np.ndarray) -> np.ndarray:
    """Offsets in characters as offsets in the UTF-8 bytes."""
    if len(raw) == len(text) or not len(spans):
        return spans
    lead = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # the first byte of each character
    return np.append(lead, len(raw))[spans]


@lru_cache(1)
def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def extended(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running CRC32 states, each taken on over its own stretch of ``data``, one byte of all stretches at a time."""
    table, state, sizes = crc_table(), state.copy(), ends - starts
    falling = -np.minimum(sizes, LONG)
    order = np.argsort(falling, kind="stable")
    counts = np.searchsorted(falling[order], -np.arange(LONG), "left")  # how many are longer than 0, 1, ... bytes
    sorted_state, sorted_starts = state[order], starts[order]
    for j, n in enumerate(counts.tolist()):
        if not n:
            break
        part = sorted_state[:n]
        sorted_state[:n] = table[(part ^ data[sorted_starts[:n] + j]) & np.uint32(255)] ^ (part >> np.uint32(8))
    state[order] = sorted_state
    for i in np.flatnonzero(sizes > LONG).tolist():
        rest = data[starts[i] + LONG : ends[i]].tobytes()
        state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


class Words:
    """The words of some texts as stretches of one byte array."""

    def __init__(self, texts: list):
        data, starts, counts, base = [], [], [], 0
        for text in texts:
            raw = (text or "").encode("utf-8").lower()  # of bytes, lower() takes A-Z alone
            lowered = raw.decode("utf-8")
            spans = byte_offsets(raw, lowered, offsets(lowered))
            data.append(raw)
            starts.append(spans + base)
            counts.append(len(spans))
            base += len(raw)
        self.data = np.frombuffer(b"".join(data), np.uint8)
        spans = np.concatenate([np.zeros((0, 2), np.int64), *starts])
        self.starts, self.ends = spans[:, 0], spans[:, 1]
        self.counts = np.array(counts, np.int64)
        self.owner = np.repeat(np.arange(len(counts)), self.counts)

    def windows(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(owner, CRC32) of every run of 1 to ``most`` consecutive words of a text, joined by one space."""
        table, n = crc_table(), len(self.starts)
        state = extended(np.full(n, 0xFFFFFFFF, np.uint32), self.data, self.starts, self.ends)
        yield self.owner, ~state
        for size in range(2, most + 1):
            state = state[: max(len(state) - 1, 0)]
            if not len(state):
                return
            spaced = table[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
            state = extended(spaced, self.data, self.starts[size - 1 :], self.ends[size - 1 :])
            inside = self.owner[: len(state)] == self.owner[size - 1 :]
            yield self.owner[: len(state)][inside], ~state[inside]


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, number) of neighbouring texts of about GROUP bytes together."""
    group = (np.cumsum(sizes) - sizes) // GROUP
    first = np.flatnonzero(np.diff(group, prepend=-1))
    yield from zip(first.tolist(), np.diff(np.append(first, len(sizes))).tolist())


def window_buckets(texts: list, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, windows per text, and the bucket of every window, text by text."""
    words = Words(texts)
    owner, crc = map(np.concatenate, zip(*words.windows(most)))
    by_text = np.argsort(owner, kind="stable")
    return words.counts, np.bincount(owner, minlength=len(texts)), (crc % np.uint32(buckets))[by_text]


SPEC = "n_words long, n_features long, buckets binary"
NUMBER = np.dtype("<u2")  # of a bucket


def features(docs: DataFrame, text: str, keep, most: int, buckets: int) -> DataFrame:
    """k0, k1, ... (the kept columns), n_words, n_features and the bucket numbers of all features, in one pass."""
    spec = fields(SPEC)
    rows = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias(TEXT))
    names = rows.columns[:-1]
    schema = StructType([rows.schema[c] for c in names] + spec.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names))
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n in _groups(lengths):
                words, sizes, found = window_buckets(texts.slice(at, n).to_pylist(), most, buckets)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32) * NUMBER.itemsize
                numbers = pa.BinaryArray.from_buffers(
                    pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found.astype(NUMBER))]
                )
                kept = [c.slice(at, n) for c in batch.columns[: len(names)]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(words), pa.array(sizes), numbers], schema.names)

    return rows.mapInArrow(released(run), schema)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many bucket numbers each row has, and all of them."""
    parts = column.to_pylist()
    return np.array(list(map(len, parts)), np.int64) // NUMBER.itemsize, np.frombuffer(b"".join(parts), NUMBER)


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: added up per task, then per bucket; one number per bucket reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0))[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    counted = found.select("buckets").mapInArrow(released(run), "bucket int, n long")
    total = [0] * buckets
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return np.array(total, np.int64)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much more often, with one more feature in each bucket, the target has the bucket."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows with ``weight``, the floored mean of the gains of their features (none: 0), instead of the buckets."""
    rows = found.select(*(c for c in found.columns if c != "buckets"), "buckets")
    kept = len(rows.columns) - 1
    schema = StructType(rows.schema.fields[:kept] + fields("weight long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = _numbers(batch.column(kept))
            ends = np.concatenate([[0], np.cumsum(gain[found])])
            upto = np.cumsum(sizes)
            weight = (ends[upto] - ends[upto - sizes]) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(weight)], schema.names)

    return rows.mapInArrow(released(run), schema)


def resample(
    docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, most: int = 2,
    buckets: int = BUCKETS, seed: int = 7, text: str = "text", doc_id: str = "doc_id", keep=(),
) -> DataFrame:
    """doc_id and the ``keep`` columns of every row with n_words, n_features, weight, score and rank.

    Features are the runs of 1 to ``most`` words of the whole text, repeats counted, in ``buckets`` buckets by CRC32.
    A weight is the floored mean gain of a row's features towards the texts of ``target``; the score adds Gumbel noise
    from a hash of the seed and the id, so that the ``share`` percent highest scores of the rows with ``least_words``
    words are a draw without replacement by exp(weight / 1000). ``rank`` numbers the drawn rows from 1, ties by the
    smaller id; others have null. Null and empty texts have no features, weight 0 and no rank; an empty target leaves the
    corpus's own frequencies to decide. A row without an id has the noise of an empty id and comes first in a tie. Rows
    of one id and text have one score and neighbouring ranks. A table without rows gives none. Kept columns named like
    an added one are returned as ``<name>_given``.

    Features are made once and stored as small numbers; histograms reach the driver as ``buckets`` numbers. Ranks come
    from a range-partitioned sort, so equal scores may fill many tasks. Texts of any length go in pieces.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be from 1 to 65,536")
    kept = [doc_id, *keep]
    found = stage(features(docs, text, kept, most, buckets), "features")
    wanted = stage(features(target, text, [], most, buckets), "target")
    gain = gains(histogram(found, buckets), histogram(wanted, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("k0").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("long")
    scored = stage(weighed(found, gain).withColumn("score", F.col("weight") + noise), "scores")
    eligible = F.col("n_words") >= least_words
    laid = laid_out(scored.where(eligible), F.col("score").desc(), F.col("k0"), name="ranked")
    drawn = laid.count() * share // 100
    ranked = numbered(laid, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    added = ["n_words", "n_features", "weight", "score", "rank"]
    whole = ranked.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")))
    names = [doc_id, *(f"{c}_given" if c in added else c for c in keep)]
    return whole.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(names)), *added)


def resample_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


def resample_documents_sql() -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH {CRC_TABLE}, texts AS (
        SELECT true AS mine, doc_id, {words} AS w FROM documents UNION ALL SELECT false, NULL, {words} FROM benchmark),
    runs AS (
        SELECT mine, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM texts),
    hashed AS (
        SELECT feature, {crc32_sql('feature')} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM runs), crc_table),
    bucketed AS (SELECT mine, doc_id, bucket FROM runs JOIN hashed USING (feature)),
    counts AS (
        SELECT bucket, count(*) FILTER (WHERE mine) AS s, count(*) FILTER (WHERE NOT mine) AS t FROM bucketed GROUP BY bucket),
    sums AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
    gains AS (
        SELECT bucket, floor(1000 * ln((t + 1::DOUBLE) * (s_all + 10000) / ((s + 1::DOUBLE) * (t_all + 10000))))::BIGINT AS gain
        FROM counts, sums),
    weights AS (
        SELECT doc_id, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight FROM bucketed JOIN gains USING (bucket)
        WHERE mine GROUP BY doc_id),
    scored AS (
        SELECT d.doc_id, len(d.w) AS n_words, greatest(2 * len(d.w) - 1, 0)::BIGINT AS n_features, coalesce(w.weight, 0) AS weight,
            coalesce(w.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                / 4294967296::DOUBLE)))::BIGINT AS score
        FROM texts d LEFT JOIN weights w USING (doc_id) WHERE d.mine),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS drawn
        FROM scored WHERE n_words >= 20)
    SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
    FROM scored s LEFT JOIN ranked r USING (doc_id)"""
