"""Hard-negative mining by LEMP-style retrieval: length buckets with sorted coordinate lists, pruned per anchor.

Vectors lie sorted by length. A task reads them bucket by bucket (one Arrow batch each). For an anchor a and the
least score s that still counts, the cosine to a must be s / (|a| * length of the longest vector of the bucket) at
least, which leaves a range of values for each coordinate. The ranges of the anchor's focus coordinates, looked up
in the bucket's sorted lists, are intersected; what remains is verified by exact integer inner products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from barflow.llm.frames import released
from barflow.llm.positions import AT, laid_out, numbered
from barflow.session import stage

FOCUS = 4  # coordinates whose ranges are intersected
BLOCK = 1 << 14  # anchors searched for in one pass over the vectors
TILE = 512  # anchors whose scores are held at once
EXACT = 2.0**53  # products below are exact as doubles
SLACK = 1e-9  # by which feasible ranges are widened against rounding


# --- one bucket -----------------------------------------------------------------------------------

class Bucket:
    """Vectors of similar length, for each coordinate in order of its share of the length."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.sqrt((vectors * vectors).sum(1))
        self.longest = float(lengths.max(initial=0.0))
        self.unit = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers in order of the coordinate, and its values in that order."""
        if coordinate not in self._lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self._lists[coordinate] = order, self.unit[order, coordinate]
        return self._lists[coordinate]

    def candidates(self, anchor: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that may have an inner product of ``least`` or more with ``anchor``; None for all rows.

        Where the ranges leave most of the bucket, all rows are verified: that is cheaper, and no row is lost.
        """
        length = float(np.sqrt(anchor @ anchor))
        if least <= 0 or not np.isfinite(least):
            return None
        cosine = least / (length * self.longest) if length * self.longest > 0 else np.inf
        if cosine > 1 + SLACK:
            return np.zeros(0, np.int64)
        unit = anchor / length
        spread = np.arccos(min(cosine, 1.0))
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist():
            angle = np.arccos(np.clip(unit[f], -1.0, 1.0))
            low = np.cos(min(np.pi, angle + spread)) - SLACK
            high = np.cos(max(0.0, angle - spread)) + SLACK
            order, values = self.sorted_list(f)
            ranges.append(order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")])
        if min(map(len, ranges)) * 2 > len(self.vectors):
            return None
        seen = np.zeros(len(self.vectors), np.int8)
        for rows in ranges:
            seen[rows] += 1
        return np.flatnonzero(seen == len(ranges))


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products, (rows, anchors); beyond 53 bits with Python's integers."""
    bound = np.abs(rows).max(initial=0.0) * np.abs(anchors).max(initial=0.0) * max(rows.shape[1], 1)
    if bound < EXACT:
        return rows @ anchors.T
    exact = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)
    return exact(rows) @ exact(anchors).T


# --- searches -------------------------------------------------------------------------------------

@dataclass
class Searches:
    """Wanted lists: for each the anchor's vector and label, whether partners share the label, the scores allowed."""

    vectors: np.ndarray  # (anchors, dimensions)
    labels: np.ndarray  # per anchor
    own: np.ndarray  # per anchor: its row, which is never its own partner
    anchor: np.ndarray  # per list: its anchor; lists of one anchor are neighbours
    low: np.ndarray  # per list
    high: np.ndarray  # per list
    top: int
    same: bool
    found: list = field(default_factory=list)  # per list: (scores, ids, rows), best first

    def __post_init__(self):
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none)] * len(self.anchor)
        self.begin = np.searchsorted(self.anchor, np.arange(len(self.labels) + 1))

    def least(self, i: int):
        """The least score with which a row can still enter list i."""
        scores = self.found[i][0]
        return max(self.low[i], scores[-1]) if len(scores) == self.top else self.low[i]

    def offer(self, i: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        old = self.found[i]
        scores, ids, rows = (np.concatenate(pair) for pair in zip(old, (scores, ids, rows)))
        best = np.lexsort((rows, ids, -scores))[: self.top]
        self.found[i] = scores[best], ids[best], rows[best]

    def read(self, bucket: Bucket, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        whole, some = [], []
        for a, (first, end) in enumerate(zip(self.begin[:-1].tolist(), self.begin[1:].tolist())):
            if first < end:
                near = bucket.candidates(self.vectors[a], float(min(self.least(i) for i in range(first, end))))
                (whole if near is None else some).append((a, first, end, near))
        for at in range(0, len(whole), TILE):
            tile = whole[at : at + TILE]
            scores = products(bucket.vectors, self.vectors[[t[0] for t in tile]]).T
            for (a, first, end, _), row in zip(tile, scores):
                self._verify(a, first, end, row, slice(None), ids, labels, rows)
        for a, first, end, near in some:
            if len(near):
                row = products(bucket.vectors[near], self.vectors[a : a + 1])[:, 0]
                self._verify(a, first, end, row, near, ids, labels, rows)

    def _verify(self, a, first, end, scores, chosen, ids, labels, rows) -> None:
        ids, labels, rows = ids[chosen], labels[chosen], rows[chosen]
        fit = (labels == self.labels[a]) & (rows != self.own[a]) if self.same else labels != self.labels[a]
        for i in range(first, end):
            at = np.flatnonzero(fit & (scores >= self.least(i)) & (scores <= self.high[i]))
            if len(at) > 4 * self.top:  # ties with the last one stay
                least = np.partition(scores[at], len(at) - self.top)[len(at) - self.top]
                at = at[scores[at] >= least]
            if len(at):
                self.offer(i, scores[at].astype(np.int64), ids[at], rows[at])


# --- Spark jobs -----------------------------------------------------------------------------------

def matrix(vectors: list, dimensions: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dimensions))
    for row, v in zip(out, vectors):
        row[: min(len(v), dimensions)] = v[:dimensions]
    return out


def _columns(batch: pa.RecordBatch, dimensions: int):
    rows, ids, labels, lists = (batch.column(i) for i in range(4))
    sizes = lists.value_lengths().to_numpy()
    if len(sizes) and (sizes == dimensions).all():
        vectors = lists.flatten().to_numpy().reshape(-1, dimensions).astype(np.float64)
    else:
        vectors = matrix(lists.to_pylist(), dimensions)
    return vectors, ids.to_numpy(), labels.to_numpy(), rows.to_numpy()


def _search(index: DataFrame, build, dimensions: int) -> DataFrame:
    """The best of every list in each task: (list, score, id, row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = build()
        for batch in batches:
            vectors, ids, labels, rows = _columns(batch, dimensions)
            searches.read(Bucket(vectors), ids, labels, rows)
        sizes = [len(scores) for scores, _, _ in searches.found]
        columns = [np.repeat(np.arange(len(sizes)), sizes)]
        columns += [np.concatenate([np.zeros(0, np.int64), *part]) for part in zip(*searches.found)] if sizes else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["list", "score", "id", "row"])

    found = index.select(AT, "id", "label", "vector")
    return found.mapInArrow(released(run), "list long, score long, id long, row long")


def _best(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each list over all tasks, with their rank from 1."""
    order = Window.partitionBy("list").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def vector_index(rows: DataFrame, vec_id: Column, label: Column, vector: Column, scale: int) -> DataFrame:
    """Stored rows (id, label, vector of integers, length) in order of falling length."""
    vector = vector.cast("array<double>")
    quantised = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = rows.where(vec_id.isNotNull() & label.isNotNull() & vector.isNotNull()).where(finite).select(
        vec_id.cast("long").alias("id"), label.cast("long").alias("label"), quantised.alias("vector")
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    measured = chosen.withColumn("length", F.sqrt(square))
    return laid_out(measured, F.col("length").desc(), F.col("id"), name="vectors")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", label: str | Column = "label",
    vector: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10,
    least: int = 30, most: int = 90, block: int = BLOCK,
) -> DataFrame:
    """For each anchor and each of its first ``positives``, the first ``negatives`` rows of other labels in the band.

    Components x count as floor(``scale`` * x); scores are integer inner products, higher ones first, ties by smaller
    id. ``anchors`` says, on ``id`` and ``label``, which rows are anchors; positives are other rows of the anchor's
    label. Negatives score from ``least`` to ``most`` percent of the positive, so positives below zero have none. All
    lists are exact. Rows without id, label or vector, and those with a component that is null, NaN or infinite, take
    no part; shorter vectors count as ending in zeros. Equal rows are rows of their own: a repeated anchor has its lists
    once for each copy, and each copy of a negative can be listed. Tables without rows or anchors give none; other
    columns are not read.

    Rows are sorted by length once and stored; then each pass searches for one ``block`` of anchors, which is all that
    the driver and a task hold besides one bucket: their vectors and the best found so far. A pass reads the stored
    rows where they lie; only the best of each task are shuffled, a few rows for each list and task.
    """
    spark = rows.sparkSession
    key = F.col(label) if isinstance(label, str) else label
    index = vector_index(rows, F.col(vec_id), key, F.col(vector), scale)
    chosen = laid_out(index.where(anchors).select("id", "label", "vector", F.col(AT).alias("row")), F.col("row"), name="anchors")
    chosen = stage(numbered(chosen, "n"), "numbered")
    count, dimensions = chosen.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    done = [spark.createDataFrame([], RESULT)]
    for first in range(0, count, block):
        given = chosen.where((F.col("n") > first) & (F.col("n") <= first + block)).orderBy("n").collect()
        done.append(_block(index, given, dimensions, positives, negatives, least, most))
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def _block(index, given, dimensions, positives, negatives, least, most) -> DataFrame:
    """The result for one block of anchors, stored."""
    vectors = matrix([r["vector"] for r in given], dimensions)
    labels = np.array([r["label"] for r in given], np.int64)
    own = np.array([r["row"] for r in given], np.int64)
    ids = [r["id"] for r in given]
    spark = index.sparkSession

    def own_label() -> Searches:
        n = len(own)
        return Searches(vectors, labels, own, np.arange(n), np.full(n, -np.inf), np.full(n, np.inf), positives, True)

    near = _best(_search(index, own_label, dimensions), positives).orderBy("list", "rank").collect()
    pairs = [(r["list"], r["id"], r["score"]) for r in near if r["score"] >= 0]
    anchor = np.array([p[0] for p in pairs], np.int64)
    # integers a with least * score <= 100 * a <= most * score
    low = np.array([-(-least * p[2] // 100) for p in pairs], np.float64)
    high = np.array([most * p[2] // 100 for p in pairs], np.float64)

    def other_label() -> Searches:
        return Searches(vectors, labels, own, anchor, low, high, negatives, False)

    named = spark.createDataFrame(
        [(i, ids[a], positive, score) for i, (a, positive, score) in enumerate(pairs)],
        "list long, anchor_id long, positive_id long, positive_score long",
    )
    found = _best(_search(index, other_label, dimensions), negatives).join(named, "list").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
    return stage(found, "negatives")


def mine_negatives(embeddings: DataFrame) -> DataFrame:
    """Anchors are the ids divisible by 100; ids divisible by 7 count under the next of ten labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings, F.col("id") % 100 == 0, label=label)


def mine_negatives_sql() -> str:
    return """
    WITH given AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, a.label = r.label AS own, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
        FROM given a JOIN given r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE own
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT own
        AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""
