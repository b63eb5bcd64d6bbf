"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from barflow.llm.codes import Hasher, blocks, carried, combine, runs, word_characters
from barflow.llm.frames import bounded_sample, fields, held_out, map_texts, released, training_rows

BITS = 18
#: Word patterns: offsets from the first word. (0,) are single words, (0, 2) skips one.
PATTERNS = ((0,), (0, 1), (0, 2), (0, 1, 2))
GROUP = 256  # texts whose features are collected together


@dataclass
class SparseWeights:
    """Nonzero weights of a logistic regression on 2**bits hashed features, and its bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        full = np.zeros(1 << self.bits, np.float32)
        full[self.index] = self.weight
        return full


def features(texts: list, bits: int = BITS):
    """Yields (owner, feature) arrays for all n-grams and skip-grams of all texts, block by block.

    A pattern counts with its last word; the words before may stand in the block before.
    """
    drop, longest, before = np.uint64(64 - bits), max(o[-1] for o in PATTERNS), None
    for block in blocks([t.lower() if t else "" for t in texts]):
        starts, ends = runs(word_characters()[block.codes])
        found = Hasher(block.codes).stretches(starts, ends)
        before, old = carried(block.owner_of(starts), found, before=before, back=longest)
        owner, words = before
        for salt, offsets in enumerate(PATTERNS):
            first = np.arange(max(0, old - offsets[-1]), len(words) - offsets[-1])
            first = first[owner[first] == owner[first + offsets[-1]]]
            hashes = combine(*(words[first + o] for o in offsets), np.uint64(salt + 1))
            yield owner[first], (hashes >> drop).astype(np.int64)


def ftrl(
    rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = 3,
    alpha: float = 2.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.5,
) -> SparseWeights:
    """Fit on rows of distinct feature numbers: per-coordinate rates from summed squared gradients.

    A weight is exactly 0 until its accumulated gradient exceeds ``l1``. The bias is a coordinate of its
    own without L1.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    z0 = n0 = 0.0
    order = np.random.default_rng(7)

    def solved(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x = rows[i]
            w, w0 = solved(z[x], n[x]), -z0 / ((beta + n0**0.5) / alpha + l2)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - labels[i]
            if g == 0.0:
                continue
            more = np.sqrt(n[x] + g * g)
            z[x] += g - (more - np.sqrt(n[x])) / alpha * w
            n[x] += g * g
            more0 = (n0 + g * g) ** 0.5
            z0 += g - (more0 - n0**0.5) / alpha * w0
            n0 += g * g
    w = solved(z, n)
    index = np.flatnonzero(w)
    return SparseWeights(index, w[index].astype(np.float32), float(-z0 / ((beta + n0**0.5) / alpha + l2)), bits)


def distinct_features(texts: list, bits: int = BITS) -> list[np.ndarray]:
    """The distinct features of each text."""
    out = []
    for at in range(0, len(texts), GROUP):
        group = texts[at : at + GROUP]
        keys = [np.zeros(0, np.int64)]
        for owner, feature in features(group, bits):
            keys.append(np.unique(owner << bits | feature))
        key = np.unique(np.concatenate(keys))
        cuts = np.searchsorted(key, np.arange(len(group) + 1) << bits)
        low = (key & (1 << bits) - 1).astype(np.int32)
        out += [low[a:b].copy() for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label, text) of about ``per_class`` training documents of either label.

    The sampled ids are few (``per_class`` bounds them) and are broadcast to find their texts. Labels other than
    0 and 1 and ids outside the training part are left out; of contradicting labels of an id the larger counts.
    """
    usable = labels.where(training_rows() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label"))
    chosen = bounded_sample(usable, "label", "doc_id", per_class).groupBy("doc_id").agg(F.max("label").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def _featured(batches):
    """The distinct features of each sampled text, made where the text is read."""
    for b in batches:
        found = [pa.array(x) for x in distinct_features(b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "features"])


def _fit_task(batches):
    rows = [
        (i, y, x.values.to_numpy()) for b in batches
        for i, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))
    ]
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))  # the same order whatever order the rows came in
    if rows:
        model = ftrl([r[2] for r in rows], np.array([r[1] for r in rows], float))
        index, weight = np.append(model.index, -1), np.append(model.weight.astype(float), model.bias)
        yield pa.RecordBatch.from_arrays([pa.array(index.astype(np.int64)), pa.array(weight)], ["index", "weight"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 4000) -> SparseWeights:
    """Fit on a bounded sample: about ``per_class`` labelled training documents of either class.

    Features are made where the texts are read. One executor task gets feature numbers alone, at most 2**BITS a
    document, and returns the nonzero weights; without labelled rows all are zero. Repeated rows count repeatedly.
    """
    sample = labelled_sample(docs, labels, label, per_class)
    made = sample.mapInArrow(released(_featured), StructType(sample.schema.fields[:2] + fields("features array<int>").fields))
    table = made.repartition(1).mapInArrow(released(_fit_task), "index long, weight double").toArrow()
    index, weight = (table.column(c).to_numpy() for c in ("index", "weight"))
    bias = float(weight[index < 0].sum())
    return SparseWeights(index[index >= 0], weight[index >= 0].astype(np.float32), bias)


def scores(model: SparseWeights, texts: list, dense: np.ndarray) -> np.ndarray:
    """Probability of label 1: each distinct feature with a weight counts once per text."""
    total = np.full(len(texts), model.bias)
    hit = [np.zeros(0, np.int64)]
    for owner, feature in features(texts, model.bits):
        live = dense[feature] != 0
        hit.append(owner[live] << model.bits | feature[live])
    key = np.unique(np.concatenate(hit))
    total += np.bincount(key >> model.bits, dense[key & (1 << model.bits) - 1], len(texts))
    return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def score_toxicity(docs: DataFrame, model: SparseWeights, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` of every whole text; the sparse weights go out with the function.

    Null and empty texts have no feature and get the score of the bias; very long ones are scored whole, block by
    block. Rows are scored one by one, repeated ones too, without a shuffle; an empty table gives an empty one. Other
    columns are not read; ``keep`` must not hold ``score``.
    """
    def run(texts):
        return {"score": scores(model, texts, model.dense())}

    return map_texts(docs, run, "score double", text, keep)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents, by a model of the labelled training part."""
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs.withColumn("held_out", held_out()), model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
