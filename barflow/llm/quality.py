"""Quality classifier: averaged vectors of hashed words and character n-grams under a softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from barflow.llm.codes import Hasher, blocks, carried, combine, runs
from barflow.llm.frames import fields, held_out, map_texts, released
from barflow.llm.toxicity import labelled_sample

BITS = 16
WIDTH = 12
ORDERS = (3, 4)  # character n-grams; words are separated by white space, so their signs belong to them
CLASSES = 2
REPEATED = 1  # bucket of words that equal the word before them


@dataclass
class SubwordModel:
    """``vectors`` of 2**bits buckets, ``output`` weights per class and their bias."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def logits(self) -> np.ndarray:
        """What one occurrence of each bucket adds to each class, before averaging."""
        return self.vectors @ self.output


def features(texts: list, bits: int = BITS):
    """Yields (owner, bucket) arrays: every word, a mark for a repeated one, then every n-gram of each order inside words and their borders."""
    drop, before = np.uint64(64 - bits), None
    for block in blocks(texts):
        white = block.codes <= 32
        starts, ends = runs(~white)
        hasher = Hasher(np.where(white, np.uint32(32), block.codes))
        owner = np.repeat(block.owner, np.diff(np.append(block.starts, len(block.codes))))
        words = combine(hasher.stretches(starts, ends), np.uint64(1))
        yield owner[starts - 1], (words >> drop).astype(np.int64)
        before, _ = carried(owner[starts - 1], words, before=before, back=1)
        of, word = before
        again = of[1:][(word[1:] == word[:-1]) & (of[1:] == of[:-1])]
        yield again, np.full(len(again), REPEATED, np.int64)
        for n in ORDERS:
            grams = hasher.grams(n)
            last = len(grams)
            # white space may stand at the first or last place of an n-gram only
            inner = np.flatnonzero(~np.logical_or.reduce([white[i : i + last] for i in range(1, n - 1)]))
            yield owner[inner], (combine(grams[inner], np.uint64(n)) >> drop).astype(np.int64)


def counted(texts: list, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, occurrences) of each text."""
    keys = [np.zeros(0, np.int64)]
    counts = [np.zeros(0, np.int64)]
    for owner, feature in features(texts, bits):
        key, n = np.unique(owner << bits | feature, return_counts=True)
        keys.append(key)
        counts.append(n)
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(inverse, np.concatenate(counts), len(key))
    cuts = np.searchsorted(key, np.arange(len(texts) + 1) << bits)
    return [(key[a:b] & (1 << bits) - 1, n[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def train(
    rows: list[tuple], labels: np.ndarray, bits: int = BITS, epochs: int = 6, least_steps: int = 20_000, rate: float = 0.5
) -> SubwordModel:
    """Stochastic gradient descent, one document a step, with a rate that falls to zero.

    Few documents are passed over more often, until ``least_steps`` are taken.
    """
    epochs = max(epochs, -(-least_steps // len(rows)))
    draw = np.random.default_rng(11)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (1 << bits, WIDTH)).astype(np.float32)
    output, bias = np.zeros((WIDTH, CLASSES), np.float32), np.zeros(CLASSES, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            eta = rate * (1 - done / steps)
            done += 1
            buckets, n = rows[i]
            if not len(buckets):
                hidden = np.zeros(WIDTH, np.float32)
            else:
                share = (n / n.sum()).astype(np.float32)
                hidden = share @ vectors[buckets]
            out = hidden @ output + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[int(labels[i])] -= 1.0
            back = output @ p
            output -= eta * np.outer(hidden, p)
            bias -= eta * 0.1 * p
            if len(buckets):
                # a bucket moves by its share of the average, scaled up as averages of many are small
                vectors[buckets] -= (eta * np.minimum(1.0, 20 * share))[:, None] * back
    return SubwordModel(vectors, output, bias)


def _featured(batches):
    """(buckets, occurrences) of each sampled text, made where the text is read."""
    for b in batches:
        found = counted(b.column(2).to_pylist())
        lists = [pa.array([pa.array(x[k].astype(np.int32)) for x in found], pa.list_(pa.int32())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], ["doc_id", "label", "buckets", "n"])


def _fit_task(batches):
    rows = [
        (i, y, x.values.to_numpy(), n.values.to_numpy()) for b in batches
        for i, y, x, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3))
    ]
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes(), r[3].tobytes()))
    if rows:
        model = train([r[2:] for r in rows], np.array([r[1] for r in rows]))
        parts = [model.vectors, model.output, model.bias]
        yield pa.RecordBatch.from_arrays([pa.array([p.astype("<f4").tobytes() for p in parts], pa.binary())], ["part"])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2500) -> SubwordModel:
    """Fit on a bounded sample: about ``per_class`` labelled training documents of either class.

    Features are counted where the texts are read. One executor task gets bucket numbers and counts alone, at most
    2**BITS a document, and returns the vectors (2**BITS * WIDTH numbers). Without labelled rows every text gets an
    even score. Repeated rows count repeatedly.
    """
    sample = labelled_sample(docs, labels, label, per_class)
    schema = StructType(sample.schema.fields[:2] + fields("buckets array<int>, n array<int>").fields)
    made = sample.mapInArrow(released(_featured), schema).repartition(1)
    parts = [np.frombuffer(r[0], "<f4") for r in made.mapInArrow(released(_fit_task), "part binary").collect()]
    if not parts:
        return SubwordModel(np.zeros((1 << BITS, WIDTH)), np.zeros((WIDTH, CLASSES)), np.zeros(CLASSES))
    return SubwordModel(parts[0].reshape(-1, WIDTH), parts[1].reshape(WIDTH, CLASSES), parts[2])


def scores(gain: np.ndarray, bias: float, texts: list) -> np.ndarray:
    """Softmax probability of class 1 from the mean gain (logit of class 1 minus class 0) of a text's features."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for owner, feature in features(texts):
        total += np.bincount(owner, gain[feature], len(texts))
        n += np.bincount(owner, minlength=len(texts))
    return 1.0 / (1.0 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -35, 35)))


def score_quality(docs: DataFrame, model: SubwordModel, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` of every whole text.

    Averaging and output layer are linear, so each bucket's vector is multiplied out once, and a text needs
    one number per feature. Null and empty texts have no feature and get the score of the bias; very long ones are
    scored whole, block by block. Repeated rows are scored one by one; an empty table gives an empty one. Other
    columns are not read; ``keep`` must not hold ``score``.
    """
    logits = model.logits()
    gain, bias = (logits[:, 1] - logits[:, 0]).astype(np.float32), float(model.bias[1] - model.bias[0])
    return map_texts(docs, lambda texts: {"score": scores(gain, bias, texts)}, "score double", text, keep)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents, by a model of the labelled training part."""
    model = fit_quality(docs, labels)
    scored = score_quality(docs.withColumn("held_out", held_out()), model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
