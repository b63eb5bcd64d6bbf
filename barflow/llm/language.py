"""Language identification: words first, then ever shorter character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barflow.llm.codes import Block, Hasher, blocks, letters, runs
from barflow.llm.frames import bounded_sample, held_out, map_texts, released, training_rows

UNDETERMINED = "und"
LONGEST = 5  # characters of the longest n-gram; order 0 stands for whole words


@dataclass
class LanguageModel:
    """``keys[n]``: sorted hashes of order n; ``costs[n]``: minus the log frequency per language."""

    languages: list[str]
    keys: list[np.ndarray]
    costs: list[np.ndarray]

    def find(self, order: int, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where it is unknown."""
        keys = self.keys[order]
        if not len(keys):
            return np.full(len(hashes), -1)
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        return np.where(keys[at] == hashes, at, -1)


def word_runs(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return runs(letters()[block.codes])


def spaced(block: Block) -> Hasher:
    """Hashes that see any character but a letter as a space, so that n-grams at word borders agree."""
    return Hasher(np.where(letters()[block.codes], block.codes, np.uint32(32)))


def gram_starts(starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, start) of all n-grams of words with a space on either side; single characters without it."""
    border = int(n > 1)
    counts = np.maximum(ends - starts + 2 * border + 1 - n, 0)
    word = np.repeat(np.arange(len(starts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return word, starts[word] - border + np.arange(len(word)) - first


def _lowered(texts: list) -> list:
    return [t.lower() if t else "" for t in texts]


def _count_batches(languages: list[str]):
    index = {name: i for i, name in enumerate(languages)}

    def run(batches):
        for batch in batches:
            owner_language = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64)
            for block in blocks(_lowered(batch.column(1).to_pylist())):
                rows = []
                starts, ends = word_runs(block)
                language, hasher = owner_language[block.owner_of(starts)], spaced(block)
                for order in range(LONGEST + 1):
                    if order:
                        word, at = gram_starts(starts, ends, order)
                        which, hashes = language[word], hasher.stretches(at, at + order)
                    else:
                        which, hashes = language, hasher.stretches(starts, ends)
                    for k in np.unique(which):
                        keys, n = np.unique(hashes[which == k], return_counts=True)
                        rows.append((np.full(len(keys), k), np.full(len(keys), order), keys.view(np.int64), n))
                if rows:
                    columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays(columns, ["language", "gram", "key", "n"])

    return run


def fit_languages(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    docs_per_language: int = 1500, entries: int = 600_000,
) -> LanguageModel:
    """Learn from about ``docs_per_language`` training documents of each language.

    Counts are made and added up on the executors. The driver gets the most frequent words and n-grams,
    at most ``entries`` in all, dealt evenly over languages and orders; those seen once are left out
    unless a language has nothing else.
    """
    usable = docs.where(training_rows(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    usable = usable.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    languages = sorted(r[0] for r in usable.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], [np.zeros(0, np.uint64)] * (LONGEST + 1), [np.zeros((0, 0))] * (LONGEST + 1))
    sample = bounded_sample(usable, "lang", "id", docs_per_language).select("lang", "text")
    counted = sample.mapInArrow(released(_count_batches(languages)), "language long, gram long, key long, n long")
    totals = counted.groupBy("language", "gram", "key").agg(F.sum("n").alias("n"))
    per_table = max(50, entries // (len(languages) * (LONGEST + 1)))
    best = Window.partitionBy("language", "gram").orderBy(F.desc("n"), "key")
    whole = Window.partitionBy("language", "gram")
    table = (
        totals.withColumn("all", F.sum("n").over(whole)).withColumn("place", F.row_number().over(best))
        .where((F.col("place") <= per_table) & ((F.col("n") > 1) | (F.col("place") <= 50)))
        .select("language", "gram", "key", "n", "all").toArrow()
    )
    language, order, n, total = (table.column(c).to_numpy() for c in ("language", "gram", "n", "all"))
    key = table.column("key").to_numpy().view(np.uint64)
    keys, costs = [], []
    for o in range(LONGEST + 1):
        mine = order == o
        known, row = np.unique(key[mine], return_inverse=True)
        # what a language never showed costs as much as half an occurrence in the largest language
        cost = np.full((len(known), len(languages)), np.log(2.0 * total[mine].max(initial=1)), np.float32)
        cost[row, language[mine]] = -np.log(n[mine] / total[mine])
        keys.append(known)
        costs.append(cost)
    return LanguageModel(languages, keys, costs)


def word_costs(model: LanguageModel, block: Block, starts: np.ndarray, ends: np.ndarray):
    """(row of each word, cost rows): known words by their own frequency, others by backing off.

    An unseen word is scored by the mean over its known n-grams of the longest order that has any;
    a word of unknown characters costs every language the same.
    """
    hasher = spaced(block)
    hashes = hasher.stretches(starts, ends)
    row = model.find(0, hashes)
    unseen = np.flatnonzero(row < 0)
    if not len(unseen):
        return row, model.costs[0]
    _, first, inverse = np.unique(hashes[unseen], return_index=True, return_inverse=True)
    s, e = starts[unseen[first]], ends[unseen[first]]
    found = np.full((len(s), len(model.languages)), np.log(2.0), np.float64)
    open_words = np.arange(len(s))
    for order in range(LONGEST, 0, -1):
        word, at = gram_starts(s[open_words], e[open_words], order)
        hit = model.find(order, hasher.stretches(at, at + order))
        word, hit = word[hit >= 0], hit[hit >= 0]
        seen = np.bincount(word, minlength=len(open_words))
        cost = model.costs[order][hit]
        sums = np.stack(
            [np.bincount(word, cost[:, k], len(open_words)) for k in range(len(model.languages))], axis=1
        )
        done = seen > 0
        found[open_words[done]] = sums[done] / seen[done, None]
        open_words = open_words[~done]
        if not len(open_words):
            break
    row[unseen] = len(model.costs[0]) + inverse
    return row, np.concatenate([model.costs[0], found.astype(np.float32)])


def predict(model: LanguageModel, texts: list) -> dict:
    k, n = len(model.languages), len(texts)
    sums, words = np.zeros((n, k)), np.zeros(n, np.int64)
    for block in blocks(_lowered(texts)):
        starts, ends = word_runs(block)
        owner = block.owner_of(starts)
        words += np.bincount(owner, minlength=n)
        if k:
            row, costs = word_costs(model, block, starts, ends)
            for j in range(k):
                sums[:, j] += np.bincount(owner, costs[row, j], n)
    out_lang, score = [UNDETERMINED] * n, np.zeros(n)
    if k:
        mean = -sums / np.maximum(words, 1)[:, None]
        weight = np.exp(mean - mean.max(axis=1, keepdims=True))
        best = weight.argmax(axis=1)  # ties: the first language by name
        share = weight.max(axis=1) / weight.sum(axis=1)
        has_words = words > 0
        out_lang = [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has_words)]
        score = np.where(has_words, share, 0.0)
    return {"lang_pred": out_lang, "score": score}


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every whole text; a map without shuffles.

    ``score`` is the winner's share when the mean cost per word is read as a negative log likelihood.
    Null or empty texts, and texts without a letter, are ``und`` with score 0; so is everything if the model
    learned no language. Repeated rows are predicted one by one; other columns are not read.
    """
    return map_texts(docs, lambda texts: predict(model, texts), "lang_pred string, score double", text, keep)


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all documents, by a model of their training part."""
    model = fit_languages(docs)
    return identify(docs.withColumn("held_out", held_out()), model, keep=("doc_id", "held_out"))
