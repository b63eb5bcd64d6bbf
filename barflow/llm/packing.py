"""Lexical retrieval packing: windows are filled with the BM25 neighbours of a seed document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barflow.llm.frames import TEXT, fields, released
from barflow.llm.tokens import worker_encoder

WINDOW = 4096
END = 2  # id behind every document
SHARD_TOKENS = 1 << 20  # tokens of the documents of one inverted index
DENSE = 8  # terms in more than one document in DENSE have a row of weights instead of postings
NEIGHBOURS = 64  # taken first; the other documents with a score are sorted only if room is left
K1, B = 1.2, 0.75


class Bm25Shard:
    """An inverted index over token ids: for each term the documents with it and their BM25 weight.

    A document's query is all its terms, or its ``query_terms`` heaviest. Frequent terms have a weight for every
    document, at most DENSE times the room of their postings.
    """

    def __init__(self, docs: list[np.ndarray], query_terms: int | None = None):
        self.n = n = len(docs)
        sizes = np.fromiter(map(len, docs), np.int64, n)
        key = np.sort(np.concatenate([np.zeros(0, np.int64), *docs]).astype(np.int64) * n + np.repeat(np.arange(n), sizes))
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        tf, key = np.diff(np.append(new, len(key))), key[new]
        term, self.doc = key // max(n, 1), key % max(n, 1)
        terms, self.begin = np.unique(term, return_index=True)
        self.end = np.append(self.begin[1:], len(term))
        df = self.end - self.begin
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / max(sizes.mean(), 1)) if n else sizes
        self.weight = (np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        row = np.repeat(np.arange(len(terms)), df)
        by_doc = np.argsort(self.doc, kind="stable") if query_terms is None else np.lexsort((-self.weight, self.doc))
        first = np.searchsorted(self.doc[by_doc], np.arange(n + 1))
        self.queries = [row[by_doc[a:b][:query_terms]] for a, b in zip(first[:-1], first[1:])]
        frequent = df * DENSE > n
        self.place = np.where(frequent, np.cumsum(frequent) - 1, -1)  # row of a frequent term, -1 for others
        self.dense = np.zeros((int(frequent.sum()), n), np.float32)
        postings = np.flatnonzero(frequent[row])
        self.dense[self.place[row[postings]], self.doc[postings]] = self.weight[postings]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the seed's query."""
        place = self.place[self.queries[seed]]
        q = self.queries[seed][place < 0]
        sizes = self.end[q] - self.begin[q]
        at = np.repeat(self.begin[q] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.bincount(self.doc[at], self.weight[at], self.n) + self.dense[place[place >= 0]].sum(axis=0)


class Packer:
    """Fills windows from one shard after another; what does not fill a window waits for the next shard."""

    def __init__(self, sequence_id: int, window: int = WINDOW, query_terms: int | None = None):
        self.window, self.next_id, self.query_terms = window, sequence_id, query_terms
        self.items: list[list] = []  # [row key, ids of the document, next id to place]
        self.rows: list[tuple] = []

    def place(self, pieces: list[tuple[list, int]]) -> None:
        """One sequence of (item, how many of its ids)."""
        offset = 0
        for item, n in pieces:
            key, ids, start = item
            part = ids[start : start + n]
            self.rows.append((key, start, n, zlib.crc32(part.tobytes()), len(ids), self.next_id, offset))
            item[2] += n
            offset += n
        self.next_id += 1

    def add(self, docs: list[tuple]) -> None:
        """Cut whole windows off long documents, then fill windows around seeds while the rest suffices."""
        for key, ids in docs:
            item = [key, ids, 0]
            while len(ids) - item[2] >= self.window:
                self.place([(item, self.window)])
            if item[2] < len(ids):
                self.items.append(item)
        rest = np.array([len(ids) - start for _, ids, start in self.items], np.int64)
        left = int(rest.sum())
        if left < self.window:
            return
        shard = Bm25Shard([ids[start:] for _, ids, start in self.items], self.query_terms)
        seeds = np.argsort(-rest, kind="stable")
        upto = 0
        while left >= self.window:
            while not rest[seeds[upto]]:
                upto += 1
            seed = int(seeds[upto])
            # only unused neighbours count; those without a common term come last, in the order of the seeds
            scores = np.where(rest > 0, shard.scores(seed), -1.0)
            scores[seed] = np.inf
            room, pieces = self.window, []
            best = np.argpartition(-scores, min(NEIGHBOURS, len(scores) - 1))[:NEIGHBOURS]
            best = best[np.lexsort((best, -scores[best]))]
            for i in self._candidates(best[scores[best] > 0], scores, seeds, upto):
                n = int(min(rest[i], room))
                if n:
                    pieces.append((i, n))
                    rest[i] -= n
                    room -= n
                    if not room:
                        break
            self.place([(self.items[i], n) for i, n in pieces])
            left -= self.window
        self.items = [item for item, n in zip(self.items, rest) if n]

    @staticmethod
    def _candidates(best, scores, seeds, upto) -> Iterator[int]:
        yield from best.tolist()
        if len(best) == NEIGHBOURS:  # those placed by now come again with nothing left
            others = np.flatnonzero(scores > 0)
            yield from others[np.argsort(-scores[others], kind="stable")].tolist()
        yield from seeds[upto:].tolist()

    def finish(self) -> None:
        """The last ids of a task fill sequences of falling powers of two, which need no padding."""
        left = sum(len(ids) - start for _, ids, start in self.items)
        at = 0
        for size in (1 << k for k in reversed(range(left.bit_length())) if left >> k & 1):
            pieces = []
            while size:
                item = self.items[at]
                rest = len(item[1]) - item[2]
                n = min(rest, size)
                pieces.append((item, n))
                size -= n
                at += n == rest
            self.place(pieces)
        self.items = []


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
    end: int = END, shard_tokens: int = SHARD_TOKENS, query_terms: int | None = None,
) -> DataFrame:
    """One row per piece: which ids of a document lie where in which sequence.

    A document is its token ids and ``end``; null and empty texts are ``end`` alone. Each task tokenizes its
    documents and packs them shard by shard, without a shuffle and with one shard in memory; a document of any
    length costs its own ids. All sequences but the last of a task are full; those are powers of two. Rows with
    equal ids are packed each for itself; neighbours of equal score are taken in the order of the table; an empty
    table gives no piece. A seed's query is all its terms, or its ``query_terms`` heaviest. ``tokenizer`` is the path of the tokenizer file on every machine.
    """
    spec = fields(PIECE)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(TEXT))
    schema = StructType([rows.schema["doc_id"]] + spec.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 32, window, query_terms)
        held, total, last = [], 0, np.array([end], "<u4")

        def made():
            columns = list(zip(*packer.rows)) or [[]] * len(arrow)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([encoder.encode(body), last])
                held.append((key, ids))
                total += len(ids)
                if total >= shard_tokens:
                    packer.add(held)
                    held, total = [], 0
                    yield made()
        packer.add(held)
        packer.finish()
        yield made()

    return rows.mapInArrow(released(run), schema)
