"""Benchmark decontamination: phrases of a benchmark are searched in an FM-index of every training shard."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barflow.llm.fmindex import FMIndex
from barflow.llm.frames import TEXT, fields, released
from barflow.session import stage

WINDOW = 10  # words of a phrase
SHARD_WORDS = 1 << 18  # words of one index; a longer document has an index of its own
BLOCK_CHARS = 8 << 20  # characters of the benchmark that are searched for at once
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # fixed by the contract, on lower-cased A-Z
# The same on UTF-8 bytes: A-Z become small, everything that is no word byte a space.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
DOCUMENT_END = 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(TABLE).split()


def windows_of(words: list) -> list[tuple]:
    """All runs of WINDOW words; the whole item if it is shorter; none if it has no word."""
    if not words:
        return []
    return [tuple(words[i : i + WINDOW]) for i in range(max(1, len(words) - WINDOW + 1))]


class Phrases:
    """Distinct windows of some benchmark items and the items each belongs to."""

    def __init__(self, items: list[tuple]):
        owners = defaultdict(set)
        for item_id, text in items:
            for window in windows_of(words_of(text)):
                owners[window].update([] if item_id is None else [str(item_id)])
        self.by_length: dict[int, list[tuple]] = defaultdict(list)
        for window in owners:
            self.by_length[len(window)].append(window)
        self.items = {n: [sorted(owners[w]) for w in ws] for n, ws in self.by_length.items()}


def find(phrases: Phrases, docs: list[list[bytes]]) -> list[tuple[np.ndarray, set]]:
    """(hit mask over the words, ids of the items found) of each document of one shard."""
    number = defaultdict(count(2).__next__)
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.full(int((sizes + 1).sum()), DOCUMENT_END, np.int64)
    for start, words in zip(starts, docs):
        text[start : start + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    edges, items = np.zeros(len(text) + 1, np.int64), [set() for _ in docs]
    index = FMIndex(text) if phrases.by_length else None
    for length, windows in phrases.by_length.items():
        rows = [[number.get(w, -1) for w in window] for window in windows]
        lines = np.array(rows, np.int64)
        possible = np.flatnonzero((lines >= 0).all(axis=1))
        low, high = index.search(lines[possible])
        hits = high - low
        if not hits.any():
            continue
        which = np.repeat(possible, hits)
        at = index.locate(np.repeat(low, hits) + np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits))
        edges += np.bincount(at, minlength=len(edges)) - np.bincount(at + length, minlength=len(edges))
        owner = np.searchsorted(starts, at, "right") - 1
        for d, w in np.unique(np.stack([owner, which]), axis=1).T.tolist():
            items[d].update(phrases.items[length][w])
    hit = np.cumsum(edges[:-1]) > 0
    return [(hit[s : s + n], found) for s, n, found in zip(starts, sizes, items)]


def removal_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Merged character spans from the first to the last word of each run of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    places = [m.span() for m in WORD.finditer(lowered)]
    return [(places[a][0], places[b - 1][1]) for a, b in zip(edges[0::2], edges[1::2])]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list]]:
    """Whole documents up to SHARD_WORDS words at a time, with the words of each."""
    waiting, words, total = [], [], 0
    for batch in batches:
        texts, first, at = batch.column(TEXT).to_pylist(), 0, 0
        for at, text in enumerate(texts, 1):
            words.append(words_of(text))
            total += len(words[-1])
            if total >= SHARD_WORDS:
                yield pa.Table.from_batches([*waiting, batch.slice(first, at - first)]), words
                waiting, words, total, first = [], [], 0, at
        if first < at:
            waiting.append(batch.slice(first))
    if words:
        yield pa.Table.from_batches(waiting), words


FOUND = "n_words long, n_hit long, spans array<struct<start:int,end:int>>, items array<string>"


def _search_block(rows: DataFrame, kept: list[str], phrases: Phrases, earlier: bool) -> DataFrame:
    """Add what one block of phrases hits to what earlier blocks have hit."""
    spec = fields(FOUND)
    schema = StructType([rows.schema[c] for c in [*kept, TEXT]] + spec.fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for table, words in _shards(batches):
            texts = table.column(TEXT).to_pylist()
            before = table.column("spans").to_pylist() if earlier else [[]] * len(texts)
            known = table.column("items").to_pylist() if earlier else [[]] * len(texts)
            made = {f.name: [] for f in spec.fields}
            for text, own, (hit, items), spans, ids in zip(texts, words, find(phrases, words), before, known):
                if spans:
                    places = np.array([m.start() for m in WORD.finditer(text.translate({c: c + 32 for c in range(65, 91)}))])
                    for s in spans:
                        hit[(places >= s["start"]) & (places < s["end"])] = True
                made["n_words"].append(len(own))
                made["n_hit"].append(int(hit.sum()))
                made["spans"].append([{"start": a, "end": b} for a, b in removal_spans(text, hit)] if hit.any() else [])
                made["items"].append(sorted(items | set(ids)))
            columns = [*table.select([*kept, TEXT]).combine_chunks().itercolumns()]
            columns += [pa.array(made[f.name], arrow.field(f.name).type) for f in spec.fields]
            yield from pa.Table.from_arrays(columns, schema=arrow).to_batches()

    return rows.mapInArrow(released(run), schema)


def item_blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[list[tuple]]:
    """The benchmark in blocks of about ``size`` characters, of which the driver holds one at a time."""
    block, total = [], 0
    for row in benchmark.select(item_id, text).toLocalIterator():
        block.append(tuple(row))
        total += len(row[1] or "")
        if total >= size:
            yield block
            block, total = [], 0
    if block:
        yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep=("doc_id",),
    item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``keep`` columns, the text as ``_text_in``, and per document n_words, n_hit, spans, items.

    ``spans`` are the merged character ranges to remove, ``items`` the sorted ids (as text) of the benchmark
    items of which a window occurs. Each task indexes its documents shard by shard; the phrases are a stated
    query set, searched block by block in one pass over the table per block, without a shuffle. Before a further
    block is read the result so far is staged, so that driver and plan hold the phrases of one block, whatever the
    size of the benchmark. Null and empty texts have no word; very long ones are an index of their own; repeated
    documents are all marked; an empty table gives an empty one; without items nothing is hit. Items without an id
    hit words but are not listed; those without words hit nothing; of repeated items one is listed.
    """
    keep = list(keep)
    if clash := set(keep) & {"n_words", "n_hit", "spans", "items"}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    rows, earlier = docs.select(*keep, F.col(text).alias(TEXT)), False
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        if earlier:
            rows = stage(rows, "searched")
        rows, earlier = _search_block(rows, keep, Phrases(block), earlier), True
    return rows if earlier else _search_block(rows, keep, Phrases([]), False)


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    ids = F.array_join("items", ",")
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def without_spans(text, spans):
    """SQL text of a column without the given character ranges; a line feed stands for each."""
    return F.expr(
        f"CASE WHEN size({spans}) = 0 THEN {text} ELSE concat_ws('\\n', transform(sequence(0, size({spans})), i -> "
        f"substring({text}, IF(i = 0, 0, {spans}[greatest(i - 1, 0)].`end`) + 1, "
        f"IF(i = size({spans}), length({text}), {spans}[least(i, size({spans}) - 1)].`start`) "
        f"- IF(i = 0, 0, {spans}[greatest(i - 1, 0)].`end`)))) END"
    )
