"""SimHash near-dedup: fingerprints meet at the anchor points of a covering code.

A fingerprint is cut into bands so that two fingerprints within the threshold differ by one bit at most in
some band. The anchors of a band are the words of a perfect Hamming code on its first 2**r - 1 bits with any
remaining bits beside them: each value has an anchor within one bit (its home). A band is replicated to all anchors
within two bits, covering radius plus threshold, so it is at the home of every partner.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from barflow.llm.frames import join_spread, map_texts, released
from barflow.llm.graphs import components, local_labels
from barflow.session import stage

WORDS = 3
MOST_BITS = 3
SEED = 42
CELL = 4096  # most members of an anchor that are compared in one group
PAIRS = 1 << 20  # links held before they are reduced to one per fingerprint
LANES = np.uint64(0x0101010101010101)


# --- fingerprints ---------------------------------------------------------------------------------------

def shingle_hashes(text: str | None, words: int = WORDS) -> list[int]:
    """XXH64 of each run of words, A-Z lowered and words split at ASCII white space; repeats included."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return []
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())
    return [digest(joined[a:b], SEED) for a, b in spans]


def bit_counts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many hashes of each document have each of the 64 bits; hashes lie document by document.

    Eight bits at a time are added in byte lanes, over stretches of at most 255 hashes.
    """
    counts = np.zeros((len(sizes), 64), np.int64)
    if not len(hashes):
        return counts
    stretches = -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), stretches)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    at = (np.cumsum(sizes) - sizes)[owner] + inside * 255
    bounds = np.flatnonzero(np.diff(owner, prepend=-1))
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, at)
        by_byte = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts[owner[bounds], k::8] = np.add.reduceat(by_byte, bounds, axis=0)
    return counts


def simhashes(texts: list, words: int = WORDS) -> np.ndarray:
    """The fingerprint of each text as a signed 64-bit number; a text without words has 0."""
    out, held, sizes = [], [], []

    def finish():
        n = np.array(sizes, np.int64)
        bits = bit_counts(np.array(held, np.uint64), n) * 2 > n[:, None]
        out.append(np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel())

    for text in texts:
        hashes = shingle_hashes(text, words)
        held += hashes
        sizes.append(len(hashes))
        if len(held) >= 1 << 17:
            finish()
            held, sizes = [], []
    if sizes:
        finish()
    return np.concatenate([np.zeros(0, np.uint64), *out]).astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", keep=("doc_id",), words: int = WORDS) -> DataFrame:
    return map_texts(docs, lambda texts: {"fp": simhashes(texts, words)}, "fp long", text, keep)


# --- anchors --------------------------------------------------------------------------------------------

def band_widths(most_bits: int) -> list[int]:
    """Bit widths of as many bands as leave one difference at most in some band."""
    n = most_bits // 2 + 1
    return [64 // n + (i < 64 % n) for i in range(n)]


def syndromes(values: np.ndarray, length: int) -> np.ndarray:
    """The xor of the numbers (from 1) of all set bits among the first ``length``: 0 for code words."""
    s = np.zeros(len(values), np.uint64)
    for i in range(length):
        s ^= ((values >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return s


def anchors(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, whether it is the row's home) for all anchors within two bits of each value."""
    length = (1 << (width + 1).bit_length() - 1) - 1
    one = np.uint64(1)
    s = syndromes(values, length)
    flip = np.where(s > 0, one << np.where(s > 0, s - one, 0).astype(np.uint64), np.uint64(0))
    home = values ^ flip
    rows, found, homes = [np.arange(len(values))], [home], [np.ones(len(values), bool)]
    for i in range(length, width):  # a bit beside the code differs: at most one bit is left for the code
        rows.append(np.arange(len(values)))
        found.append(home ^ (one << np.uint64(i)))
        homes.append(np.zeros(len(values), bool))
    for i in range(1, length + 1):  # two bits whose numbers give the syndrome
        j = s ^ np.uint64(i)
        two = np.flatnonzero((s > 0) & (j > i) & (j <= length))
        rows.append(two)
        found.append(values[two] ^ (one << np.uint64(i - 1)) ^ (one << (j[two] - one)))
        homes.append(np.zeros(len(two), bool))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(homes)


MEMBER = "band int, anchor long, fp long, home boolean"


def _members(widths: list[int]):
    def run(batches):
        for batch in batches:
            signed = batch.column(0).to_numpy()
            values, shift = signed.view(np.uint64), 0
            for band, width in enumerate(widths):
                part = values >> np.uint64(shift)
                part = part & np.uint64((1 << width) - 1)
                row, anchor, home = anchors(part, width)
                shift += width
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), band, np.int32)), pa.array(anchor.view(np.int64)),
                    pa.array(signed[row]), pa.array(home),
                ], ["band", "anchor", "fp", "home"])

    return run


def _linked(group: np.ndarray, fp: np.ndarray, home: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects, within each group, what links of a home with another member connect.

    Groups lie one behind the other; each member is compared with the one 1, 2, 3 ... places ahead.
    """
    left, right, held, values = [], [], 0, fp.view(np.uint64)
    n, ahead, first = len(fp), 1, np.arange(len(fp))

    def reduced():
        label = local_labels(n, np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(n))
        return [moved], [label[moved]]

    while True:
        first = first[first + ahead < n]
        first = first[group[first] == group[first + ahead]]
        if not len(first):
            break
        other = first + ahead
        close = np.bitwise_count(values[first] ^ values[other]) <= most_bits
        link = np.flatnonzero(close & (home[first] | home[other]))
        left.append(first[link])
        right.append(other[link])
        held += len(link)
        if held > PAIRS:
            left, right = reduced()
            held = len(left[0])
        ahead += 1
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = reduced()
    return fp[left[0]], fp[right[0]]


LINK = "a long, b long, hot boolean, band int, anchor long, home boolean"


def _compare(most_bits: int, cell: int, ready: bool):
    """Rows sorted by group come in, links go out: (a, b).

    A group of more than ``cell`` members is not compared here: its members go out as ``hot`` rows. With
    ``ready`` groups are bounded already.
    """
    def links(a, b):
        n, none = len(a), pa.nulls(len(a), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.array(np.zeros(n, bool)), none, none.cast(pa.int64()), none.cast(pa.bool_())],
            ["a", "b", "hot", "band", "anchor", "home"],
        )

    def hot_rows(rows):
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [rows.column("fp"), rows.column("fp"), pa.array(np.ones(n, bool)), rows.column("band"),
             rows.column("anchor"), rows.column("home")], ["a", "b", "hot", "band", "anchor", "home"],
        )

    def keys(rows):
        # the cell columns exist on the second pass only
        names = [c for c in ("band", "anchor", "row", "col") if c in rows.schema.names]
        return np.stack([rows.column(c).to_numpy().astype(np.int64) for c in names], axis=1)

    def settle(rows):
        if not rows.num_rows:
            return
        k = keys(rows)
        start = np.flatnonzero(np.append(True, (k[1:] != k[:-1]).any(axis=1)))
        size = np.diff(np.append(start, len(k)))
        group, home = np.repeat(np.arange(len(start)), size), rows.column("home").to_numpy(zero_copy_only=False)
        big = np.zeros(len(start), bool) if ready else size > cell
        if big.any():
            yield hot_rows(rows.filter(pa.array(big[group])))
        keep = (np.bincount(group, home, len(start)) > 0) & (size > 1) & ~big
        mine = np.flatnonzero(keep[group])
        a, b = _linked(group[mine], rows.column("fp").to_numpy()[mine], home[mine], most_bits)
        if len(a):
            yield links(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, passing = None, None  # rows of the last group; the key of a group known to be hot
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if waiting is None else pa.concat_batches([waiting, batch])
            k = keys(rows)
            if passing is not None:
                through = int((k == passing).all(axis=1).sum())
                if through:
                    yield hot_rows(rows.slice(0, through))
                    rows, k = rows.slice(through), k[through:]
                if not len(k):
                    waiting = None
                    continue
                passing = None
            last = len(k) - int((k == k[-1]).all(axis=1).sum())
            yield from settle(rows.slice(0, last))
            waiting = rows.slice(last)
            if not ready and waiting.num_rows > cell:
                yield hot_rows(waiting)
                passing, waiting = k[-1], None
        if waiting is not None:
            yield from settle(waiting)

    return run


def links(prints: DataFrame, most_bits: int = MOST_BITS, cell: int = CELL) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints of column ``fp`` to connect all within ``most_bits``.

    One shuffle of the replicated fingerprints (some 17 rows for each band). An anchor with more than ``cell``
    members is passed on and compared block against block, each pair of blocks a group of its own.
    """
    spark = prints.sparkSession
    members = prints.select("fp").distinct().mapInArrow(released(_members(band_widths(most_bits))), MEMBER)
    sorted_members = members.repartition("band", "anchor").sortWithinPartitions("band", "anchor")
    met = stage(sorted_members.mapInArrow(released(_compare(most_bits, cell, False)), LINK), "links")
    edges = met.where(~F.col("hot")).select("a", "b")
    hot = met.where("hot").select("band", "anchor", F.col("a").alias("fp"), "home")
    sizes = hot.groupBy("band", "anchor").count().withColumn(
        "blocks", F.ceil(F.col("count") * 2 / cell).cast("long")
    )
    dealt = hot.join(sizes, ["band", "anchor"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    # block i meets block j >= i in cell (i, j)
    other = F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other")
    cells = dealt.select("band", "anchor", "fp", "home", "block", other).select(
        "band", "anchor", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"), "fp", "home"
    )
    spread = cells.repartition("band", "anchor", "row", "col").sortWithinPartitions("band", "anchor", "row", "col")
    more = spread.mapInArrow(released(_compare(most_bits, cell, True)), LINK).select("a", "b")
    return edges.unionByName(more) if hot.limit(1).count() else edges


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest id reachable over links) per row.

    Two rows are linked if their fingerprints differ in ``most_bits`` bits or fewer. Null and empty texts have
    fingerprint zero and are linked like others. Rows without an id get the smallest id of their component,
    null if it has none; repeated rows come back as often as they went in.
    """
    rows = stage(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), words=words), "fp")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "classes")
    found = components(links(rows, most_bits))
    named = stage(classes.join(found, F.col("fp") == F.col("node")).select("fp", "first", "root"), "components")
    least = named.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("least"), F.count("*").alias("nodes"))
    linked = join_spread(named, stage(least, "least"), "root", "_root", "nodes").select(F.col("fp").alias("_fp"), "least")
    groups = classes.join(linked, F.col("fp") == F.col("_fp"), "left").select(
        F.col("fp").alias("_class"), F.coalesce("least", "first").alias("component_id"), "copies"
    )
    joined = join_spread(rows, stage(groups, "classes"), "fp", "_class", "copies")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents whose group has a smaller id; rows without an id stay.

    Of rows that share an id and a text one stays; those that share an id alone are judged text by text.
    """
    rows = stage(near_duplicates(docs, text, doc_id, **options), "groups")
    named = rows.where(F.col("doc_id").isNotNull())
    gone = stage(named.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
    repeated = stage(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    same = lambda other: docs[doc_id] == other["doc_id"]
    if not repeated.limit(1).count():
        return docs.join(gone, same(gone), "left_anti")
    once = docs.join(repeated, same(repeated), "left_anti").join(gone, same(gone), "left_anti")
    # an id with several texts goes or stays text by text, so these rows need their fingerprints
    several = docs.join(repeated, same(repeated), "left_semi")
    inner = several.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    key, body = (f"c{docs.columns.index(c)}" for c in (doc_id, text))
    marked = fingerprints(inner, body, inner.columns, **({"words": options["words"]} if "words" in options else {}))
    first = named.where(F.col("doc_id") == F.col("component_id")).select("doc_id", "fingerprint").distinct()
    kept = marked.withColumn("_hex", F.lower(F.lpad(F.hex("fp"), 16, "0"))).join(
        first, (F.col(key) == F.col("doc_id")) & (F.col("_hex") == F.col("fingerprint")), "left_semi"
    ).dropDuplicates([key, body])
    return once.unionByName(kept.select(*(F.col(c).alias(n) for c, n in zip(inner.columns, docs.columns))))
