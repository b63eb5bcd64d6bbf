"""Shards, hard negatives and importance resampling against brute force, and odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.llm import negatives, resampling, sharding
from barflow.llm.frames import importable


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def shuffled(rows, seed=1):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return rows


# --- shards

DOCS = "doc_id long, text string, size string, shard int, tie int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", 7, 0) for i, t in rows], DOCS)


def expected_shards(rows, shards):
    """{doc_id: (size, crc, shard, slot)} for rows with ids of their own."""
    ordered = sorted(rows)
    sizes = [len((t or "").encode()) + 1 for _, t in ordered]
    total, start, slots, out = sum(sizes), 0, {}, {}
    for (i, text), size in zip(ordered, sizes):
        shard = (2 * start + size) * shards // (2 * total)
        out[i] = (size, zlib.crc32((text or "").encode()), shard, slots.get(shard, 0))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return out


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_against_loops(spark, shards):
    draw = random.Random(shards)
    rows = [(i * 3 - 50, draw.choice([None, "", "x", "é" * draw.randrange(90), "word " * draw.randrange(400)])) for i in range(300)]
    rows.append((1000, "long " * 20_000))
    got = sharding.balanced_shards(docs(spark, shuffled(rows)), shards).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected_shards(rows, shards) and len(got) == len(rows)


def test_shard_sizes_miss_their_target_by_one_row_at_most(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.shard_documents(table)
    sums = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    largest, total = got.agg(F.max("size"), F.sum("size")).first()
    assert all(abs(b - total / 16) <= largest for b in sums) and got.count() == table.count()


def test_shards_of_repeated_rows_and_missing_ids(spark):
    same = [(5, "copy of a text")] * 200
    rows = shuffled(same + [(None, "a"), (None, None), (9, "z" * 10), (5, "another")])
    got = sharding.balanced_shards(docs(spark, rows), 4).collect()
    assert len(got) == len(rows) and {r.shard for r in got} == {0, 1, 2, 3}  # the copies fill several shards
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
        assert abs(sum(r.size for r in got if r.shard == shard) - sum(r.size for r in got) / 4) <= 15
    assert [r.slot for r in sorted(got, key=lambda r: (r.shard, r.slot))[:2]] == [0, 1]
    assert sorted(r.size for r in got if r.doc_id is None and r.shard == 0 and r.slot < 2) == [1, 2]


def test_shards_of_no_rows_and_of_one_large_one(spark):
    assert sharding.balanced_shards(docs(spark, [])).count() == 0
    got = sharding.balanced_shards(docs(spark, [(1, "a"), (2, "b" * 1000), (3, "c")]), 4).collect()
    assert [(r.doc_id, r.shard) for r in sorted(got)] == [(1, 0), (2, 2), (3, 3)]


def test_shard_columns_that_clash_are_kept(spark):
    got = sharding.balanced_shards(docs(spark, [(1, "a")]), 2, keep=["doc_id", "size", "shard", "tie"]).first().asDict()
    assert got == {"doc_id": 1, "size_given": "s", "shard_given": 7, "tie": 0, "size": 2, "text_crc32": zlib.crc32(b"a"),
                   "shard": 1, "slot": 0}


def test_written_shards_hold_the_rows_in_order(spark, tmp_path):
    rows = [(i, "t" * (i % 17)) for i in range(200)]
    sharding.write_shards(docs(spark, shuffled(rows)), str(tmp_path / "shards"), 4)
    wanted = expected_shards(rows, 4)
    for shard in range(4):
        read, files = [], sorted((tmp_path / "shards" / f"shard={shard}").glob("*.parquet"))
        for f in files:
            read += spark.read.parquet(str(f)).select("doc_id", "text").collect()
        assert [tuple(r) for r in read] == [(i, t) for i, t in rows if wanted[i][2] == shard]


def test_shards_need_no_python(spark, sf_dir):
    plan = sharding.shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


# --- importance resampling

def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


def plain_features(text):
    w = plain_words(text)
    return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def plain_resample(rows, target):
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f in plain_features(text):
                counts[f] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1.0) * (big_s + 10000) / ((a + 1.0) * (big_t + 10000)))) for a, b in zip(s, t)]
    out, eligible = {}, []
    for i, text in rows:
        found = plain_features(text)
        weight = sum(gain[f] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(found), weight, score, None]
        if len(plain_words(text)) >= 20:
            eligible.append((-score, i))
    for rank, (_, i) in enumerate(sorted(eligible)[: 25 * len(eligible) // 100], 1):
        out[i][3] = rank
    return out


def some_texts(seed, n):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "café", "naïve", "İstanbul", "ſ", "日本語", "x1", "A", "word", "w" * 60, "é" * 70, "ÀÉ", "K"]
    gaps = [" ", "  ", ", ", "\n", "\x00", "-", "\t", "_", "'"]
    return ["".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(draw.randrange(60))) for _ in range(n)]


def resampled(spark, rows, target):
    frame = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, rank int, weight string")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    return resampling.resample_documents(frame, wanted).collect()


def test_resampling_against_loops(spark):
    rows = list(enumerate([*some_texts(1, 200), None, "", " \n ", "one", "same words " * 30, "same words " * 30]))
    target = [*some_texts(2, 20), None]
    got = resampled(spark, shuffled(rows), target)
    assert {r.doc_id: list(r)[1:] for r in got} == plain_resample(rows, target)
    assert resampled(spark, [], target) == [] and len(resampled(spark, rows, [])) == len(rows)


def test_resampling_with_repeated_and_missing_ids(spark):
    text = "w " * 40
    got = resampled(spark, [(3, text)] * 6 + [(None, text), (4, "short")], ["w w w"])
    assert sorted(r.rank for r in got if r.rank) == [1] and len(got) == 8  # 25 % of 7, rounded down
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_words_in_pieces_are_those_of_whole_texts(monkeypatch):
    texts = some_texts(3, 40) + ["a" * 500 + " b", " " * 300 + "x", "日" * 333 + "!" + "y" * 200]
    whole = [resampling.offsets(t).tolist() for t in texts]
    monkeypatch.setattr(resampling, "PIECE", 16)
    _, sizes, buckets = resampling.window_buckets(texts, 2, 10000)
    for text, got in zip(texts, np.split(buckets, np.cumsum(sizes)[:-1])):
        assert sorted(got.tolist()) == sorted(plain_features(text))


def test_small_groups_give_the_same(spark, monkeypatch):
    rows = list(enumerate(some_texts(5, 50)))
    monkeypatch.setattr(resampling, "GROUP", 64)
    first = list(resampling._groups(np.array([0, 70, 0, 3, 200, 0, 1])))
    assert first == [(0, 2), (2, 3), (5, 2)]
    assert {r.doc_id: list(r)[1:] for r in resampled(spark, rows, ["the word"])} == plain_resample(rows, ["the word"])


def test_longer_windows(spark):
    text = "a bb ccc dddd"
    got = resampling.window_buckets([text, "z", "", text], 3, 997)[2].tolist()
    w = text.split()
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    want = [zlib.crc32(r.encode()) % 997 for r in runs]
    assert got == [*want, zlib.crc32(b"z") % 997, *want]


def test_kept_columns_that_clash(spark):
    frame = spark.createDataFrame([(1, "a b", 9)], "doc_id long, text string, rank int")
    row = resampling.resample(frame, frame.select("text"), keep=["text", "rank"]).first().asDict()
    assert row["rank_given"] == 9 and row["rank"] is None and row["text"] == "a b" and row["n_words"] == 2


# --- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, id int, row string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, "r") for i, v, y in rows], VECTORS)


def plain_negatives(rows):
    given = []
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        given.append((i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, y, v in given:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in given if j != i]
        for s, p, _ in sorted(x for x in scored if x[2] == y)[:5]:
            fit = sorted(x for x in scored if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(i, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in negatives.mine_negatives(vectors(spark, rows)).collect())


def clustered(seed, n, dimensions, spread, longest=1.0):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(5, dimensions))
    rows = []
    for i in range(n):
        v = centers[i % 5] + spread * draw.normal(size=dimensions)
        v *= draw.uniform(0.2, longest) / np.linalg.norm(v)
        rows.append((i * 4, [float(np.float32(x)) for x in v], int(draw.integers(0, 3))))
    return rows


@pytest.mark.parametrize("dimensions,spread", [(2, 0.3), (8, 0.2), (24, 1.0)])
def test_negatives_against_loops(spark, monkeypatch, dimensions, spread):
    rows = clustered(dimensions, 260, dimensions, spread, 3.0)
    assert mined(spark, shuffled(rows)) == plain_negatives(rows)


def test_blocks_of_anchors_give_the_same(spark):
    rows = clustered(5, 400, 6, 0.4)
    frame = vectors(spark, shuffled(rows)).withColumn("label", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)"))
    for block in (1, 3, 1000):
        got = negatives.hard_negatives(frame, F.col("id") % 100 == 0, block=block).collect()
        assert sorted(tuple(r) for r in got) == plain_negatives(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.5, 0.5], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2),
            (6, [None, 1.0], 2), (8, [0.5, 0.5], 2), (9, [0.6], 2), (10, [0.5, 0.2, 9.0], 2), (11, [], 2), (12, [0.0, 0.0], 1),
            (13, [-1.0, 0.0], 1), (15, [1.0, 1.0], None), (100, [0.0, 0.0], 3), (200, [0.3, 0.3], 3)]
    got = mined(spark, shuffled(rows))
    assert got == plain_negatives(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(None, [1.0], 1), (100, [1.0], 1)]) == []


def test_ties_and_copies(spark):
    rows = [(100, [1.0, 0.0], 1), (101, [1.0, 0.0], 1)] + [(200 + i, [0.5, 0.1], 2) for i in range(1, 60)]
    got = mined(spark, shuffled(rows))
    assert got == plain_negatives(rows) and [r[3] for r in got] == sorted(r[3] for r in got)
    twice = mined(spark, [(100, [1.0], 1), (101, [1.0], 1), (103, [0.5], 2), (103, [0.5], 2)])
    assert twice == [(100, 101, 1, 103, 256 * 256, 256 * 128), (100, 101, 2, 103, 256 * 256, 256 * 128)]


def test_huge_components_are_exact(spark):
    rows = [(100, [2.0**20, 3.0], 1), (101, [2.0**20, 1.0], 1), (103, [2.0**19, 1.0], 2), (104, [2.0**19, 2.0], 2)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_pruning_leaves_few_candidates_and_loses_none():
    draw = np.random.default_rng(2)
    rows = draw.normal(size=(3000, 4))
    rows = np.round(rows / np.linalg.norm(rows, axis=1)[:, None] * 100)
    bucket, pruned = negatives.Bucket(rows), 0
    for anchor in np.round(draw.normal(size=(40, 4)) * 100):
        exact = rows @ anchor
        for least in (np.sort(exact)[-3], np.sort(exact)[-300], -5.0):
            near = bucket.candidates(anchor, least)
            if near is not None:
                pruned += 1
                assert set(np.flatnonzero(exact >= least)) <= set(near.tolist()) and len(near) < 1500
    assert pruned >= 40
    assert len(bucket.candidates(np.ones(4), 1e9)) == 0
