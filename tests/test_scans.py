"""What passes between chunks: two-level scans and carried rows against plain windows, and their bounds."""

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import Window, functions as F

from barflow.functions.timeline import floor_div, micros
from barflow.operators import chunks, features as feat, gapfill as gap
from barflow.operators.scan import before_each
from barflow.plans import prepare
from barflow.series import Series
from helpers import BARS, assert_same, at, bar, frame


def series(chunk_steps, group_chunks=None):
    return Series("ts", ("sym",), timedelta(minutes=1), chunk_steps, group_chunks)


def sparse(seed, n=220, syms="ab"):
    """Bars of several series with single steps, long holes and dense stretches."""
    draw, rows = random.Random(seed), []
    for sym in syms:
        minute = draw.randrange(50)
        for _ in range(n):
            rows.append(bar(minute, 1.0 + draw.randrange(9), sym=sym))
            minute += draw.choice([1, 1, 1, 1, 1, 2, 7, 90, 700])
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("group", [1, 3, 10, 1000])
def test_scan_is_a_plain_prefix(spark, group):
    draw = random.Random(group)
    rows = [(k, i, draw.randrange(9), draw.choice([None, draw.random()])) for k in "xy" for i in range(-60, 200) if draw.random() < 0.4]
    df = spark.createDataFrame(rows, "k string, p long, n long, v double")
    earlier = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumns({"s": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "l": F.last("v", ignorenulls=True).over(earlier)})
    assert_same(before_each(df, ["k"], "p", group, {"s": "n"}, {"l": "v"}), plain)


def test_scan_over_the_whole_table(spark):
    df = spark.range(100).select(F.col("id").alias("p"), F.lit(2).cast("long").alias("n"))
    assert before_each(df, [], "p", 7, {"s": "n"}).where("s <> 2 * p").count() == 0


@pytest.mark.parametrize("chunk_steps,group", [(31, 1), (31, 4), (64, None), (5000, 2)])
def test_row_frames_are_plain_windows(spark, chunk_steps, group):
    df = frame(spark, sparse(chunk_steps))
    w = Window.partitionBy("sym").orderBy("ts")
    plain = df.withColumns({f"Lag_{i}": F.lag("close", i).over(w) for i in range(1, 6)})
    assert_same(feat.lag_features(df, series(chunk_steps, group), "close"), plain)
    wide = prepare.all_features(df, series(chunk_steps, group), BARS, timedelta(minutes=15))
    assert_same(wide, prepare.all_features(df, series(1 << 32), BARS, timedelta(minutes=15)))


def carried(df, s, back):
    wide = chunks.spread(df, micros(df, s.ts), s.step_us, s.chunk_steps).repartition(4, *s.keys, chunks.CHUNK)
    return wide, chunks._carried(wide, s, back)


@pytest.mark.parametrize("group", [1, 2, 7])
def test_a_chunk_gets_the_last_rows_before_it(spark, group):
    s, back = series(40, group), 12
    wide, copies = carried(frame(spark, sparse(5)), s, back)
    own = [(r.sym, r._chunk, r._at) for r in wide.collect()]
    expected = []
    for sym, chunk in {(a, c) for a, c, _ in own}:
        before = sorted(t for a, c, t in own if a == sym and c < chunk)
        expected += [(sym, chunk, t) for t in before[-back:]]
    assert sorted((r.sym, r._chunk, r._at) for r in copies.collect()) == sorted(expected)


def test_no_ordered_group_exceeds_the_square_root(spark):
    n, back = 400, 3
    df = frame(spark, [bar(i, 1.0, sym="a") for i in range(4 * n)])
    s = series(4, math.isqrt(n))
    wide, copies = carried(df, s, back)
    assert copies.groupBy("sym", chunks.CHUNK).count().agg(F.max("count")).first()[0] == back
    # tails: at most `back` rows a chunk in each group of chunks, and 2 * `back` rows a group over the groups
    tails = wide.groupBy("sym", chunks.CHUNK).count().withColumn("g", floor_div(F.col(chunks.CHUNK), s.chunk_group))
    assert tails.groupBy("g").count().agg(F.max("count")).first()[0] <= math.isqrt(n)
    assert tails.select("g").distinct().count() <= math.isqrt(n) + 1
    # forward fill and row numbers over the same chunks
    holes = df.withColumn("close", F.when(F.minute("ts") % 7 == 0, F.col("close")))
    w = Window.partitionBy("sym").orderBy("ts")
    plain = holes.withColumn("close", F.last("close", ignorenulls=True).over(w))
    assert_same(gap.forward_fill(holes, ["close"], s), plain)
    assert chunks.row_position(df, s, "n").where(F.col("n") != F.unix_timestamp("ts") / 60 - F.unix_timestamp(F.lit(at(0))) / 60 + 1).count() == 0


@pytest.mark.parametrize("chunk_steps,group", [(40, 1), (40, 3), (64, 1000)])
def test_fill_in_groups_of_chunks(spark, chunk_steps, group):
    rows = [r for r in sparse(9, 80) if r[1] is not None]
    primary, aux = frame(spark, rows[::2]), frame(spark, rows[1::2])
    primary = primary.withColumn("close", F.when(F.minute("ts") % 3 > 0, F.col("close")))
    for job in (prepare.fill_bars, lambda *a: prepare.bars_to_features(*a, timedelta(minutes=15))):
        assert_same(job(primary, aux, series(chunk_steps, group), BARS), job(primary, aux, series(5000), BARS))


def test_features_read_their_input_once(spark, tmp_path):
    frame(spark, sparse(2)).write.parquet(str(tmp_path / "bars"))
    done = prepare.build_features(spark.read.parquet(str(tmp_path / "bars")), series(64), BARS)
    done.collect()
    text = done._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("Initial Plan")]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 2
    # the rows, their last ones by group of chunks and by series, and the copies
    assert final.count("+- Exchange hashpartitioning") == 4
