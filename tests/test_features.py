import math
import statistics
from datetime import timedelta

import pytest
from pyspark.sql import Window, functions as F

from barflow.operators import features as feat
from barflow.operators.chunks import over_rows, row_position
from barflow.plans import prepare
from helpers import BARS, assert_same, at, bar, frame, rows, series
from test_gapfill import sparse

S = series()


@pytest.fixture(scope="module")
def dense(spark):
    p, a = (frame(spark, r) for r in sparse(21))
    return prepare.fill_bars(p, a, S, BARS).cache()


def plain_features(df):
    w = Window.partitionBy("sym").orderBy("ts")
    df = feat.with_features(df, w, BARS)
    return feat.horizon_label(df, S, "close")


@pytest.mark.parametrize("chunk_steps", [31, 53, 100000])
def test_chunked_features_equal_plain_windows_and_self_join(spark, dense, chunk_steps):
    assert_same(prepare.all_features(dense, series(chunk_steps), BARS), plain_features(dense))


@pytest.mark.parametrize("chunk_steps", [31, 40, 100000])
def test_row_frames_with_missing_steps_do_not_depend_on_chunks(spark, chunk_steps):
    p, _ = sparse(24)
    holes = frame(spark, p).dropDuplicates(["sym", "ts"]).where("pmod(xxhash64(sym, ts), 5) < 3").cache()
    assert_same(prepare.all_features(holes, series(chunk_steps), BARS), plain_features(holes))
    std = feat.rolling_std(holes, series(chunk_steps), "close").select("sym", "ts", "Feat_Vol_Std")
    assert_same(std, plain_features(holes).select("sym", "ts", "Feat_Vol_Std"))


def test_rows_are_carried_over_chunks_without_rows(spark):
    df = frame(spark, [bar(i, float(i + 1)) for i in (0, 1, 500, 2000, 2001)])
    got = feat.lag_features(df, series(40), "close", 2).orderBy("ts").collect()
    assert [(r["Lag_1"], r["Lag_2"]) for r in got] == [
        (None, None), (1.0, None), (2.0, 1.0), (501.0, 2.0), (2001.0, 501.0)]


def test_repeated_times_are_refused_by_row_frames(spark):
    df = frame(spark, [bar(0, 5.0), bar(1, 6.0), bar(1, 7.0)])
    with pytest.raises(Exception, match="duplicate time"):
        prepare.build_features(df, S, BARS).collect()
    with pytest.raises(Exception, match="duplicate time"):
        feat.lag_features(df, S, "close").collect()


def test_one_stage_job_equals_the_two_jobs(spark):
    p, a = (frame(spark, r) for r in sparse(22))
    one = prepare.bars_to_features(p, a, S, BARS)
    two = prepare.build_features(prepare.fill_bars(p, a, S, BARS), S, BARS)
    assert one.columns == two.columns
    assert_same(one, two)


def test_one_stage_job_shuffles_only_its_sources(spark, tmp_path):
    p, a = (frame(spark, r) for r in sparse(23))
    p.write.parquet(str(tmp_path / "p")), a.write.parquet(str(tmp_path / "a"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = prepare.bars_to_features(*(spark.read.parquet(str(tmp_path / n)) for n in "pa"), S, BARS)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # per-chunk summary and one row per series; both by grid offset; order by series; the chunk rows; and each
    # source once
    assert plan.count("Exchange hashpartitioning") == 8
    assert "SinglePartition" not in plan and "Python" not in plan


def test_frames_longer_than_a_chunk_are_refused(dense):
    with pytest.raises(ValueError, match="chunk"):
        prepare.build_features(dense, series(30), BARS)


def test_trailing_values_by_hand(spark):
    closes = [3.0, 4.0, 5.0, 8.0, 2.0, 7.0, 6.0]
    df = frame(spark, [bar(i, c) for i, c in enumerate(closes)])
    out = feat.rolling_mean(df, S, "close", (5,)).orderBy("ts").collect()
    got = [r["Feat_SMA_5"] for r in out]
    assert got[0] is None
    for i in range(1, len(closes)):
        mean = statistics.mean(closes[max(0, i - 5):i])
        assert got[i] == pytest.approx((closes[i] - mean) / mean)
    std = [r["Feat_Vol_Std"] for r in feat.rolling_std(df, S, "close").orderBy("ts").collect()]
    logs = [math.log(b / a) for a, b in zip(closes, closes[1:])]
    assert std[:3] == [None] * 3
    assert std[3] == pytest.approx(statistics.stdev(logs[:2]))
    assert std[6] == pytest.approx(statistics.stdev(logs[:5]))


def test_zero_and_negative_prices_give_null_not_errors(spark):
    df = frame(spark, [bar(0, 1.0), bar(1, 0.0), bar(2, -2.0), bar(3, 0.0), bar(4, 0.0)])
    out = prepare.all_features(df, S, BARS).orderBy("ts").collect()
    assert [r["Log_Return"] for r in out] == [None] * 5
    assert [r["Feat_GK_Vol"] for r in out][1] is None
    assert feat.log_returns(df, S, "close").count() == 5


def test_garman_klass_by_hand(spark):
    df = frame(spark, [bar(0, 5.0, open=4.0, high=6.0, low=3.0)])
    got = prepare.all_features(df, S, BARS).first()["Feat_GK_Vol"]
    assert got == pytest.approx(0.5 * math.log(2) ** 2 - 0.38629 * math.log(1.25) ** 2)


def test_label_uses_the_exact_time_and_ties_are_zero(spark):
    df = frame(spark, [bar(0, 5.0), bar(14, 9.0), bar(15, 6.0), bar(29, 9.0), bar(30, 6.0)])
    out = feat.horizon_label(df, S, "close").orderBy("ts").collect()
    assert [(r["FutureClose"], r["Target"]) for r in out] == [(6.0, 1), (9.0, 0), (6.0, 0), (None, 0), (None, 0)]
    # the window form gives the same, holes or not
    label = lambda d, w: feat.with_label(d, w, "close")
    assert_same(over_rows(df, S, label, ahead=15), feat.horizon_label(df, S, "close"))


def test_label_join_fans_out_on_duplicates(spark):
    df = frame(spark, [bar(0, 5.0), bar(0, 5.5), bar(15, 6.0), bar(15, 4.0)])
    assert feat.horizon_label(df, S, "close").count() == 6


def test_short_series(spark):
    one = prepare.all_features(frame(spark, [bar(0, 5.0)]), S, BARS).first()
    assert one["Feat_SMA_5"] is None and one["Feat_Vol_Std"] is None
    two = prepare.all_features(frame(spark, [bar(0, 5.0), bar(1, 6.0)]), S, BARS).orderBy("ts").collect()
    assert two[1]["Feat_SMA_5"] == pytest.approx(0.2) and two[1]["Feat_Vol_Std"] is None


def test_dense_series_lose_three_head_and_fifteen_tail_rows(spark):
    df = frame(spark, [bar(i, 5.0 + i % 7) for i in range(100)])
    out = prepare.build_features(df, S, BARS)
    assert out.agg(F.min("ts"), F.max("ts"), F.count("*")).first() == (at(3), at(84), 82)
    stats = feat.drop_stats(prepare.all_features(df, S, BARS), ["Log_Return", "Feat_Vol_Std", "FutureClose"])
    assert tuple(stats.first()) == (100, 82, 18)


@pytest.mark.parametrize("chunk_steps", [5, 9, 100000])
def test_row_lags_with_holes_equal_plain_lags(spark, chunk_steps):
    p, _ = sparse(31)
    df = frame(spark, p).select("sym", "ts", "close").distinct()
    w = Window.partitionBy("sym").orderBy("ts")
    plain = df.withColumns({f"Lag_{i}": F.lag("close", i).over(w) for i in range(1, 6)})
    assert_same(feat.lag_features(df, series(chunk_steps), "close"), plain)
    numbers = df.withColumn("n", F.row_number().over(w).cast("long"))
    assert_same(row_position(df, series(chunk_steps), "n"), numbers)


def test_lags_equal_plain_lags_on_dense_series(spark, dense):
    w = Window.partitionBy("sym").orderBy("ts")
    plain = dense.withColumns({f"Lag_{i}": F.lag("close", i).over(w) for i in range(1, 6)})
    assert_same(feat.lag_features(dense, series(7), "close"), plain)


def test_lr_features_use_rows_of_the_cleaned_table(spark):
    df = frame(spark, [bar(i, 5.0 + (i * i) % 11, open=4.0, high=20.0, low=3.0) for i in range(80)])
    table = prepare.build_features(df, S, BARS).where("minute(ts) % 5 <> 0")  # a hole every fifth row
    raw = prepare.build_lr_features(table, S, BARS, scale=False).orderBy("ts").collect()
    closes = [r["close"] for r in table.orderBy("ts").collect()]
    assert len(raw) == len(closes) - 5
    assert [r["Lag_5"] for r in raw] == closes[:-5]
    scaled = prepare.build_lr_features(table, S, BARS)
    assert scaled.columns[:3] == ["sym", "ts", "Target"] and len(scaled.columns) == 20
    assert abs(scaled.agg(F.avg("Lag_3")).first()[0]) < 1e-9


def test_horizon_in_other_steps(spark):
    df = frame(spark, [bar(i, float(i + 1)) for i in range(30)])
    out = prepare.build_features(df, S, BARS, timedelta(minutes=4))
    assert out.agg(F.max("ts")).first()[0] == at(25)
    assert rows(out.select("Target").distinct()) == [(1,)]
