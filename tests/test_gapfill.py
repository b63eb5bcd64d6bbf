import random

import pytest
from pyspark.sql import Window, functions as F

from barflow.operators import gapfill as gap
from barflow.plans.prepare import fill_bars
from helpers import BARS, assert_same, at, bar, frame, rows, series

S = series()


def plain_fill(primary, aux, s):
    """The same job from one grid, two joins and unchunked windows."""
    merged = gap.fill_from(gap.align_to_grid(primary, gap.time_grid(primary, s), s), aux, s, BARS.all)
    w = Window.partitionBy(*s.keys).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return gap.zero_fill(merged.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in BARS.prices}), BARS.volumes)


def sparse(seed, n=400, syms=("a", "b", "hot")):
    """Bars with gaps, null fields, off-grid times and rows outside the range of the primary source."""
    rnd = random.Random(seed)
    maybe = lambda v: None if rnd.random() < 0.3 else v
    def some(keep, minutes, odd):
        out = []
        for sym in syms:
            for m in minutes:
                if rnd.random() < keep * (3 if sym == "hot" else 1):
                    p = rnd.uniform(1, 9)
                    minute = m + (0.5 if odd and rnd.random() < 0.1 else 0)
                    out.append(bar(minute, p, rnd.uniform(1, 5), sym, open=maybe(p), close=maybe(p + 1), low=maybe(p)))
        return out
    return some(0.05, range(-200, n - 200), True), some(0.08, range(-300, n), False)


@pytest.mark.parametrize("chunk_steps", [1, 7, 40, 100000])
def test_fused_fill_equals_plain_fill(spark, chunk_steps):
    p, a = (frame(spark, r) for r in sparse(chunk_steps))
    s = series(chunk_steps)
    assert_same(fill_bars(p, a, s, BARS), plain_fill(p, a, s))


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("co_partition", ["true", "false"])
def test_fill_does_not_depend_on_join_settings(spark, threshold, co_partition):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition"]
    old = [spark.conf.get(n) for n in names]
    p, a = (frame(spark, r) for r in sparse(3))
    expected = plain_fill(p, a, S).collect()
    try:
        for name, value in zip(names, [threshold, co_partition]):
            spark.conf.set(name, value)
        assert_same(fill_bars(p, a, S, BARS), spark.createDataFrame(expected, plain_fill(p, a, S).schema))
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)


def test_margins_repeat_the_rows_of_the_neighbouring_chunks(spark):
    p, a = (frame(spark, r) for r in sparse(5))
    s = series(40)
    wide = gap.dense_chunks(p, a, s, BARS, back=31, ahead=15)
    assert_same(gap.own_rows(wide, s, True).drop(gap.MISSING, gap.FROM_AUX), fill_bars(p, a, s, BARS))
    # every copy has the values of the row it copies
    copies = wide.drop("_chunk").distinct().count()
    assert copies == fill_bars(p, a, s, BARS).count() < wide.count()


@pytest.mark.parametrize("chunk_steps", [1, 7, 100000])
def test_forward_fill_equals_plain_window(spark, chunk_steps):
    p, _ = sparse(11)
    df = frame(spark, p).select("sym", "ts", "open", "close", "volume")
    w = Window.partitionBy("sym").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("open", "close")})
    assert_same(gap.forward_fill(df, ["open", "close"], series(chunk_steps)), plain)


def test_time_grid_is_dense_and_starts_at_the_first_row(spark):
    df = frame(spark, [bar(0.25, 1.0), bar(3.5, 1.0), bar(-100, 1.0, sym="b")])
    grid = gap.time_grid(df, series(2))
    assert rows(grid) == [("a", at(m + 0.25)) for m in range(4)] + [("b", at(-100))]


def test_grid_without_keys_and_with_zoned_timestamps(spark):
    df = frame(spark, [bar(0, 1.0), bar(5, 2.0)], "timestamp").drop("sym")
    grid = gap.time_grid(df, series(2, keys=()))
    assert [r[0] for r in rows(grid)] == [at(m) for m in range(6)]
    filled = fill_bars(df, df.limit(0), series(2, keys=()), BARS)
    assert [r["close"] for r in filled.orderBy("ts").collect()] == [1.0] * 5 + [2.0]


def test_wall_clock_times_ignore_daylight_saving(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = frame(spark, [bar(0, 1.0), bar(180, 1.0)])  # 01:00 to 04:00 on the day the clock changes
        assert gap.time_grid(df, S).count() == 181
        assert fill_bars(df, df.limit(0), S, BARS).count() == 181
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_leading_nulls_stay_and_volume_is_zero(spark):
    p = frame(spark, [bar(0, None, None), bar(1, None, None), bar(2, 5.0)])
    out = fill_bars(p, p.limit(0), S, BARS).orderBy("ts").collect()
    assert [r["close"] for r in out] == [None, None, 5.0]
    assert [r["volume"] for r in out] == [0.0, 0.0, 1.0]


def test_gap_repeats_last_value_with_zero_volume(spark):
    p = frame(spark, [bar(0, 5.0), bar(90, 7.0)])
    out = fill_bars(p, p.limit(0), S, BARS, flags=True).orderBy("ts").collect()
    assert [r["close"] for r in out] == [5.0] * 90 + [7.0]
    assert {r["volume"] for r in out[1:90]} == {0.0}
    assert sum(r["was_missing"] for r in out) == 89 and not any(r["from_aux"] for r in out)


def test_aux_fills_only_null_columns_and_only_inside_the_range(spark):
    p = frame(spark, [bar(0, 5.0, open=None), bar(3, 6.0)])
    a = frame(spark, [bar(-1, 1.0), bar(0, 2.0), bar(2, 3.0), bar(4, 9.0)])
    out = fill_bars(p, a, S, BARS, flags=True).orderBy("ts").collect()
    assert [(r["open"], r["close"]) for r in out] == [(2.0, 5.0), (2.0, 5.0), (3.0, 3.0), (6.0, 6.0)]
    assert [r["from_aux"] for r in out] == [True, False, True, False]


def test_aux_before_the_first_row_is_not_carried_in(spark):
    p = frame(spark, [bar(5, None, None), bar(90, 6.0)])
    a = frame(spark, [bar(4, 1.0)])
    assert {r["close"] for r in fill_bars(p, a, S, BARS).collect()} == {None, 6.0}


def test_off_grid_rows_vanish(spark):
    p = frame(spark, [bar(0, 5.0), bar(1.5, 99.0), bar(60, 6.0)])
    assert {r["close"] for r in fill_bars(p, p.limit(0), S, BARS).collect()} == {5.0, 6.0}


def test_duplicates_are_rejected_or_fan_out(spark):
    p = frame(spark, [bar(0, 5.0), bar(1, 6.0), bar(1, 7.0), bar(2, 8.0)])
    with pytest.raises(Exception, match="duplicate time"):
        fill_bars(p, p.limit(0), S, BARS).collect()
    assert fill_bars(p, p.limit(0), S, BARS, duplicates="keep").count() == 4
    with pytest.raises(ValueError):
        fill_bars(p, p, S, BARS, duplicates="drop")


def test_series_do_not_leak_into_each_other(spark):
    p = frame(spark, [bar(0, 5.0), bar(10, 6.0), bar(0, None, None, "b"), bar(10, 1.0, sym="b")])
    out = fill_bars(p, p.limit(0), S, BARS).where("sym = 'b'").orderBy("ts").collect()
    assert [r["close"] for r in out] == [None] * 10 + [1.0]


def test_empty_source_gives_empty_grid(spark):
    none = frame(spark, [bar(0, 5.0)]).limit(0)
    assert fill_bars(none, frame(spark, [bar(0, 5.0)]), S, BARS).count() == 0
    assert gap.time_grid(none, S).count() == 0


def test_fill_stats(spark):
    p = frame(spark, [bar(0, 5.0), bar(4, 6.0)])
    a = frame(spark, [bar(1, 3.0)])
    stats = gap.fill_stats(fill_bars(p, a, S, BARS, flags=True)).first().asDict()
    assert (stats["rows"], stats["missing"], stats["aux_filled"], stats["forward_filled"]) == (5, 3, 1, 2)
    assert stats["aux_filled_pct"] == pytest.approx(100 / 3)
    full = gap.fill_stats(fill_bars(a, a, S, BARS, flags=True)).first()
    assert full["missing"] == 0 and full["aux_filled_pct"] is None


def test_off_grid_rows_go_before_the_windows_over_a_series(spark):
    p = frame(spark, [bar(i, 1.0 + i % 5) for i in range(0, 300, 3)])
    odd = [bar(i + (i % 59 + 1) / 61, 7.0) for i in range(300)]
    a = frame(spark, odd + [bar(4, 9.0)])
    seeds = gap._chunk_seeds(p, a, S, BARS, 0, 0)
    assert seeds.count() == 8  # one row per chunk of 40 steps
    text = seeds._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Window") < text.index("Join")  # the join lies below the windows
    assert_same(fill_bars(p, a, S, BARS), fill_bars(p, frame(spark, [bar(4, 9.0)]), S, BARS))
