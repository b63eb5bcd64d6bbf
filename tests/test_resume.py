"""Filling and features of appended bars against one run over everything."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from barflow.__main__ import main
from barflow.plans import prepare, resume
from barflow.series import Series
from barflow.sources import schemas, tables
from helpers import BARS, assert_same, at, bar, frame

HORIZON = timedelta(minutes=3)


def series(keys=("sym",)):
    return Series("ts", keys, timedelta(minutes=1), 40)


def walk(seed, syms, minutes):
    draw = random.Random(seed)
    return [bar(m, 1.0 + draw.randrange(9), sym=s) for s in syms for m in range(minutes) if draw.random() < 0.35]


def parts(rows, cuts):
    edges = [-1, *cuts, 10**9]
    return [[r for r in rows if at(a) < r[1] <= at(min(b, 10**6))] for a, b in zip(edges, edges[1:])]


@pytest.mark.parametrize("keys,syms", [(("sym",), "abc"), ((), "a")])
def test_parts_add_up_to_one_run(spark, keys, syms):
    s = series(keys)
    primary, aux = walk(1, syms, 300), walk(2, syms, 300)
    primary = [r for r in primary if r[0] != "c" or r[1] > at(150)]  # c begins late
    primary = [r for r in primary if r[0] != "b" or not at(90) < r[1] < at(240)]  # b pauses for a whole part
    state, filled, features = None, [], []
    for own, other in zip(parts(primary, (100, 200)), parts(aux, (130, 215))):
        before = state
        done, state = resume.resume_fill(frame(spark, own), frame(spark, other), before, s, BARS, resume.history_steps(s, HORIZON))
        filled.append(done)
        features.append(resume.resume_features(done, before, s, BARS, HORIZON))
    assert state.rows.groupBy(*keys).count().agg(F.max("count")).first()[0] == resume.history_steps(s, HORIZON)
    whole = prepare.fill_bars(frame(spark, primary), frame(spark, aux), s, BARS)
    assert_same(filled[0].unionByName(filled[1]).unionByName(filled[2]), whole)
    joined = features[0].unionByName(features[1]).unionByName(features[2])
    assert_same(joined, prepare.build_features(whole, s, BARS, HORIZON))


def test_late_and_missing_rows(spark):
    s, none = series(), frame(spark, [])
    first, state = resume.resume_fill(frame(spark, [bar(5, 1.0), bar(7, 2.0)]), none, None, s, BARS)
    assert first.count() == 3
    late, state = resume.resume_fill(frame(spark, [bar(6, 9.0), bar(7, 9.0)]), frame(spark, [bar(6, 8.0), bar(9, 3.0)]), state, s, BARS)
    assert late.count() == 0 and state.pending.count() == 1 and state.rows.count() == 1
    nothing, state = resume.resume_fill(none, none, state, s, BARS)
    assert nothing.count() == 0
    last, state = resume.resume_fill(frame(spark, [bar(10, 4.0)]), none, state, s, BARS)
    assert [(r.ts, r.close) for r in last.orderBy("ts").collect()] == [(at(8), 2.0), (at(9), 3.0), (at(10), 4.0)]
    assert state.pending.count() == 0
    empty, state = resume.resume_fill(none, none, None, s, BARS)
    assert empty.count() == 0 and state.rows.count() == 0


def test_states_are_kept_in_versions(spark, tmp_path):
    s, path = series(), str(tmp_path / "states")
    assert resume.read_state(spark, path) is None
    for minute in (3, 6, 8):
        _, state = resume.resume_fill(frame(spark, [bar(minute, 1.0 * minute)]), frame(spark, []), resume.read_state(spark, path), s, BARS)
        resume.write_state(state, path)
    (tmp_path / "states" / "state-00000009" / "rows").mkdir(parents=True)  # a run that failed
    (row,) = resume.read_state(spark, path).rows.collect()
    assert (row.ts, row.close) == (at(8), 8.0)


def test_command_line_goes_on_from_its_state(spark, tmp_path):
    def write(name, rows):
        text = frame(spark, rows).select(F.date_format("ts", "dd-MM-yyyy HH:mm").alias("Timestamp"), *(
            F.col(a).alias(b) for a, b in zip(BARS.all, ["Open", "High", "Low", "Close", "Volume_(BTC)", "Volume_(Currency)", "Weighted_Price"])))
        tables.write_csv(text, str(tmp_path / name))
        return str(tmp_path / name)

    aux = spark.createDataFrame([], schemas.raw_aux())
    tables.write_csv(aux, str(tmp_path / "aux"), single_file=True)
    counts = []
    for name, rows in (("one", [bar(0, 1.0), bar(2, 3.0)]), ("two", [bar(5, 2.0)])):
        main(["fill", "--input", write(name, rows), "--aux", str(tmp_path / "aux"), "--output", str(tmp_path / f"out-{name}"),
              "--state", str(tmp_path / "state"), "--format", "parquet"])
        counts.append(spark.read.parquet(str(tmp_path / f"out-{name}")).count())
    assert counts == [3, 3]
