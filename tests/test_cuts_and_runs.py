"""Cuts per series, fit certificates, run records of any classes and comparisons of any runs."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from barflow.__main__ import main
from barflow.operators import splits
from barflow.operators.certificates import fit_certificate
from barflow.operators.models import pipeline
from barflow.plans import training
from barflow.plans.reports import compare_runs
from barflow.series import Series
from barflow.sources.runs import append_run, compact_runs, parse_run_matrix, read_runs, runs_frame
from helpers import assert_same

S = Series("ts", ("k",), timedelta(minutes=1), 50, 3)


def events(spark, seed, micros=True):
    """Series of very different sizes at irregular microseconds, some of one time only."""
    draw, rows = random.Random(seed), []
    for k, n in (("a", 400), ("b", 37), ("c", 1), ("d", 2)):
        times = {draw.randrange(10**10 if micros else 100) for _ in range(n)}
        rows += [(k, datetime(2024, 1, 1) + timedelta(microseconds=t), draw.random()) for t in times]
    rows += [("same", datetime(2024, 1, 1), float(i)) for i in range(9)]
    return spark.createDataFrame(draw.sample(rows, len(rows)), "k string, ts timestamp_ntz, v double")


@pytest.mark.parametrize("percent", [0.01, 30, 50, 99.9, 100])
def test_fractions_of_each_series(spark, percent):
    df = events(spark, 1)
    for each, order in ((splits.oldest_fraction, F.col("ts").asc()), (splits.newest_fraction, F.col("ts").desc())):
        w = Window.partitionBy("k")
        plain = df.withColumns({"n": F.count("*").over(w), "r": F.row_number().over(w.orderBy(order, F.xxhash64("k", "ts", "v")))})
        plain = plain.where(F.col("r") <= (F.col("n") * F.lit(percent / 100.0)).cast("long")).drop("n", "r")
        assert_same(each(df, percent, S, by_series=True), plain)


@pytest.mark.parametrize("micros", [True, False])
def test_time_splits_of_each_series(spark, micros):
    df = events(spark, 2, micros)
    train, test = splits.time_split(df, 0.6, S, by_series=True)
    plain = df.withColumn("r", F.percent_rank().over(Window.partitionBy("k").orderBy("ts")))
    assert_same(train, plain.where("r <= 0.6").drop("r"))
    assert_same(test, plain.where("r > 0.6").drop("r"))


def test_cuts_without_keys_or_rows(spark):
    whole = Series("ts", (), timedelta(minutes=1), 50)
    df = events(spark, 3)
    assert_same(splits.oldest_fraction(df, 20, whole, by_series=True), splits.oldest_fraction(df, 20, whole))
    assert splits.oldest_fraction(df.limit(0), 20, S, by_series=True).count() == 0
    assert [p.count() for p in splits.time_split(df.limit(0), 0.5, S, by_series=True)] == [0, 0]


def labelled(spark, n=600):
    draw = random.Random(4)
    rows = [(x, draw.uniform(-5, 5), int(draw.random() < 1 / (1 + 2.7 ** (-3 * x)))) for x in (draw.gauss(0, 1) for _ in range(n))]
    return spark.createDataFrame(rows, "a double, b double, Target int")


def test_only_a_fitted_model_has_a_certificate(spark):
    df = labelled(spark)
    good = fit_certificate(pipeline("lr", ["a", "b"], "Target").fit(df), df, ["a", "b"], "Target")
    assert good["gradient"] < 1e-3 and good["log_loss"] < 0.9 * good["base_log_loss"] and good["rows"] == 600
    short = fit_certificate(pipeline("lr", ["a", "b"], "Target", maxIter=1).fit(df), df, ["a", "b"], "Target")
    assert short["gradient"] > 1e-3
    constant = fit_certificate(pipeline("lr", ["a", "b"], "Target", regParam=1e6).fit(df), df, ["a", "b"], "Target")
    assert constant["gradient"] > 0.1 and constant["spread"] < 1e-3
    assert constant["log_loss"] == pytest.approx(constant["base_log_loss"], abs=1e-4)


def record(classes):
    line = lambda c: {"precision": c / 8, "recall": c / 16, "f1-score": 0.25, "support": c}
    return {"model": "m", "rows": 3, "accuracy": 0.5, "time_seconds": 1.5, "features": ["x"],
            "classification_report": {**{str(c): line(c) for c in classes}, "accuracy": 0.5, "weighted avg": line(9)}}


def test_records_of_any_classes_survive_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    append_run(runs_frame(spark, [record([0, 1, 2, 7])]), path)
    append_run(runs_frame(spark, [record([]) | {"accuracy": None}]), path)
    append_run(runs_frame(spark, [{"model": "bare"}]), path)
    compact_runs(spark, path, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    for read in (read_runs(spark, path), read_runs(spark, str(tmp_path / "one"))):
        rows = {(r["model"], len(r["classification_report"] or {})): r for r in read.collect()}
        full = rows["m", 5]
        assert set(full["classification_report"]) == {"0", "1", "2", "7", "weighted avg"} and full["features"] == ["x"]
        assert full["classification_report"]["7"].asDict() == {"precision": 7 / 8, "recall": 7 / 16, "f1-score": 0.25, "support": 7}
        assert rows["m", 1]["accuracy"] is None and ("bare", 0) in rows
    written = [json.loads(line) for f in (tmp_path / "one").glob("part-*") for line in f.read_text().splitlines()]
    assert [w["classification_report"]["accuracy"] for w in written if "2" in w["classification_report"]] == [0.5]


def test_reports_of_other_runs(spark, tmp_path):
    document = json.dumps({"8_workers": {"50%": [record([0, 1, 2]) | {"model": "Random Forest"}]}})
    matrix = parse_run_matrix(spark.createDataFrame([(document,)], "value string"))
    found = compare_runs(matrix, workers=(4, 8), fractions=(50,), at_workers=8, at_fraction=50)
    times = {r["workers"]: r["Random Forest"] for r in found["time_by_workers"].collect()}
    assert times == {4: None, 8: 1.5}
    assert [tuple(r[c] for c in ("fraction", "Random Forest")) for r in found["accuracy_by_fraction"].collect()] == [(50, 0.5)]
    assert {r["model"]: r["weighted_recall"] for r in found["recall_by_model"].collect()}["Random Forest"] == 9 / 16
    (tmp_path / "runs.json").write_text(document)
    main(["compare", "--input", str(tmp_path / "runs.json"), "--output", str(tmp_path / "out"), "--workers", "8",
          "--fractions", "50", "--at-workers", "8", "--at-fraction", "50"])
    lines = spark.read.csv(str(tmp_path / "out" / "time_by_workers"), header=True).collect()
    assert [(r["workers"], r["Random Forest"]) for r in lines] == [("8", "1.5")]


def test_three_classes_are_recorded(spark):
    scored = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 1)], "Target int, prediction int")
    report = training.run_record("rf", 1, 0.0, scored, "Target", [])["classification_report"]
    assert set(report) == {"0", "1", "2", "accuracy", "weighted avg"} and report["2"]["recall"] == 0.5
