"""Moments that merge, the rank-sum area, malformed cells, stored models."""

import random

import pytest
from pyspark.sql import functions as F

from barflow.operators import metrics, moments, scaling
from barflow.plans import scoring, training
from barflow.series import LABEL, Series
from barflow.sources import schemas, tables
from barflow.session import stage
from helpers import BARS, at


def numbers(spark, n, seed=3):
    draw = random.Random(seed)
    rows = [(at(37 * i), 1e9 + draw.random(), None if i % 5 == 0 else float(draw.randrange(9))) for i in range(n)]
    return spark.createDataFrame(rows, "ts timestamp, big double, few double")


def test_moments_of_parts_are_those_of_the_whole(spark, tmp_path):
    df, folder = numbers(spark, 400), str(tmp_path / "moments")
    for k in (0, 1, 2, 2):
        moments.write_moments(moments.moments(df.where(F.minute("ts") % 3 == k), ["big", "few"], "ts", "day"), folder, f"p{k}")
    merged = moments.merge_moments(moments.read_moments(spark, folder))
    fitted, whole = moments.scaler_of(merged, ["big", "few"]), scaling.fit_scaler(df, ["big", "few"])
    assert fitted.means == pytest.approx(whole.means, rel=1e-14)
    assert fitted.deviations == pytest.approx(whole.deviations, rel=1e-6)  # values of 1e9 that differ by less than 1
    days = moments.merge_moments(moments.read_moments(spark, folder), ["day"])
    got = moments.profile_of(days, "day", {"mean": ("few", "avg"), "sum": ("few", "total"), "low": ("few", "min")}).collect()
    want = df.groupBy(F.to_date("ts").alias("day")).agg(F.avg("few"), F.sum("few"), F.min("few")).orderBy("day").collect()
    assert [r[0] for r in got] == [r[0] for r in want]
    for g, w in zip(got, want):
        assert tuple(g[1:]) == pytest.approx(tuple(w[1:]))


def test_moments_without_values(spark):
    rows = [(at(0), None, None), (at(5), None, 2.0)]
    df = spark.createDataFrame(rows, "ts timestamp, big double, few double")
    merged = {r["column"]: r for r in moments.merge_moments(moments.moments(df, ["big", "few"], "ts")).collect()}
    assert (merged["big"]["rows"], merged["big"]["n"], merged["big"]["mean"], merged["big"]["min"]) == (2, 0, None, None)
    assert (merged["few"]["n"], merged["few"]["mean"], merged["few"]["m2"]) == (1, 2.0, 0.0)
    assert moments.moments(df.limit(0), ["few"], "ts").count() == 0
    with pytest.raises(ValueError):
        moments.scaler_of(moments.merge_moments(moments.moments(df, ["few"], "ts")), ["other"])


@pytest.mark.parametrize("kinds", [1, 3, 1000])
def test_area_against_all_pairs(spark, kinds):
    draw = random.Random(kinds)
    rows = [(float(draw.randrange(kinds)), draw.randrange(2)) for _ in range(150)]
    df = spark.createDataFrame([*rows, (None, 1), (0.0, None)], "score double, label int")
    up, down = ([s for s, y in rows if y == k] for k in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in up for b in down)
    assert metrics.auc_roc(df, "score", "label") == pytest.approx(wins / (len(up) * len(down)))
    assert metrics.auc_roc(df.where("label = 0"), "score", "label") is None
    assert metrics.auc_roc(df.limit(0), "score", "label") is None


def test_malformed_cells_are_not_empty_ones(spark, tmp_path):
    head = "Timestamp,Open,High,Low,Close,Volume\n"
    (tmp_path / "a.csv").write_text(head + "1,1,2,0.5,1,3\n2,x1,2,,1,3\n3,1,2\n4,1,2,0,1,2,9\n")
    (tmp_path / "b.csv").write_text(head + "5,1,2,0.5,1,\n6,1,2,0.5,1,1e2\n")
    read = stage(tables.read_csv(spark, str(tmp_path), schemas.raw_aux(), checked=True))
    found = {r["file"].rsplit("/", 1)[1]: r for r in tables.bad_cells(read, schemas.raw_aux()).collect()}
    a, b = found["a.csv"], found["b.csv"]
    assert (a["rows"], a["bad_rows"], a["bad_Open"], a["bad_Low"], a["bad_Close"]) == (4, 3, 1, 0, 0)
    assert (b["rows"], b["bad_rows"], b["bad_Volume"]) == (2, 0, 0)
    assert {r["Timestamp"]: r[tables.BAD] for r in read.collect()}[2.0] == "2,x1,2,,1,3"
    plain = tables.read_csv(spark, str(tmp_path), schemas.raw_aux())
    assert sorted(map(str, plain.collect())) == sorted(map(str, read.drop(tables.BAD, tables.FILE).collect()))


@pytest.fixture(scope="module")
def fitted(spark):
    draw = random.Random(5)
    rows = [(at(i), int(x + y > 1), x, y) for i in range(120) for x, y in [(draw.random(), draw.random())]]
    df = spark.createDataFrame(rows, f"ts timestamp, {LABEL} int, x double, y double")
    series = Series("ts", ())
    return df, training.train(df, "lr", series, columns=["x", "y"], bars=BARS)


def test_stored_model_scores_as_before(spark, tmp_path, fitted):
    df, outcome = fitted
    path = str(tmp_path / "model")
    for _ in range(2):  # a model is replaced
        scoring.save_model(spark, scoring.StoredModel(outcome.model, "lr", outcome.columns, LABEL), path)
    stored = scoring.load_model(spark, path)
    assert (stored.kind, stored.columns, stored.label) == ("lr", ("x", "y"), LABEL)
    odd = df.select("ts", "x", F.col("y").cast("float").alias("y"), F.lit("kept").alias("features"), F.lit(1).alias("_in0"))
    odd = odd.withColumn("x", F.when(F.minute("ts") % 7 == 0, F.lit(None)).when(F.minute("ts") % 7 == 1, F.lit(float("nan"))).otherwise(F.col("x")))
    got = scoring.score(odd, stored, ["ts", "features", "_in0"]).orderBy("ts").collect()
    before = outcome.model.transform(df).orderBy("ts").collect()
    assert len(got) == 120
    for g, b in zip(got, before):
        assert (g["features"], g["_in0"]) == ("kept", 1)
        if g["ts"].minute % 7 < 2:
            assert g["prediction"] is None and g["probability"] is None
        else:
            assert g["probability"] == pytest.approx(b["probability"].toArray().tolist(), abs=1e-6)
    assert scoring.score(odd.limit(0), stored, ["ts"]).count() == 0


def test_contract_of_a_stored_model(spark, tmp_path, fitted):
    df, outcome = fitted
    stored = scoring.StoredModel(outcome.model, "lr", outcome.columns, LABEL)
    with pytest.raises(ValueError, match="needs columns"):
        scoring.score(df.drop("y"), stored, ["ts"])
    with pytest.raises(ValueError, match="not numbers"):
        scoring.score(df.withColumn("y", F.lit("1")), stored, ["ts"])
    with pytest.raises(ValueError, match="exist already"):
        scoring.score(df.withColumn("prediction", F.lit(1)), stored, ["prediction"])
