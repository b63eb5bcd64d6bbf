"""Metrics, training, run records, reports and the command line."""

import json

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from barflow import session
from barflow.__main__ import main, parser
from barflow.operators import metrics, models, runs, splits
from barflow.operators import runs as R
from barflow.plans import prepare, training
from barflow.plans.reports import compare_runs
from barflow.series import Series, lr_features
from barflow.session import new_path, shared_folder, stage
from barflow.sources import tables
from barflow.sources.runs import append_run, read_run_matrix, read_runs, runs_frame
from helpers import BARS, assert_same, bar, frame, rows, series
from test_gapfill import sparse

S = series()


def predictions(spark, pairs):
    return spark.createDataFrame([(float(p), int(t)) for p, t in pairs], "prediction double, Target int")


# --- metrics ---

def test_metrics_match_the_library_evaluator(spark):
    df = predictions(spark, [(i % 3 == 0, i % 2) for i in range(101)])
    per_class = metrics.class_metrics(df, "Target")
    total = metrics.summary_metrics(per_class).first()
    library = lambda name, **kw: MulticlassClassificationEvaluator(labelCol="Target", metricName=name, **kw).evaluate(df)
    assert total["accuracy"] == pytest.approx(library("accuracy")) == pytest.approx(total["weighted_recall"])
    assert total["weighted_precision"] == pytest.approx(library("weightedPrecision"))
    assert total["weighted_f1"] == pytest.approx(library("f1"))
    for r in per_class.collect():
        label = float(r["label"])
        assert r["precision"] == pytest.approx(library("precisionByLabel", metricLabel=label))
        assert r["recall"] == pytest.approx(library("recallByLabel", metricLabel=label))
        assert r["f1"] == pytest.approx(library("fMeasureByLabel", metricLabel=label))
    assert (total["support"], total["majority_share"]) == (101, pytest.approx(51 / 101))


def test_class_never_predicted_or_absent(spark):
    lines = rows(metrics.class_metrics(predictions(spark, [(0, 0), (0, 1), (0, 0)]), "Target"), "label")
    assert lines[1][1:5] == (0.0, 0.0, 0.0, 1)
    total = metrics.summary_metrics(metrics.class_metrics(predictions(spark, [(0, 0), (0, 1)]), "Target")).first()
    assert total["predicted_share"] == 1.0
    none = metrics.summary_metrics(metrics.class_metrics(predictions(spark, [(0, 0)]).limit(0), "Target")).first()
    assert none["accuracy"] is None and none["support"] == 0


def test_auc_is_exact_with_ties(spark):
    data = [(0.1, 0), (0.4, 0), (0.4, 1), (0.4, 1), (0.8, 0), (0.9, 1)]
    df = spark.createDataFrame(data, "score double, Target int")
    wins = sum((p > n) + 0.5 * (p == n) for p, a in data if a for n, b in data if not b)
    assert metrics.auc_roc(df, "score", "Target") == pytest.approx(wins / 9)


# --- training ---

@pytest.fixture(scope="module")
def table(spark):
    p, a = (frame(spark, r) for r in sparse(41, 600, ("a", "hot")))
    return stage(prepare.bars_to_features(p, a, S, BARS), "features")


@pytest.mark.parametrize("kind, parameters", [
    ("gbt", {"maxIter": 2}), ("rf", {"numTrees": 3, "maxDepth": 3}), ("mlp", {"hidden": [4]}), ("lr", {}),
])
def test_train_records_a_run(spark, table, tmp_path, kind, parameters):
    data = stage(prepare.build_lr_features(table, S, BARS)) if kind == "lr" else table
    outcome = training.train(data, kind, S, bars=BARS, **parameters)
    record = outcome.record
    tested = outcome.predictions.count()
    assert record["rows"] + tested == data.count() and record["model"] == models.NAMES[kind]
    report = record["classification_report"]
    assert report["0"]["support"] + report["1"]["support"] == tested == report["weighted avg"]["support"]
    assert report["weighted avg"]["recall"] == pytest.approx(record["accuracy"]) == pytest.approx(report["accuracy"])
    assert 0.5 <= record["majority_share"] <= 1 and record["time_seconds"] > 0
    if kind == "lr":
        assert 0 <= record["auc_roc"] <= 1 and record["features"] == lr_features(BARS)
        assert outcome.predictions.agg(F.min("ts")).first()[0] > data.agg(F.min("ts")).first()[0]
    path = str(tmp_path / "runs")
    append_run(outcome.frame(), path)
    append_run(outcome.frame(), path)
    assert read_runs(spark, path).count() == 2
    assert_same(read_runs(spark, path).select("model", "rows", "accuracy").distinct(),
                outcome.frame().select("model", "rows", "accuracy"))


def test_data_percentage(spark, table):
    n = table.count()
    oldest = training.choose_rows(table, "gbt", S, 25)
    newest = training.choose_rows(table, "rf", S, 25)
    assert oldest.count() == newest.count() == int(n * 0.25)
    assert oldest.agg(F.max("ts")).first()[0] < newest.agg(F.min("ts")).first()[0]
    assert training.choose_rows(table, "gbt", S, 0).count() == n == training.choose_rows(table, "gbt", S, None).count()


def test_model_parameters():
    gbt, forest, net, line = (models.ESTIMATORS[k](12, "Target") for k in ("gbt", "rf", "mlp", "lr"))
    assert gbt.getMaxIter() == 10
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)
    assert net.getLayers() == [12, *[128, 64, 32, 16, 8] * 3, 2] and net.getBlockSize() == 128
    assert (line.getMaxIter(), line.getRegParam()) == (100, 0.0)


# --- run comparison ---

def run(model, seconds, accuracy, recall=0.5):
    average = {"support": None, "f1-score": 0.4, "recall": recall, "precision": 0.3}
    return {"model": model, "rows": 10, "time_seconds": seconds, "accuracy": accuracy, "timestamp": 1,
            "classification_report": {"0": None, "accuracy": None, "weighted avg": average}}


@pytest.fixture(scope="module")
def document(tmp_path_factory):
    a, b, c = runs.MODELS
    path = tmp_path_factory.mktemp("runs") / "runs.json"
    path.write_text(json.dumps({
        "2_workers": {"100%": [run(a, 9.0, 0.6), run(b, 20.0, 0.61)]},
        "3_workers": {"100%": [run(a, 8.0, 0.6), run(a, 7.0, 0.65, 0.66), run(b, 15.0, 0.62)], "25%": [run(c, 3.0, 0.5)]},
    }, indent=1))
    return str(path)


def test_run_reports(spark, document):
    flat = runs.flatten_runs(read_run_matrix(spark, document))
    assert flat.count() == 6 and set(flat.select("workers", "fraction").distinct().collect()) == {(2, 100), (3, 100), (3, 25)}
    assert rows(runs.get_metric(flat, "f1").select("f1").distinct()) == [(0.4,)]
    assert rows(runs.get_metric(flat, "accuracy").where("workers = 2"), "position")[0][-1] == 0.6
    reports = compare_runs(read_run_matrix(spark, document))
    assert rows(reports["time_by_workers"], "workers") == [(2, 9.0, 20.0, None), (3, 7.0, 15.0, None), (4, None, None, None)]
    assert rows(reports["time_by_fraction"], "fraction") == [
        (25, None, None, 3.0), (50, None, None, None), (75, None, None, None), (100, 7.0, 15.0, None)]
    assert rows(reports["accuracy_by_fraction"], "fraction")[3] == (100, 0.65, 0.62, None)
    assert [tuple(r) for r in reports["recall_by_model"].collect()] == list(zip(runs.MODELS, (0.66, 0.5, None)))


def test_runs_frame_fills_absent_fields(spark):
    row = runs_frame(spark, [run("m", 1.0, 0.5)]).first()
    assert row["auc_roc"] is None and row["classification_report"]["weighted avg"]["recall"] == 0.5


# --- session and command line ---

def test_shared_folder_is_read_from_the_session(spark):
    class Named:
        conf = {"spark.checkpoint.dir": "/shared/"}
        sparkContext = None

    Named.sparkContext = spark.sparkContext
    assert shared_folder(Named) == "/shared/" and new_path(Named, "x").startswith("/shared/x-")

    class Cluster:
        conf = {}

        class sparkContext:
            master = "spark://cluster"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
    assert shared_folder(spark) == shared_folder(spark)


def test_jobs_from_the_command_line(spark, tmp_path, document):
    path = lambda name: str(tmp_path / name)
    start = 1_325_317_920
    lines = [(start + 60 * i, 5 + (i * i) % 7, 2 + i % 3) for i in range(400)]
    raw = spark.createDataFrame(lines, "t long, p int, v int").withColumn("p", F.col("p").cast("double"))
    raw.select(F.col("t").alias("Timestamp"), *(F.col("p").alias(c) for c in ("Open", "High", "Low", "Close")),
               F.col("v").alias("Volume")).coalesce(1).write.option("header", True).csv(path("aux"))
    primary = raw.where("t % 420 <> 0").select(
        F.date_format(F.timestamp_seconds("t"), "dd-MM-yyyy HH:mm").alias("Timestamp"),
        *(F.col("p").alias(c) for c in ("Open", "High", "Low", "Close")), F.col("v").alias("Volume_(BTC)"),
        (F.col("v") * F.col("p")).alias("Volume_(Currency)"), F.col("p").alias("Weighted_Price"))
    primary.coalesce(1).write.option("header", True).csv(path("bars"))

    main(["fill", "--input", path("bars"), "--aux", path("aux"), "--output", path("filled"), "--single-file"])
    main(["features", "--input", path("filled"), "--output", path("features")])
    main(["scale", "--input", path("features"), "--output", path("scaled")])
    main(["lr-features", "--input", path("features"), "--output", path("lr")])
    main(["profile", "--input", path("features"), "--output", path("profile")])
    main(["train", "--input", path("lr"), "--output", path("runs"), "--model", "lr", "--data-percentage", "50",
          "--store", path("model")])
    main(["score", "--input", path("lr"), "--stored", path("model"), "--output", path("scored")])
    main(["compare", "--input", document, "--output", path("reports")])

    assert tables.read_csv(spark, path("filled")).count() == 400
    assert tables.read_csv(spark, path("features")).count() == 400 - 18
    assert tables.read_csv(spark, path("lr")).count() == 400 - 18 - 5
    assert tables.read_csv(spark, path("profile")).count() == 1
    scored = tables.read_csv(spark, path("scored"))
    assert scored.columns == ["Timestamp", "prediction", "probability"] and scored.count() == 400 - 18 - 5
    assert scored.where("(probability > 0.5) <> (prediction = 1)").count() == 0
    record = read_runs(spark, path("runs")).first()
    assert record["rows"] == 150 and record["auc_roc"] is not None  # 188 rows, percent rank at most 0.8
    assert tables.read_csv(spark, path("reports/time_by_workers")).count() == 3


def test_keyed_jobs_from_the_command_line(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    rows_of = lambda sym, n: [f"{sym},01-02-2020 {m // 60:02d}:{m % 60:02d},2,3,1,{2 + m % 3 / 4},1,2,2" for m in range(0, n, 2)]
    header = "sym,Timestamp,Open,High,Low,Close,Volume_(BTC),Volume_(Currency),Weighted_Price"
    (tmp_path / "bars.csv").write_text("\n".join([header, *rows_of("x", 101), *rows_of("y", 61)]) + "\n")
    (tmp_path / "aux.csv").write_text("sym,Timestamp,Open,High,Low,Close,Volume\nx,1580515260,2,3,1,2.5,4\n")
    keyed = ["--keys", "sym", "--chunk-steps", "40"]
    main(["fill", "--input", path("bars.csv"), "--aux", path("aux.csv"), "--output", path("filled"), *keyed])
    main(["features", "--input", path("filled"), "--output", path("features"), *keyed])
    filled = tables.read_csv(spark, path("filled"))
    assert rows(filled.groupBy("sym").count()) == [("x", 101), ("y", 61)]
    assert filled.where("sym = 'x' and `Volume_(BTC)` = 4").count() == 1
    assert rows(tables.read_csv(spark, path("features")).groupBy("sym").count()) == [("x", 83), ("y", 43)]


def test_jobs_pass_parquet_and_leave_no_staged_tables(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "stages"))
    path = lambda name: str(tmp_path / name)
    steps = [f"01-02-2020 {m // 60:02d}:{m % 60:02d},2,3,1,{2 + m % 3 / 4},1,2,2" for m in range(0, 101, 2)]
    header = "Timestamp,Open,High,Low,Close,Volume_(BTC),Volume_(Currency),Weighted_Price"
    (tmp_path / "bars.csv").write_text("\n".join([header, *steps]) + "\n")
    (tmp_path / "aux.csv").write_text("Timestamp,Open,High,Low,Close,Volume\n1580515260,2,3,1,2.5,4\n1580515380,2,3,1,2.5,0\n")
    main(["fill", "--input", path("bars.csv"), "--aux", path("aux.csv"), "--output", path("filled"), "--format", "parquet"])
    assert "|   2|          1|" in capsys.readouterr().out
    main(["features", "--input", path("filled"), "--output", path("features"), "--format", "parquet"])
    main(["lr-features", "--input", path("features"), "--output", path("lr"), "--format", "parquet"])
    assert "rows read: 83, rows written: 78" in capsys.readouterr().out
    assert spark.read.parquet(path("lr")).count() == 78 and not list((tmp_path / "stages").glob("*-*"))


def test_command_line_options():
    with pytest.raises(SystemExit):
        parser().parse_args(["fill", "--input", "a", "--output", "b"])
    assert parser().parse_args(["train", "--input", "a", "--output", "b", "--model", "gbt"]).data_percentage is None


def test_shares_are_exact(spark):
    table = spark.range(200_000).select(F.timestamp_seconds("id").alias("ts"), (F.col("id") % 2).cast("int").alias("y"))
    s = Series("ts", ())
    for share in (0.9996, 0.0004, 0.7654):
        for train, test in (splits.random_split(table, share, s), splits.stratified_split(table, "y", share, s)):
            n = train.count()
            assert n + test.count() == 200_000 and abs(n - 200_000 * share) < 5 * (200_000 * share * (1 - share)) ** 0.5 + 1


def test_accuracy_covers_all_labels(spark):
    frame = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 0.0), (2, 1.0), (1, 0.0)], "y int, prediction double")
    lines = metrics.class_metrics(frame, "y")
    assert [(r.label, r.support) for r in lines.collect()] == [(0.0, 1), (1.0, 2), (2.0, 2)]
    total = metrics.summary_metrics(lines).first()
    assert (total.accuracy, total.support) == (0.4, 5)


def test_reports_keep_other_runs(spark):
    runs = spark.createDataFrame(
        [(8, 100, 0, "Random Forest", 5.0, 0.9, 0.8), (3, 10, 0, "Logistic", 2.0, 0.7, 0.6), (3, 100, 0, "Logistic", 3.0, 0.75, 0.65)],
        "workers int, fraction int, position int, model string, time_seconds double, accuracy double, weighted_recall double",
    )
    by_workers = {r.workers: r for r in R.report_time_by_workers(runs).collect()}
    assert sorted(by_workers) == [2, 3, 4, 8] and by_workers[8]["Random Forest"] == 5.0 and by_workers[3]["Logistic"] == 3.0
    assert {r.fraction: r["Logistic"] for r in R.report_accuracy_by_fraction(runs).collect()}[10] == 0.7
    assert {r.model: r.weighted_recall for r in R.report_recall(runs).collect()}["Logistic"] == 0.65


def test_percent_is_checked(spark):
    for percent in (-1, 101):
        with pytest.raises(ValueError):
            training.choose_rows(spark.range(1), "gbt", Series("id"), percent)
