"""Physical plans: what is shuffled, what reaches the scan, and that nothing runs in Python."""

import pytest
from pyspark.sql import functions as F

from barflow.operators import features as feat, gapfill as gap, metrics, profiles, splits
from barflow.plans import prepare
from barflow.series import FEATURES
from helpers import BARS, bar, frame, series

S = series()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bars")
    frame(spark, [bar(i, 1.0 + i % 5) for i in range(200)]).write.parquet(path)
    table = spark.read.parquet(path)
    return table.withColumns({c: F.col("close") * 2 for c in FEATURES}).withColumn("Target", F.lit(1))


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    text = plan(df)
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    return text.count("Exchange hashpartitioning"), text.count("Exchange SinglePartition")


def executed(df):
    """Scans and shuffles that ran; those used twice count once."""
    df.collect()
    text = plan(df)
    assert "Python" not in text and "SinglePartition" not in text
    final = text[: text.index("Initial Plan")]
    return final.count("FileScan"), final.count("+- Exchange hashpartitioning")


def test_row_frames_read_and_shuffle_the_rows_once(stored):
    # the rows; of each chunk the last ones, by group of chunks and by series; their copies
    bars = stored.select("sym", "ts", *BARS.all)
    jobs = [prepare.build_features(bars, S, BARS), feat.rolling_std(bars, S, "close"), feat.lag_features(bars, S, "close")]
    assert [executed(job) for job in jobs] == [(1, 4)] * 3


def test_forward_fill_shuffles_rows_once(stored):
    # the rows; one row per chunk, which goes on by group of chunks, by series, and back to both
    scans, moved = executed(gap.forward_fill(stored, ["close"], S))
    assert scans == 2 and moved <= 9


def test_grid_is_not_shuffled(stored):
    text = plan(gap.time_grid(stored, S))
    assert text.count("Exchange hashpartitioning") == 2
    # the steps are generated above the last exchange
    assert text.index("Generate explode(sequence(_first") < text.index("Exchange")


def test_splits_are_filters_on_the_scan(stored):
    for part in (*splits.time_split(stored, 0.8, S), *splits.random_split(stored, 0.8, S)):
        assert shuffles(part) == (0, 0)
    train, test = splits.stratified_split(stored, "Target", {1: 0.5}, S)
    assert shuffles(train) == shuffles(test) == (0, 0)
    assert "PushedFilters: [IsNotNull(ts), LessThan" in plan(splits.oldest_fraction(stored, 25, S))


def test_profiles_read_only_their_columns(stored):
    text = plan(profiles.price_by_period(stored, "ts", "open"))
    assert "ReadSchema: struct<ts:timestamp_ntz,open:double>" in text and "partial_avg" in text


def test_scaling_is_a_projection(stored):
    assert shuffles(prepare.scale_features(stored, S)) == (0, 0)


def test_metrics_aggregate_before_their_shuffle(stored):
    text = plan(metrics.class_metrics(stored.withColumn("prediction", F.lit(1)), "Target"))
    assert "partial_count" in text
