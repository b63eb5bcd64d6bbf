"""Scaling, profiles, splits, sources."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from barflow.operators import profiles, scaling, splits
from barflow.plans import prepare
from barflow.plans.reports import yearly_profile
from barflow.series import Bars, Series, base_features
from barflow.sources import schemas, tables
from helpers import BARS, assert_same, at, bar, frame, rows, series

S = series()


# --- scaling ---

def test_scaling_matches_the_library_scaler_and_keeps_names(spark):
    from pyspark.ml.feature import StandardScaler

    df = spark.createDataFrame([(i, float(i % 5), float(i * i)) for i in range(20)], "id long, x double, y double")
    ours = scaling.standard_scale(df, ["x", "y"])
    vector = scaling.assemble(df, ["x", "y"], "v")
    fitted = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vector).transform(vector)
    assert_same(ours, scaling.unpack_vector(fitted.select("id", "s"), "s", ["x", "y"]))


def test_constant_column_scales_to_zero_and_fit_rows_may_differ(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (11.0, 7.0)], "x double, c double")
    out = scaling.standard_scale(df, ["x", "c"], fit_on=df.where("x < 5"))
    assert rows(out, "x") == [(pytest.approx(-1 / math.sqrt(2)), 0.0), (pytest.approx(1 / math.sqrt(2)), 0.0),
                              (pytest.approx(9 / math.sqrt(2)), 0.0)]
    with pytest.raises(ValueError, match="without rows"):
        scaling.fit_scaler(df.limit(0), ["x"])


def test_scale_features_drops_null_rows_and_orders_columns(spark):
    df = frame(spark, [bar(0, 1.0), bar(1, None), bar(2, 3.0)]).withColumn("Target", F.lit(1))
    out = prepare.scale_features(df, S)
    assert out.count() == 2 and out.columns[:3] == ["sym", "ts", "Target"]
    assert prepare.scale_features(df.withColumnRenamed("Target", "target"), S).columns == out.columns


# --- profiles ---

def test_null_profile_and_class_distribution(spark):
    df = spark.createDataFrame([(1, None, 0), (2, None, 0), (None, 1.0, 1), (4, 1.0, 0)], "a int, b double, t int")
    assert rows(profiles.null_profile(df, ["a", "b"])) == [("a", 1, 25.0), ("b", 2, 50.0)]
    assert rows(profiles.class_distribution(df, "t")) == [(0, 3, 0.75), (1, 1, 0.25)]
    assert profiles.row_count(df).first()[0] == 4
    assert rows(profiles.null_profile(df.limit(0), ["a"])) == [("a", 0, None)]


def test_period_profiles(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1), 1.0, 2.0), (datetime(2020, 6, 1), 3.0, 4.0), (datetime(2021, 2, 1), 5.0, None)],
        "ts timestamp_ntz, p double, v double",
    )
    assert rows(profiles.price_by_period(df, "ts", "p")) == [(2020, 2.0, 1.0, 3.0), (2021, 5.0, 5.0, 5.0)]
    assert rows(profiles.volume_by_period(df, "ts", col="v")) == [(2020, 6.0, 3.0), (2021, None, None)]
    assert rows(profiles.volatility_by_period(df, "ts", "month_of_year", "p")) == [(1, 1.0), (2, 5.0), (6, 3.0)]
    assert profiles.price_by_period(df, "ts", "p", "day").orderBy("day").first()[0] == date(2020, 1, 1)
    with pytest.raises(ValueError):
        profiles.price_by_period(df, "ts", "p", "decade")


def test_yearly_profile_is_one_pass(spark):
    df = frame(spark, [bar(i, 1.0 + i) for i in range(5)]).withColumn("Feat_GK_Vol", F.col("close"))
    out = yearly_profile(df, "ts", BARS)
    assert tuple(out.first()) == (2024, 3.0, 5.0, 1.0, 3.0, 1.0, 5.0, 3.0, 1.0, 5.0)


# --- slices and splits ---

@pytest.fixture(scope="module")
def many(spark):
    """Uneven: a third of all rows share one time."""
    df = spark.range(3000).select(
        F.concat(F.lit("k"), F.col("id")).alias("sym"),
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 997).alias("m"), (F.col("id") % 2).cast("int").alias("t"),
    )
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn("ts", start + F.expr("make_dt_interval(0, 0, m)")).cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("percent", [0.01, 10, 45.5, 70, 99.99, 100])
def test_fractions_equal_row_number(many, percent, descending):
    s = series(16)
    cut = splits.newest_fraction if descending else splits.oldest_fraction
    order = F.col("ts").desc() if descending else F.col("ts")
    w = Window.orderBy(order, splits.key_hash(many, s), "sym")
    n = int(3000 * (percent / 100))
    assert_same(cut(many, percent, s), many.withColumn("n", F.row_number().over(w)).where(F.col("n") <= n).drop("n"))


def test_fraction_zero_and_no_keys(spark):
    df = frame(spark, [bar(i, 1.0) for i in range(10)]).drop("sym")
    s = series(4, keys=())
    assert splits.oldest_fraction(df, 0, s).count() == 0
    assert [r["ts"] for r in splits.oldest_fraction(df, 30, s).orderBy("ts").collect()] == [at(0), at(1), at(2)]
    assert [r["ts"] for r in splits.newest_fraction(df, 19, s).collect()] == [at(9)]


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_time_split_equals_percent_rank(many, share):
    train, test = splits.time_split(many, share, series(16))
    ranked = many.withColumn("pr", F.percent_rank().over(Window.orderBy("ts")))
    assert_same(train, ranked.where(F.col("pr") <= share).drop("pr"))
    assert_same(test, ranked.where(F.col("pr") > share).drop("pr"))


def test_time_split_of_ten_and_of_one_row(spark):
    s = series(4, keys=())
    df = frame(spark, [bar(i, 1.0) for i in range(10)]).drop("sym")
    train, test = splits.time_split(df, 0.8, s)
    assert (train.count(), test.count()) == (8, 2)
    train, test = splits.time_split(df.limit(1), 0.8, s)
    assert (train.count(), test.count()) == (1, 0)
    with pytest.raises(ValueError):
        splits.time_split(df.limit(0), 0.8, s)


def test_time_cut_reaches_the_scan(spark, tmp_path):
    frame(spark, [bar(i, 1.0) for i in range(50)]).write.parquet(str(tmp_path / "t"))
    train, _ = splits.time_split(spark.read.parquet(str(tmp_path / "t")), 0.8, S)
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts" in plan and "SinglePartition" not in plan


def test_hash_split_does_not_depend_on_partitioning(spark, many):
    train, test = splits.random_split(many, 0.8, S)
    again, _ = splits.random_split(many.repartition(13, "t"), 0.8, S)
    assert_same(train, again)
    assert train.count() + test.count() == 3000 and train.join(test, ["sym", "ts"], "left_semi").count() == 0
    assert 0.77 < train.count() / 3000 < 0.83
    assert splits.random_split(many, 0.8, S, seed=7)[0].exceptAll(train).count() > 0


def test_stratified_split_shares(spark, many):
    train, test = splits.stratified_split(many, "t", {0: 0.8, 1: 0.3}, S)
    shares = {r["t"]: r["n"] / 1500 for r in train.groupBy("t").agg(F.count("*").alias("n")).collect()}
    assert 0.76 < shares[0] < 0.84 and 0.26 < shares[1] < 0.34
    assert train.count() + test.count() == 3000
    only, rest = splits.stratified_split(many, "t", {0: 1.0}, S)
    assert only.count() == 1500 and rest.select("t").distinct().collect()[0][0] == 1


def test_bernoulli_modes_cover_all_rows(many):
    for train, test in (
        splits.random_split(many, 0.8, S, mode="bernoulli"),
        splits.stratified_split(many, "t", 0.8, S, mode="bernoulli"),
    ):
        assert train.count() + test.count() == 3000


def test_holdout_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    assert rows(splits.holdout(df, df.where("k = 'a' or k is null"), ["k"]), "v") == [(None, 2), ("b", 3)]


# --- sources ---

def test_bars_load_with_bad_times_counted(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text(
        "Timestamp,Open,High,Low,Close,Volume_(BTC),Volume_(Currency),Weighted_Price\n"
        "31-12-2011 07:52,4.39,4.39,4.39,4.39,0.45,2.0,4.39\n31-12-2011 07:53,,,,,,,\nnot a time,1,1,1,1,1,1,1\n"
    )
    df = tables.load_bars(spark, str(path))
    assert df.dtypes[0] == ("Timestamp", "timestamp") and df.schema["Open"].dataType.simpleString() == "double"
    profile = tables.load_profile(df, "Timestamp", ["Open"]).first()
    assert profile["rows"] == 3 and profile["bad_ts"] == 1 and profile["null_Open"] == 1
    assert profile["min_ts"] == datetime(2011, 12, 31, 7, 52)


def test_aux_load_filters_and_derives(spark, tmp_path):
    path = tmp_path / "aux.csv"
    path.write_text("Timestamp,Open,High,Low,Close,Volume\n1325317920.0,4,5,3,4.5,2\n1325317980,4,5,3,4.5,0\n1325318040,4,5,3,4.5,\n")
    df = tables.load_aux_bars(spark, str(path))
    row = df.first()
    assert df.count() == 1 and row["Timestamp"] == datetime(2011, 12, 31, 7, 52)
    assert row["Volume_(Currency)"] == 9.0 and row["Weighted_Price"] == 4.5
    raw = tables.read_csv(spark, str(path), schemas.raw_aux())
    assert tuple(tables.aux_counts(raw).first()) == (3, 1)


def test_missing_aux_is_a_readable_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="required source"):
        tables.load_aux_bars(spark, str(tmp_path / "absent.csv"))


def test_csv_sink_round_trip(spark, tmp_path):
    df = frame(spark, [bar(i, 1.5 + i) for i in range(20)], "timestamp").drop("sym").repartition(4)
    many_files, one_file = str(tmp_path / "many"), str(tmp_path / "one")
    tables.write_csv(df, many_files)
    tables.write_csv(df, one_file, single_file=True)
    tables.write_csv(df, one_file, single_file=True)  # overwrites
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1 < len(list((tmp_path / "many").glob("part-*.csv")))
    assert_same(tables.read_csv(spark, one_file, df.schema), df)
    assert tables.read_csv(spark, many_files).count() == 20
    tables.write_parquet(df.withColumn("d", F.to_date("ts")), str(tmp_path / "pq"), ["d"])
    assert_same(tables.read_parquet(spark, str(tmp_path / "pq")).drop("d"), df)


def test_key_columns_come_first(spark, tmp_path):
    path = tmp_path / "aux.csv"
    path.write_text("sym,Timestamp,Open,High,Low,Close,Volume\nx,1325317920,4,5,3,4.5,2\n")
    df = tables.load_aux_bars(spark, str(path), keys=["sym"])
    assert df.columns[:2] == ["sym", "Timestamp"] and df.first()["sym"] == "x"
    assert schemas.lr_table(keys=["sym"]).names[:3] == ["sym", "Timestamp", "Target"]


def test_declared_table_layouts():
    assert schemas.feature_table().names[1:13] == base_features() and len(schemas.lr_table().names) == 19
    assert base_features(Bars())[4:6] == ["Volume_(BTC)", "Volume_(Currency)"]
    with pytest.raises(ValueError):
        Series(step=timedelta(0))
