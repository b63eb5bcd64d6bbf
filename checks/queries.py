"""Registered queries. Names match ``checks.sql``."""

from __future__ import annotations

from datetime import timedelta

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from barflow.functions import market
from barflow.functions.timeline import parse_timestamp
from barflow.operators import features as feat, gapfill as gap, metrics, moments, profiles, runs, scaling, splits
from barflow.operators.models import NAMES
from barflow.plans import prepare, resume, scoring, training
from barflow.plans.reports import compare_runs, yearly_profile
from barflow.series import GK, LABEL, Series, base_features, lr_features
from barflow.session import new_path, stage
from barflow.sources import schemas, tables
from barflow.sources.runs import append_run, compact_runs, parse_run_matrix, read_run_matrix, read_runs, runs_frame
from checks import fixture as X
from checks.fixture import BARS, rounded

HOUR, MINUTE = X.series("hour"), X.series("minute")
PRICES, VOLUMES = BARS.prices, BARS.volumes
MODELS = list(runs.MODELS)
EVENTS = Series("ts", ("event_id",), timedelta(minutes=1), 8192)
TYPES = Series("ts", ("event_type",), timedelta(minutes=1), 1 << 20)
ORDERS = Series("o_orderdate", ("o_orderkey",), timedelta(days=1), 64)


# --- grid and gap filling -------------------------------------------------------------------------

def bars_hour(spark, d):
    return rounded(X.whole(spark, d))


def time_grid(spark, d):
    return gap.time_grid(X.whole(spark, d), HOUR)


def time_grid_minute(spark, d):
    return gap.time_grid(X.whole(spark, d, "minute"), MINUTE)


def _aligned(spark, d):
    primary = X.primary(spark, d)
    return gap.align_to_grid(primary, gap.time_grid(primary, HOUR), HOUR)


def _merged(spark, d):
    return gap.fill_from(_aligned(spark, d), X.auxiliary(spark, d), HOUR, BARS.all)


def _aligned_whole(spark, d):
    bars = X.whole(spark, d)
    return gap.align_to_grid(bars, gap.time_grid(bars, HOUR), HOUR)


def align_left_join(spark, d):
    return rounded(_aligned_whole(spark, d))


def aux_coalesce(spark, d):
    return rounded(_merged(spark, d))


def forward_fill(spark, d):
    return rounded(gap.forward_fill(stage(_merged(spark, d)), PRICES, HOUR).select("sym", "ts", *PRICES))


def zero_volume(spark, d):
    return rounded(gap.zero_fill(_merged(spark, d), VOLUMES).select("sym", "ts", *VOLUMES))


def fill_bars(spark, d):
    return rounded(X.filled(spark, d))


def fill_bars_minute(spark, d):
    return rounded(X.filled(spark, d, "minute"))


def fill_bars_off_grid(spark, d):
    """The second source also holds every event at its own time: rows off the grid change nothing."""
    aux = X.auxiliary(spark, d).unionByName(X.off_grid(spark, d))
    return rounded(prepare.fill_bars(X.primary(spark, d), aux, HOUR, BARS))


def _in_parts(spark, d):
    """(bars, state before) of three runs over thirds of the time; the second source is up to two days ahead."""
    primary, aux = stage(X.primary(spark, d)), stage(X.auxiliary(spark, d))
    low, high = primary.agg(F.min("ts"), F.max("ts")).first()
    cuts, state = [low + (high - low) * k / 3 for k in (1, 2)], None
    part = lambda df, cuts, k: df.where(
        (F.lit(True) if k == 0 else F.col("ts") > F.lit(cuts[k - 1])) & (F.lit(True) if k == 2 else F.col("ts") <= F.lit(cuts[k])))
    ahead = [c + timedelta(days=2) for c in cuts]
    for k in range(3):
        before = state
        filled, state = resume.resume_fill(
            part(primary, cuts, k), part(aux, ahead, k), before, HOUR, BARS, resume.history_steps(HOUR, X.horizon("hour")))
        yield filled, before


def fill_bars_in_parts(spark, d):
    first, second, third = (filled for filled, _ in _in_parts(spark, d))
    return rounded(first.unionByName(second).unionByName(third))


def features_in_parts(spark, d):
    first, second, third = (
        resume.resume_features(filled, before, HOUR, BARS, X.horizon("hour")) for filled, before in _in_parts(spark, d))
    return rounded(first.unionByName(second).unionByName(third))


def fill_stats(spark, d):
    return rounded(gap.fill_stats(X.filled(spark, d, flags=True)))


def fill_stats_minute(spark, d):
    return rounded(gap.fill_stats(X.filled(spark, d, "minute", flags=True)))


def null_profile(spark, d):
    return rounded(profiles.null_profile(_aligned_whole(spark, d), BARS.all))


def time_range(spark, d):
    return profiles.time_range(X.whole(spark, d), "ts", ["sym"])


# --- features and label ---------------------------------------------------------------------------

def log_return(spark, d):
    return rounded(feat.log_returns(X.filled(spark, d), HOUR, "close", "log_return").select("sym", "ts", "log_return"))


def rolling_mean_5_10_15(spark, d):
    done = feat.rolling_mean(X.filled(spark, d), HOUR, "close")
    return rounded(done.select("sym", "ts", "Feat_SMA_5", "Feat_SMA_10", "Feat_SMA_15"))


def rolling_std_30(spark, d):
    return rounded(feat.rolling_std(X.filled(spark, d), HOUR, "close").select("sym", "ts", "Feat_Vol_Std"))


def gk_volatility(spark, d):
    gk = market.garman_klass(*(F.col(c) for c in ("open", "high", "low", "close")))
    return rounded(X.filled(spark, d).select("sym", "ts", gk.alias(GK)))


def lag_1_5(spark, d):
    return rounded(feat.lag_features(X.filled(spark, d), HOUR, "close").select(
        "sym", "ts", *(f"Lag_{i}" for i in range(1, 6))))


def lag_rows_with_holes(spark, d):
    """Lags over rows: the bars lack steps."""
    return rounded(feat.lag_features(X.whole(spark, d), HOUR, "close").select(
        "sym", "ts", *(f"Lag_{i}" for i in range(1, 6))))


def label_15(spark, d):
    done = feat.horizon_label(stage(X.filled(spark, d)), HOUR, "close", X.horizon("hour"))
    return rounded(done.select("sym", "ts", "close", "FutureClose", LABEL))


def feature_table(spark, d):
    return rounded(X.features(spark, d))


def feature_table_minute(spark, d):
    return rounded(X.features(spark, d, "minute"))


def feature_table_from_filled(spark, d):
    return rounded(prepare.build_features(X.filled(spark, d), HOUR, BARS, X.horizon("hour")))


def features_with_holes(spark, d):
    """Row frames and the exact-time label on bars that lack steps."""
    return rounded(prepare.build_features(X.whole(spark, d), HOUR, BARS, X.horizon("hour")))


def std_with_holes(spark, d):
    return rounded(feat.rolling_std(X.whole(spark, d), HOUR, "close").select("sym", "ts", "Feat_Vol_Std"))


def drop_stats(spark, d):
    everything = prepare.all_features(X.filled(spark, d), HOUR, BARS, X.horizon("hour"))
    return feat.drop_stats(everything, feat.REQUIRED)


def class_distribution(spark, d):
    return rounded(profiles.class_distribution(X.features(spark, d), LABEL))


# --- scaling and profiles -------------------------------------------------------------------------

def standard_scale(spark, d):
    return rounded(prepare.scale_features(_stored(spark, d), HOUR))


def standard_scale_train_fit(spark, d):
    """Fitted on the training rows only."""
    table = _stored(spark, d)
    train, _ = splits.time_split(table, 0.8, HOUR)
    return rounded(prepare.scale_features(table, HOUR, fit_on=train))


def lr_feature_table(spark, d):
    return rounded(prepare.build_lr_features(_stored(spark, d), HOUR, BARS))


def scaler_fit(spark, d):
    """The fitted means and deviations, one row per column."""
    columns = base_features(BARS)
    fitted = scaling.fit_scaler(X.features(spark, d), columns)
    rows = list(zip(columns, fitted.means, fitted.deviations))
    return rounded(spark.createDataFrame(rows, "column string, mean double, deviation double"))


def _moments_in_parts(spark, d, columns, unit="day"):
    """Moments of three parts of the feature table, stored one by one; the second part is written twice."""
    table, folder = _stored(spark, d), new_path(spark, "moments")
    for k in (0, 1, 2, 1):
        moments.write_moments(moments.moments(table.where(F.hour("ts") % 3 == k), columns, "ts", unit), folder, str(k))
    return moments.read_moments(spark, folder)


def scaler_fit_merged(spark, d):
    """The scaler of the whole table from the moments of its parts."""
    columns = base_features(BARS)
    fitted = moments.scaler_of(moments.merge_moments(_moments_in_parts(spark, d, columns)), columns)
    rows = list(zip(columns, fitted.means, fitted.deviations))
    return rounded(spark.createDataFrame(rows, "column string, mean double, deviation double"))


def period_profile_merged(spark, d):
    """The profile by day from the moments of three parts, none of which holds a whole day."""
    merged = moments.merge_moments(_moments_in_parts(spark, d, [GK, "volume", "open", "close"]), ["day"])
    prices = {f"{kind}_{c}": (c, kind) for c in ("open", "close") for kind in ("avg", "min", "max")}
    measures = {"avg_gk_vol": (GK, "avg"), "total_volume": ("volume", "total"), "avg_volume": ("volume", "avg"), **prices}
    return _by_day(moments.profile_of(merged, "day", measures))


def _by_day(df):
    return rounded(df.withColumn("day", F.col("day").cast("string")))


def period_volatility(spark, d):
    return _by_day(profiles.volatility_by_period(X.features(spark, d), "ts", "day"))


def period_volume(spark, d):
    return _by_day(profiles.volume_by_period(X.features(spark, d), "ts", "day", "volume"))


def period_open(spark, d):
    return _by_day(profiles.price_by_period(X.features(spark, d), "ts", "open", "day"))


def period_close(spark, d):
    return _by_day(profiles.price_by_period(X.features(spark, d), "ts", "close", "day"))


def period_profile(spark, d):
    return _by_day(yearly_profile(X.features(spark, d), "ts", BARS, "day"))


def year_price(spark, d):
    return rounded(profiles.price_by_period(X.table(spark, d, "orders"), "o_orderdate", "o_totalprice"))


def year_volume(spark, d):
    return rounded(profiles.volume_by_period(X.table(spark, d, "lineitem"), "l_shipdate", "year", "l_quantity"))


# --- slices and splits ----------------------------------------------------------------------------

def _stored(spark, d):
    """The feature table as a stored table: slices and splits read it several times."""
    return stage(X.features(spark, d), "features")


def _keys(df):
    return df.select("sym", "ts", LABEL)


def _tagged(train, test):
    return _keys(train).withColumn("part", F.lit("train")).unionByName(_keys(test).withColumn("part", F.lit("test")))


def oldest_fraction(spark, d):
    return _keys(splits.oldest_fraction(_stored(spark, d), 25, HOUR))


def newest_fraction(spark, d):
    return _keys(splits.newest_fraction(_stored(spark, d), 25, HOUR))


def oldest_fraction_by_series(spark, d):
    return _keys(splits.oldest_fraction(_stored(spark, d), 25, HOUR, by_series=True))


def newest_fraction_by_series(spark, d):
    return _keys(splits.newest_fraction(_stored(spark, d), 37.5, HOUR, by_series=True))


def time_split_by_series(spark, d):
    return _tagged(*splits.time_split(_stored(spark, d), 0.8, HOUR, by_series=True))


def time_split_events_by_type(spark, d):
    """Times in microseconds, narrowed for all types in the same jobs."""
    train, test = splits.time_split(X.table(spark, d, "events"), 0.8, TYPES, by_series=True)
    tag = lambda df, part: df.select("event_id", F.lit(part).alias("part"))
    return tag(train, "train").unionByName(tag(test, "test"))


def oldest_orders(spark, d):
    return splits.oldest_fraction(X.table(spark, d, "orders"), 37.5, ORDERS).select("o_orderkey", "o_orderdate")


def newest_orders(spark, d):
    return splits.newest_fraction(X.table(spark, d, "orders"), 37.5, ORDERS).select("o_orderkey", "o_orderdate")


def time_split(spark, d):
    return _tagged(*splits.time_split(_stored(spark, d), 0.8, HOUR))


def oldest_events(spark, d):
    """Times in microseconds, with many different ones in each chunk."""
    return splits.oldest_fraction(X.table(spark, d, "events"), 37.5, EVENTS).select("event_id", "ts")


def time_split_events(spark, d):
    train, test = splits.time_split(X.table(spark, d, "events"), 0.8, EVENTS)
    tag = lambda df, part: df.select("event_id", "ts", F.lit(part).alias("part"))
    return tag(train, "train").unionByName(tag(test, "test"))


def random_split_odd_share(spark, d):
    return _tagged(*splits.random_split(_stored(spark, d), 0.7654, HOUR))


def time_split_orders(spark, d):
    train, test = splits.time_split(X.table(spark, d, "orders"), 0.8, ORDERS)
    keys = ["o_orderkey", "o_orderdate"]
    tag = lambda df, part: df.select(*keys, F.lit(part).alias("part"))
    return tag(train, "train").unionByName(tag(test, "test"))


def stratified_split(spark, d):
    return _tagged(*splits.stratified_split(_stored(spark, d), LABEL, {0: 0.8, 1: 0.6}, HOUR))


def random_split(spark, d):
    return _tagged(*splits.random_split(_stored(spark, d), 0.8, HOUR))


def holdout_anti_join(spark, d):
    table = _stored(spark, d)
    train, _ = splits.time_split(table, 0.8, HOUR)
    return _keys(splits.holdout(table, train, ["sym", "ts"]))


# --- sources --------------------------------------------------------------------------------------

def epoch_parse(spark, d):
    """Auxiliary bars from rows in the raw auxiliary layout, with Unix seconds."""
    raw = X.resample(X.table(spark, d, "events"), "hour").select(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("Timestamp"), F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"), "sym",
    )
    return rounded(tables.aux_bars(raw, BARS, "ts", ["sym"]).withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def pattern_parse(spark, d):
    """Times written as text in the primary layout and parsed back; every fifth one is not a time."""
    events = X.table(spark, d, "events")
    text = F.date_format("ts", "dd-MM-yyyy HH:mm")
    damaged = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(text)
    parsed = parse_timestamp(damaged, "dd-MM-yyyy HH:mm").cast("timestamp_ntz")
    return events.select("event_id", parsed.alias("parsed"))


def csv_round_trip(spark, d):
    """Bars written as CSV in the exchanged layout and loaded with the declared schema."""
    path = new_path(spark, "bars-csv")
    tables.write_csv(_as_text(X.whole(spark, d)), path)
    loaded = tables.load_bars(spark, path, bars=BARS, ts="ts", keys=["sym"])
    return rounded(loaded.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def csv_bad_rows(spark, d):
    """Bars as CSV in which some opens and volumes are no numbers and some closes are empty, counted apart after loading."""
    path, bars = new_path(spark, "bars-bad"), X.whole(spark, d)
    text = lambda c, every, mark: F.when(F.hour("ts") % every == 0, F.lit(mark)).otherwise(F.col(c).cast("string")).alias(c)
    damaged = {"open": text("open", 5, "oops"), "volume": text("volume", 7, "1,5x"), "close": text("close", 3, None)}
    time = F.date_format("ts", "dd-MM-yyyy HH:mm").alias("ts")
    tables.write_csv(bars.select("sym", time, *(damaged.get(c, F.col(c)) for c in BARS.all)), path)
    loaded = stage(tables.load_bars(spark, path, bars=BARS, ts="ts", keys=["sym"], checked=True), "checked")
    counted = tables.bad_cells(loaded, schemas.raw_bars(BARS, "ts", ["sym"]))
    nulls = loaded.agg(*(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("open", "volume", "close")))
    names = ["rows", "bad_rows", "bad_open", "bad_volume", "bad_close", "bad_ts"]
    return counted.agg(*(F.sum(c).alias(c) for c in names)).join(nulls)


def _as_text(bars):
    return bars.select("sym", F.date_format("ts", "dd-MM-yyyy HH:mm").alias("ts"), *BARS.all)


def default_parse(spark, d):
    """Times written as text and parsed without a pattern; every seventh one is not a time."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    damaged = F.when(F.col("event_id") % 7 == 0, F.lit("soon")).otherwise(text)
    return X.table(spark, d, "events").select("event_id", parse_timestamp(damaged).cast("timestamp_ntz").alias("parsed"))


def _raw_aux(spark, d) -> DataFrame:
    """All bars in the raw auxiliary layout; the volume is zero in every fourth hour and null in the next."""
    hour = F.hour("ts") % 4
    volume = F.when(hour == 0, F.lit(0.0)).when(hour > 1, F.col("volume"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return X.whole(spark, d).select("sym", seconds.alias("Timestamp"), F.col("open").alias("Open"), F.col("high").alias("High"),
                                    F.col("low").alias("Low"), F.col("close").alias("Close"), volume.alias("Volume"))


def aux_csv(spark, d):
    path = new_path(spark, "aux-csv")
    tables.write_csv(_raw_aux(spark, d), path)
    loaded = tables.load_aux_bars(spark, path, BARS, "ts", ["sym"])
    return rounded(loaded.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def aux_counts(spark, d):
    return tables.aux_counts(_raw_aux(spark, d))


def zero_prices(spark, d):
    """Returns and volatility are null where a price is zero: here the close of every fifth hour."""
    close = F.when(F.hour("ts") % 5 == 0, F.lit(0.0)).otherwise(F.col("close"))
    done = feat.log_returns(X.whole(spark, d).withColumn("close", close), HOUR, "close", "log_return")
    gk = market.garman_klass(*(F.col(c) for c in ("open", "high", "low", "close")))
    return rounded(done.select("sym", "ts", "log_return", gk.alias(GK)))


def scale_nulls_and_constant(spark, d):
    """Rows without a volume go; a constant column scales to zero."""
    volume = F.when(F.hour("ts") % 6 != 0, F.col("volume")).alias("volume")
    table = _stored(spark, d).select("sym", "ts", LABEL, volume, "close", F.lit(7.0).alias("flat"))
    return rounded(prepare.scale_features(table, HOUR))


def month_price(spark, d):
    done = profiles.price_by_period(X.table(spark, d, "orders"), "o_orderdate", "o_totalprice", "month")
    return rounded(done.withColumn("month", F.col("month").cast("string")))


def weighted_three_classes(spark, d):
    scored = X.table(spark, d, "orders").select(
        (F.col("o_orderkey") % 3).cast("int").alias(LABEL), (F.col("o_custkey") % 3).cast("int").alias("prediction")
    )
    return rounded(metrics.summary_metrics(metrics.class_metrics(scored, LABEL)))


def load_profile(spark, d):
    aligned = _aligned_whole(spark, d)
    return tables.load_profile(aligned, "ts", ["open", "volume"])


# --- evaluation -----------------------------------------------------------------------------------

def _rule(spark, d) -> DataFrame:
    """A deterministic stand-in for a model: up where the price is above its short mean."""
    score = F.round("Feat_SMA_5", 6)
    return X.features(spark, d).select("sym", "ts", LABEL, score.alias("score"), (score > 0).cast("int").alias("prediction"))


def confusion_matrix(spark, d):
    return metrics.confusion(_rule(spark, d), LABEL)


def confusion_metrics(spark, d):
    return rounded(metrics.class_metrics(_rule(spark, d), LABEL).select("label", "precision", "recall", "f1", "support"))


def weighted_metrics(spark, d):
    return rounded(metrics.summary_metrics(metrics.class_metrics(_rule(spark, d), LABEL)))


def auc_roc(spark, d):
    value = metrics.auc_roc(_rule(spark, d), "score", LABEL)
    return rounded(spark.createDataFrame([(value,)], "auc_roc double"))


def auc_roc_one_class(spark, d):
    """The rule on rows of one class: there is no area."""
    value = metrics.auc_roc(_rule(spark, d).where(F.col(LABEL) == 1), "score", LABEL)
    return spark.createDataFrame([(value,)], "auc_roc double")


def auc_roc_ties(spark, d):
    """Scores with many ties and without some: the priority of orders against their status."""
    orders = X.table(spark, d, "orders")
    score = F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_custkey") % 13).cast("double")).alias("score")
    label = (F.col("o_totalprice") > 150000).cast("int").alias("label")
    return rounded(spark.createDataFrame([(metrics.auc_roc(orders.select(score, label), "score", "label"),)], "auc_roc double"))


def score_stored_model(spark, d):
    """A stored and reloaded model scores every row as the fitted one did; rows that lack an input have no score."""
    table = stage(prepare.scale_features(_stored(spark, d), HOUR), "scaled")
    columns = base_features(BARS)
    fitted = training.train(table, "lr", HOUR, columns=columns, bars=BARS)
    path = new_path(spark, "model")
    scoring.save_model(spark, scoring.StoredModel(fitted.model, "lr", fitted.columns, LABEL), path)
    holes = table.withColumn("volume", F.when(F.hour("ts") % 6 != 0, F.col("volume")))
    after = scoring.score(holes, scoring.load_model(spark, path), ["sym", "ts"])
    before = fitted.model.transform(table).select("sym", "ts", vector_to_array("probability").alias("p"))
    both = after.join(before, ["sym", "ts"])
    return both.select("sym", "ts", F.col("prediction").isNotNull().alias("scored"), (F.col("probability") == F.col("p")).alias("same"))


def run_log_round_trip(spark, d):
    """The record of the rule, appended to a log twice and read back."""
    scored = _rule(spark, d)
    outcome = training.run_record("gbt", 0, 0.0, scored, LABEL, ["score"])
    path = new_path(spark, "runs")
    for _ in range(2):
        append_run(runs_frame(spark, [outcome]), path)
    report = F.col("classification_report")
    line = lambda name, key, out: report[name][key].alias(out)
    return rounded(read_runs(spark, path).select(
        "model", "rows", "accuracy", "majority_share", "predicted_share",
        line("0", "precision", "precision_0"), line("1", "recall", "recall_1"), line("1", "support", "support_1"),
        line("weighted avg", "f1-score", "weighted_f1"), line("weighted avg", "support", "support"),
    ))


def run_log_three_classes(spark, d):
    """A record with three classes, appended to a log, merged into one file and read back: a row per class."""
    scored = X.table(spark, d, "orders").select(
        (F.col("o_orderkey") % 3).cast("int").alias(LABEL), (F.col("o_custkey") % 3).cast("int").alias("prediction")
    )
    outcome = training.run_record("rf", 0, 0.0, scored, LABEL, ["score"])
    path, merged = new_path(spark, "runs"), new_path(spark, "runs-merged")
    append_run(runs_frame(spark, [outcome]), path)
    append_run(runs_frame(spark, [outcome | {"model": "other"}]), path)
    compact_runs(spark, path, merged)
    lines = read_runs(spark, merged).select("model", "accuracy", F.explode("classification_report").alias("line", "m"))
    return rounded(lines.select(
        "model", "accuracy", "line", F.col("m.precision").alias("precision"), F.col("m.recall").alias("recall"),
        F.col("m")["f1-score"].alias("f1"), F.col("m.support").alias("support"),
    ))


def vector_scale(spark, d):
    """The library scaler on assembled vectors, unpacked to columns: the same as ``standard_scale``."""
    columns = base_features(BARS)
    assembled = scaling.assemble(_stored(spark, d), columns, "raw", "skip").select("sym", "ts", LABEL, "raw")
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    done = scaler.fit(assembled).transform(assembled).drop("raw")
    return rounded(scaling.unpack_vector(done, "scaled", columns))


def _train(kind, percent=None):
    def query(spark, d):
        table = _stored(spark, d)
        if kind == "lr":
            table = prepare.build_lr_features(table, HOUR, BARS)
        else:
            table = prepare.scale_features(table, HOUR)
        columns = (lr_features if kind == "lr" else base_features)(BARS)
        table = stage(table)
        done = training.train(table, kind, HOUR, percent, columns=columns, bars=BARS, certify=True)
        report, upward = done.record["classification_report"], vector_to_array("probability")[1]
        scored = done.predictions.select("prediction", upward.alias("p"))
        wrong = scored.where((F.col("prediction") == 1) != (F.col("p") > 0.5)).count()
        row = {
            "model": done.record["model"], "rows": done.record["rows"],
            "support_0": report["0"]["support"], "support_1": report["1"]["support"],
            "support": report["weighted avg"]["support"], "majority_share": done.record["majority_share"],
            "recall_is_accuracy": abs(report["weighted avg"]["recall"] - done.record["accuracy"]) < 1e-9,
            "prediction_follows": wrong == 0, "learnt": _learnt(done.certificate),
            "optimal": done.certificate["gradient"] < 1e-3 if kind == "lr" else None,
        }
        return rounded(spark.createDataFrame([row], "model string, rows long, support_0 long, support_1 long, support long, "
                                                    "majority_share double, recall_is_accuracy boolean, prediction_follows boolean, "
                                                    "learnt string, optimal boolean"))
    query.__name__ = f"train_{kind}" + (f"_{percent}_percent" if percent else "")
    return query


def _learnt(fit: dict) -> str:
    """What lowered the training log-loss: the inputs, by a tenth at least, or the base rate alone."""
    if fit["log_loss"] < 0.9 * fit["base_log_loss"]:
        return "inputs"
    return "base rate" if fit["spread"] < 1e-3 and fit["bias"] < 0.02 else "nothing"


# --- run comparison -------------------------------------------------------------------------------

def _matrix_text(spark, d, workers=None, fractions=(25, 50, 75, 100)) -> DataFrame:
    """A nested run document whose entries are aggregates of the feature table.

    The day, or ``workers``, stands in for the cluster size, the hour for the share of data, three rules for the models.
    """
    table = X.features(spark, d).select(
        LABEL, "volume", (F.dayofmonth("ts") % 3 + 2 if workers is None else F.lit(workers)).alias("workers"), F.hour("ts").alias("hour"),
        *(F.round(f"Feat_SMA_{n}", 6).alias(f"s{n}") for n in (5, 10, 15)),
    )
    rules = F.array(*(
        F.struct(F.lit(m).alias("model"), (F.col(f"s{n}") > 0).cast("int").alias("up")) for m, n in zip(MODELS, (5, 10, 15))
    ))
    fractions = F.filter(F.array(*map(F.lit, fractions)), lambda f: F.col("hour") * 100 < f * 24)
    long = table.withColumn("fraction", F.explode(fractions)).select("*", F.inline(rules))
    hit = (F.col("up") == F.col(LABEL)).cast("int")
    entries = (
        long.where(~((F.col("model") == MODELS[2]) & (F.col("fraction") == 75)))
        .groupBy("workers", "fraction", "model")
        .agg(
            F.count("*").alias("rows"), (F.sum(F.round("volume", 2)) / 1000).alias("seconds"),
            F.avg(hit).alias("hit"), F.avg("up").alias("up"), F.avg(LABEL).alias("ones"),
        )
    )
    average = F.struct(
        F.col("up").alias("precision"), F.col("hit").alias("recall"), F.col("ones").alias("f1-score"),
        F.col("rows").alias("support"),
    )
    run = F.struct(
        F.col("model"), F.col("rows"), F.col("seconds").alias("time_seconds"), F.col("hit").alias("accuracy"),
        F.struct(average.alias("weighted avg")).alias("classification_report"),
    )
    # at most 3 x 4 x 3 entries, whatever the size of the table
    lists = entries.groupBy("workers", "fraction").agg(F.sort_array(F.collect_list(run)).alias("entries"))
    inner = lists.groupBy("workers").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat(F.col("fraction").cast("string"), F.lit("%")), "entries"))).alias("fractions"))
    outer = inner.agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat(F.col("workers").cast("string"), F.lit("_workers")), "fractions"))).alias("doc"))
    return outer.select(F.to_json("doc").alias("value"))


def _matrix(spark, d) -> DataFrame:
    return parse_run_matrix(_matrix_text(spark, d))


def run_matrix_file(spark, d):
    """The nested document written to a file and read back."""
    path = new_path(spark, "matrix")
    _matrix_text(spark, d).write.text(path)
    return rounded(runs.flatten_runs(read_run_matrix(spark, path)).drop("position"))


def flatten_runs(spark, d):
    return rounded(runs.flatten_runs(_matrix(spark, d)).drop("position"))


def time_by_workers(spark, d):
    return rounded(runs.report_time_by_workers(runs.flatten_runs(_matrix(spark, d))))


def accuracy_by_fraction(spark, d):
    return rounded(runs.report_accuracy_by_fraction(runs.flatten_runs(_matrix(spark, d))))


def time_by_fraction(spark, d):
    return rounded(runs.report_time_by_fraction(runs.flatten_runs(_matrix(spark, d))))


def recall_by_model(spark, d):
    return rounded(runs.report_recall(runs.flatten_runs(_matrix(spark, d))))


def _eight_workers(spark, d, report):
    """Reports on runs with 8 workers and half of the data only."""
    matrix = parse_run_matrix(_matrix_text(spark, d, 8, (50,)))
    return rounded(compare_runs(matrix, workers=(8, 16), fractions=(50,), at_workers=8, at_fraction=50)[report])


def time_of_eight_workers(spark, d):
    return _eight_workers(spark, d, "time_by_workers")


def accuracy_of_eight_workers(spark, d):
    return _eight_workers(spark, d, "accuracy_by_fraction")


def recall_of_eight_workers(spark, d):
    return _eight_workers(spark, d, "recall_by_model")


def registered() -> dict:
    plain = [
        bars_hour, time_grid, time_grid_minute, align_left_join, aux_coalesce, forward_fill, zero_volume, fill_bars,
        fill_bars_minute, fill_stats, fill_stats_minute, null_profile, time_range, log_return, rolling_mean_5_10_15,
        rolling_std_30, gk_volatility, lag_1_5, lag_rows_with_holes, label_15, feature_table, feature_table_minute,
        feature_table_from_filled, drop_stats, class_distribution, standard_scale, standard_scale_train_fit, scaler_fit,
        lr_feature_table, period_volatility, period_volume, period_open, period_close, period_profile, year_price,
        year_volume, oldest_fraction, newest_fraction, oldest_orders, newest_orders, time_split, time_split_orders,
        stratified_split, random_split, holdout_anti_join, epoch_parse, pattern_parse, csv_round_trip, load_profile,
        confusion_matrix, confusion_metrics, weighted_metrics, auc_roc, run_log_round_trip, vector_scale, flatten_runs, time_by_workers,
        accuracy_by_fraction, time_by_fraction, recall_by_model, fill_bars_off_grid, features_with_holes,
        std_with_holes, oldest_events, time_split_events, random_split_odd_share, run_matrix_file, default_parse,
        aux_csv, aux_counts, zero_prices, scale_nulls_and_constant, month_price, weighted_three_classes,
        oldest_fraction_by_series, newest_fraction_by_series, time_split_by_series, time_split_events_by_type,
        run_log_three_classes, time_of_eight_workers, accuracy_of_eight_workers, recall_of_eight_workers,
        fill_bars_in_parts, features_in_parts, scaler_fit_merged, period_profile_merged, csv_bad_rows,
        auc_roc_one_class, auc_roc_ties, score_stored_model,
    ]
    return {q.__name__: q for q in [*plain, *map(_train, NAMES), _train("gbt", 50), _train("lr", 50)]}
