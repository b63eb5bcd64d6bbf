"""Times the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Queries write to Spark's no-op sink,
so all rows and columns are computed; each runs five times and the fastest run counts. ``fit_*`` are
seconds of one model fit on the minute feature table.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from barflow.operators import profiles, splits
from barflow.operators.models import NAMES
from barflow.plans import prepare, training
from barflow.plans.reports import yearly_profile
from barflow.series import base_features, lr_features
from barflow.session import configure, stage
from checks import fixture as X
from checks.fixture import BARS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STEP = "minute"


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def main() -> None:
    spark, times, s = session(), {}, X.series(STEP)

    def clock(name, build):
        runs = []
        for _ in range(5):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)

    primary = stage(X.primary(spark, SF_DIR, STEP), "primary")
    aux = stage(X.auxiliary(spark, SF_DIR, STEP), "aux")
    clock("fill_bars", lambda: prepare.fill_bars(primary, aux, s, BARS))
    clock("bars_to_features", lambda: prepare.bars_to_features(primary, aux, s, BARS, X.horizon(STEP)))
    filled = stage(prepare.fill_bars(primary, aux, s, BARS), "filled")
    clock("build_features", lambda: prepare.build_features(filled, s, BARS, X.horizon(STEP)))
    features = stage(prepare.build_features(filled, s, BARS, X.horizon(STEP)), "features")
    clock("scale_features", lambda: prepare.scale_features(features, s))
    clock("lr_features", lambda: prepare.build_lr_features(features, s, BARS))
    clock("period_profile", lambda: yearly_profile(features, "ts", BARS, "day"))
    clock("class_distribution", lambda: profiles.class_distribution(features, "Target"))
    clock("oldest_fraction", lambda: splits.oldest_fraction(features, 25, s))
    clock("time_split", lambda: splits.time_split(features, 0.8, s)[0])
    clock("random_split", lambda: splits.random_split(features, 0.8, s)[0])
    lagged = stage(prepare.build_lr_features(features, s, BARS), "lr")
    scaled = stage(prepare.scale_features(features, s), "scaled")
    for kind in NAMES:
        columns = (lr_features if kind == "lr" else base_features)(BARS)
        outcome = training.train(lagged if kind == "lr" else scaled, kind, s, columns=columns, bars=BARS)
        times[f"fit_{kind}"] = round(outcome.record["time_seconds"], 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")), "rows": features.count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
