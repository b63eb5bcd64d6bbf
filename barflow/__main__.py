"""Jobs from the command line: ``python -m barflow JOB ...`` or ``spark-submit barflow/__main__.py JOB ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from barflow.operators.features import REQUIRED, complete_rows, drop_stats
from barflow.operators.gapfill import FROM_AUX, MISSING, fill_stats
from barflow.operators.models import NAMES
from barflow.operators.profiles import class_distribution, null_profile
from barflow.operators.runs import FRACTIONS, REPORT_FRACTION, REPORT_WORKERS, WORKERS
from barflow.plans import prepare, reports, resume, scoring, training
from barflow.series import LABEL, Bars, Series
from barflow.session import build_session, passing_stages, stage
from barflow.sources import schemas, tables
from barflow.sources.runs import append_run, read_run_matrix


def _read(spark: SparkSession, args, schema) -> DataFrame:
    read = tables.read_parquet if args.format == "parquet" else tables.read_csv
    return read(spark, args.input, schema)


def _write(df: DataFrame, args) -> None:
    if args.format == "parquet":
        tables.write_parquet(df, args.output)
    else:
        tables.write_csv(df, args.output, args.single_file)


def _finish(before: DataFrame, after: DataFrame, args) -> None:
    """Rows before and after, the classes of the output, and the output; both tables are staged."""
    print(f"rows read: {before.count()}, rows written: {after.count()}")
    class_distribution(after, LABEL).show()
    _write(after, args)


def fill(spark, args, series):
    """The sources are CSV in any case; each is parsed once. Malformed cells are printed apart from empty ones."""
    raw_aux = stage(tables.require(spark, args.aux, schemas.raw_aux(series.keys), checked=True), "aux")
    primary = stage(tables.load_bars(spark, args.input, keys=series.keys, checked=True), "primary")
    for read, schema in ((primary, schemas.raw_bars(keys=series.keys)), (raw_aux, schemas.raw_aux(series.keys))):
        tables.bad_cells(read, schema).where("bad_rows > 0").show(truncate=False)
    raw_aux, primary = raw_aux.drop(tables.BAD, tables.FILE), primary.drop(tables.BAD, tables.FILE)
    tables.load_profile(primary, series.ts, Bars().all).show(truncate=False)
    tables.aux_counts(raw_aux).show()
    aux = tables.aux_bars(raw_aux, keys=series.keys)
    if args.state:
        flagged, after = resume.resume_fill(primary, aux, resume.read_state(spark, args.state), series, flags=True)
    else:
        flagged = stage(prepare.fill_bars(primary, aux, series, flags=True), "filled")
    fill_stats(flagged).show(truncate=False)
    null_profile(flagged, Bars().all).show(truncate=False)
    _write(flagged.drop(MISSING, FROM_AUX), args)
    if args.state:
        resume.write_state(after, args.state)


def features(spark, args, series):
    filled = _read(spark, args, schemas.filled_bars(keys=series.keys))
    everything = stage(prepare.all_features(filled, series), "features")
    drop_stats(everything, REQUIRED).show()
    table = complete_rows(everything)
    class_distribution(table, LABEL).show()
    _write(table, args)


def scale(spark, args, series):
    table = stage(_read(spark, args, schemas.feature_table(keys=series.keys)), "features")
    _finish(table, stage(prepare.scale_features(table, series), "scaled"), args)


def lr_features(spark, args, series):
    table = stage(_read(spark, args, schemas.feature_table(keys=series.keys)), "features")
    _finish(table, stage(prepare.build_lr_features(table, series), "lr"), args)


def profile(spark, args, series):
    table = _read(spark, args, schemas.feature_table(keys=series.keys))
    tables.write_csv(reports.yearly_profile(table, series.ts), args.output, single_file=True)


def train(spark, args, series):
    layout = schemas.lr_table if args.model == "lr" else schemas.scaled_table
    table = stage(_read(spark, args, layout(keys=series.keys)), "train")
    outcome = training.train(table, args.model, series, args.data_percentage)
    append_run(outcome.frame(), args.output)
    if args.store:
        scoring.save_model(spark, scoring.StoredModel(outcome.model, args.model, outcome.columns, LABEL), args.store)


def score(spark, args, series):
    """Predictions of a stored model for any table with its inputs; the probability is that of class 1."""
    stored = scoring.load_model(spark, args.stored)
    layout = schemas.lr_table if stored.kind == "lr" else schemas.scaled_table
    scored = scoring.score(_read(spark, args, layout(keys=series.keys)), stored, series.row_key)
    _write(scored.withColumn("probability", F.col("probability")[1]), args)


def compare(spark, args, series):
    found = reports.compare_runs(
        read_run_matrix(spark, args.input), args.workers, args.fractions, args.at_workers, args.at_fraction
    )
    for name, report in found.items():
        tables.write_csv(report, f"{args.output.rstrip('/')}/{name}", single_file=True)


JOBS = {
    "fill": fill, "features": features, "scale": scale, "lr-features": lr_features, "profile": profile,
    "train": train, "score": score, "compare": compare,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="barflow")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in JOBS:
        job = jobs.add_parser(name)
        job.add_argument("--input", required=True)
        job.add_argument("--output", required=True)
        job.add_argument("--keys", nargs="*", default=[], help="leading columns that name the series")
        job.add_argument("--chunk-steps", type=int, default=Series.chunk_steps, help="steps per ordered chunk")
        if name == "fill":
            job.add_argument("--aux", required=True)
            job.add_argument("--state", help="folder from which appended bars go on, and where the next run does")
        if name == "score":
            job.add_argument("--stored", required=True, help="folder of a model that train --store wrote")
        if name in ("fill", "features", "scale", "lr-features", "score"):
            job.add_argument("--single-file", action="store_true", help="one CSV file")
        if name != "compare":
            job.add_argument("--format", choices=["csv", "parquet"], default="csv", help="of tables passed between jobs")
        if name == "compare":
            job.add_argument("--workers", type=int, nargs="*", default=list(WORKERS), help="listed cluster sizes")
            job.add_argument("--fractions", type=int, nargs="*", default=list(FRACTIONS), help="listed percentages of the data")
            job.add_argument("--at-workers", type=int, default=REPORT_WORKERS, help="cluster size of the reports by fraction")
            job.add_argument("--at-fraction", type=int, default=REPORT_FRACTION, help="percentage of the reports by workers")
        if name == "train":
            job.add_argument("--model", choices=list(NAMES), required=True)
            job.add_argument("--store", help="folder for the fitted model")
            job.add_argument("--data-percentage", type=float, help="share of the rows to use, 0-100")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    series = Series(keys=tuple(args.keys), chunk_steps=args.chunk_steps)
    spark = build_session(f"barflow {args.job}")
    with passing_stages(spark):
        JOBS[args.job](spark, args, series)


if __name__ == "__main__":
    main()
