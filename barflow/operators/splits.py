"""Row subsets by time order and by reproducible hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from barflow.functions.timeline import chunk_of, floor_div, from_micros, is_ntz, micros
from barflow.operators.scan import before_each
from barflow.series import Series
from barflow.session import stage

HASHES = 1 << 32  # values of the key hash
HASH_RANGE = 1 << 16  # hashes per range: 65,536 ranges
TIME_RANGES = 1 << 16  # ranges of time counted in one pass


def _counted(df: DataFrame, position: Column, at: Column, descending: bool = False) -> DataFrame:
    """Rows per position, the least and greatest ``at`` of them, rows before it and rows in all.

    The unpartitioned windows see one row per position (chunk, range of times or of hashes), not the data.
    """
    counts = df.groupBy(position.alias("_pos")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_low"), F.max(at).alias("_high")
    )
    order = F.col("_pos").desc() if descending else F.col("_pos").asc()
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns({
        "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
        "_total": F.sum("_n").over(Window.partitionBy()),
    })


def _holding(counted: DataFrame, wanted) -> Row | None:
    """The position in which the ``wanted``-th row lies; one row reaches the driver."""
    before = F.col("_before")
    return counted.where((before < wanted) & (wanted <= before + F.col("_n"))).first()


def _chunks(df: DataFrame, series: Series, descending: bool = False) -> DataFrame:
    at = micros(df, series.ts)
    return _counted(df, chunk_of(at, series), at, descending)


def _ranges(df: DataFrame, series: Series, spot: Row, descending: bool = False) -> DataFrame:
    """Counts of up to 65,536 equal ranges of the times in ``spot``.

    Its rows are found by a range over the time column, so that the scan can skip the rest.
    """
    ntz, ts, at = is_ntz(df, series.ts), F.col(series.ts), micros(df, series.ts)
    low, high = spot["_low"], spot["_high"]
    inside = df.where((ts >= from_micros(F.lit(low), ntz)) & (ts <= from_micros(F.lit(high), ntz)))
    return _counted(inside, floor_div(at - F.lit(low), (high - low) // TIME_RANGES + 1), at, descending)


def _first_rows(df: DataFrame, fraction: float, series: Series, descending: bool) -> DataFrame:
    """The first ``int(rows * fraction)`` rows by time; rows of one time are ordered by key hash, then key.

    Counting jobs find the cut: rows per chunk, then per range of times in the one chunk or range with the
    cut until that is a single time (one job for bars, three for any microseconds), then per hash range at
    that time. The result is a filter on the time column; only the rows of one hash range are ranked.
    Neither the table nor the result is sorted.
    """
    if fraction >= 1:
        return df
    spot = _holding(_chunks(df, series, descending), (F.col("_total") * F.lit(float(fraction))).cast("long"))
    if spot is None:
        return df.where(F.lit(False))
    take = int(spot["_total"] * float(fraction)) - spot["_before"]
    while spot["_low"] < spot["_high"]:
        spot = _holding(_ranges(df, series, spot, descending), take)
        take -= spot["_before"]
    ts, at = F.col(series.ts), from_micros(F.lit(spot["_low"]), is_ntz(df, series.ts))
    clear = df.where(ts > at if descending else ts < at)
    if take == spot["_n"]:
        return clear.unionByName(df.where(ts == at))
    tied = df.where(ts == at).withColumn("_hash", key_hash(df, series))
    place = floor_div(F.col("_hash"), HASH_RANGE)
    spot = _holding(_counted(tied, place, F.col("_hash")), take)
    order = Window.partitionBy(series.ts).orderBy("_hash", *series.keys)
    last = tied.where(place == spot["_pos"]).withColumn("_rank", F.row_number().over(order))
    last = last.where(F.col("_rank") <= take - spot["_before"]).drop("_rank")
    return clear.unionByName(tied.where(place < spot["_pos"]).unionByName(last).drop("_hash"))


def oldest_fraction(df: DataFrame, percent: float, series: Series, by_series: bool = False) -> DataFrame:
    """The oldest ``percent`` of all rows, or of the rows of each series."""
    return (_first_of_each if by_series else _first_rows)(df, percent / 100.0, series, descending=False)


def newest_fraction(df: DataFrame, percent: float, series: Series, by_series: bool = False) -> DataFrame:
    """The newest ``percent`` of all rows, or of the rows of each series."""
    return (_first_of_each if by_series else _first_rows)(df, percent / 100.0, series, descending=True)


# --- one cut per series ---------------------------------------------------------------------------

def _spots(df: DataFrame, series: Series, choose: Callable[[DataFrame], DataFrame], descending: bool) -> DataFrame:
    """For every series the time ``_low`` that ``choose`` picks, a stored table of one row per series.

    All series are narrowed in the same counting jobs: rows per chunk, then per range of times inside the one spot
    of each series, until every spot is a single time. ``choose`` gets the counted positions of all series, with the
    series' rows before each and its rows in all, and keeps one position of each.
    """
    keys, at = list(series.keys), micros(df, series.ts)
    place = chunk_of(at, series)
    counts = df.groupBy(*keys, (-place if descending else place).alias("_pos")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_low"), F.max(at).alias("_high")
    )
    counts = stage(counts, "positions")  # one row per chunk, read by the scan and for the totals
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    counted = before_each(counts, keys, "_pos", series.chunk_group, sums={"_before": "_n"}).join(totals, keys)
    spots = stage(choose(counted).drop("_pos"), "spots")
    while spots.where(F.col("_low") < F.col("_high")).limit(1).count():
        renamed = spots.select(*keys, *(F.col(c).alias("_spot" + c) for c in ("_low", "_high", "_before", "_total")))
        inside = df.select(*keys, at.alias("_time")).join(renamed, keys).where(F.col("_time").between(F.col("_spot_low"), F.col("_spot_high")))
        width = F.call_function("div", F.col("_spot_high") - F.col("_spot_low"), F.lit(TIME_RANGES)) + 1
        reach = F.col("_spot_high") - F.col("_time") if descending else F.col("_time") - F.col("_spot_low")
        ranges = inside.groupBy(*keys, F.call_function("div", reach, width).alias("_pos")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_time").alias("_low"), F.max("_time").alias("_high"),
            F.first("_spot_before").alias("_offset"), F.first("_spot_total").alias("_total"),
        )
        # at most 65,537 ranges of a series
        earlier = Window.partitionBy(*keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
        counted = ranges.withColumn("_before", F.col("_offset") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        spots = stage(choose(counted).drop("_pos", "_offset"), "spots")
    return spots


def _first_of_each(df: DataFrame, fraction: float, series: Series, descending: bool) -> DataFrame:
    """The first ``int(rows * fraction)`` rows of each series by time.

    Counting jobs find the cut time of every series; the cuts are joined by series. Of rows repeated at the very cut
    time of a series, those with the smaller hash of all columns stay: only these rows are ranked.
    """
    if not series.keys:
        return _first_rows(df, fraction, series, descending)
    if fraction >= 1:
        return df
    take, before = (F.col("_total") * F.lit(float(fraction))).cast("long"), F.col("_before")
    spots = _spots(df, series, lambda c: c.where((before < take) & (take <= before + F.col("_n"))), descending)
    cuts = spots.select(*series.keys, F.col("_low").alias("_cut"), (take - before).alias("_take"), "_n")
    at, cut = micros(df, series.ts), F.col("_cut")
    joined = df.join(cuts, list(series.keys))
    clear = joined.where((at > cut if descending else at < cut) | ((at == cut) & (F.col("_take") == F.col("_n"))))
    tied = joined.where((at == cut) & (F.col("_take") < F.col("_n")))
    order = Window.partitionBy(*series.keys).orderBy(F.xxhash64(*df.columns))
    tied = tied.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.col("_take"))
    return clear.select(*df.columns).unionByName(tied.select(*df.columns))


def split_time(df: DataFrame, share: float, series: Series) -> Column:
    """The last time whose percent rank, (rows before it) / (rows - 1), is at most ``share``.

    Counting jobs: rows per chunk, then per range of times where the split lies, until that is a single time.
    """
    def last_at_most(counted, before: int, total: int | None):
        n = F.col("_total") if total is None else F.lit(total)
        rank = F.when(n > 1, (F.col("_before") + before) / (n - 1)).otherwise(F.lit(0.0))
        return counted.where(rank <= share).orderBy(F.col("_before").desc()).first()

    spot = last_at_most(_chunks(df, series), 0, None)
    if spot is None:
        raise ValueError("cannot split a table without rows")
    before, total = spot["_before"], spot["_total"]
    while spot["_low"] < spot["_high"]:
        spot = last_at_most(_ranges(df, series, spot), before, total)
        before += spot["_before"]
    return from_micros(F.lit(spot["_low"]), is_ntz(df, series.ts))


def time_split(
    df: DataFrame, share: float, series: Series, by_series: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test): train holds the rows whose percent rank by time is at most ``share``.

    The rank is taken over all rows, or with ``by_series`` over the rows of each series.
    """
    if by_series and series.keys:
        return _split_each(df, share, series)
    at, ts = split_time(df, share, series), F.col(series.ts)
    return df.where(ts <= at), df.where(ts > at)


def _split_each(df: DataFrame, share: float, series: Series) -> tuple[DataFrame, DataFrame]:
    keys, n = list(series.keys), F.col("_total")
    rank = F.when(n > 1, F.col("_before") / (n - 1)).otherwise(F.lit(0.0))

    def last_at_most(counted: DataFrame) -> DataFrame:
        spot = F.struct("_low", "_high", "_before", "_total")
        return counted.where(rank <= share).groupBy(*keys).agg(F.max_by(spot, "_before").alias("_spot")).select(*keys, "_spot.*")

    cuts = _spots(df, series, last_at_most, False).select(*keys, F.col("_low").alias("_cut"))
    at = micros(df, series.ts)
    joined = df.join(cuts, keys)
    return (joined.where(at <= F.col("_cut")).select(*df.columns), joined.where(at > F.col("_cut")).select(*df.columns))


def key_hash(df: DataFrame, series: Series, *salt: Column) -> Column:
    """32 bits from the row key: the same for a row whatever the partitioning or the engine."""
    parts = [F.col(k).cast("string") for k in series.keys]
    text = F.concat_ws("|", *parts, micros(df, series.ts).cast("string"), *salt)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_place(df: DataFrame, series: Series, seed: int = 42) -> Column:
    """A number in [0, 1) from the row key and the seed, in steps of 2**-32."""
    return key_hash(df, series, F.lit(str(seed))) / F.lit(float(HASHES))


def random_split(
    df: DataFrame, share: float, series: Series, seed: int = 42, mode: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """(train, test). ``mode="bernoulli"`` is Spark's own split, which depends on the partitioning."""
    if mode == "bernoulli":
        train, test = df.randomSplit([share, 1 - share], seed)
        return train, test
    low = hash_place(df, series, seed) < F.lit(float(share))
    return df.where(low), df.where(~low)


def stratified_split(
    df: DataFrame, label: str, shares: float | dict[int, float], series: Series, seed: int = 42, mode: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with a share per class, or one share for classes 0 and 1.

    Rows of classes without a share go to test.
    """
    if not isinstance(shares, dict):
        shares = {0: shares, 1: shares}
    if mode == "bernoulli":
        train = df.sampleBy(label, shares, seed)
        return train, holdout(df, train, list(series.row_key))
    bound = F.lit(0.0)
    for value, share in shares.items():
        bound = F.when(F.col(label) == value, F.lit(float(share))).otherwise(bound)
    low = hash_place(df, series, seed) < bound
    return df.where(low), df.where(~low)


def holdout(df: DataFrame, train: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``train``; rows with a null key are always held out."""
    return df.join(train.select(*on), on, "left_anti")
