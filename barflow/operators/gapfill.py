"""Dense time grids and gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barflow.functions.timeline import floor_div, from_micros, is_ntz, micros
from barflow.operators.chunks import AT, CHUNK, chunk_window, owned, single_times, spread
from barflow.operators.scan import GROUP, before_each, group_of
from barflow.series import Bars, Series
from barflow.session import shuffle_width

MISSING, FROM_AUX = "was_missing", "from_aux"


def _expand(chunks: DataFrame, series: Series, extra: list[Column] = ()) -> DataFrame:
    """One row per step from rows of (keys, chunk, first, last).

    Only the short chunk rows are shuffled; the steps appear behind the shuffle, where the rows to be
    joined to them arrive.
    """
    width = shuffle_width(chunks.sparkSession)
    return chunks.repartition(width, *series.keys, CHUNK).select(
        *series.keys, CHUNK, *extra,
        F.explode(F.sequence(F.col("_first"), F.col("_last"), F.lit(series.step_us))).alias(AT),
    )


def time_grid(df: DataFrame, series: Series) -> DataFrame:
    """Every step from the first to the last time of each series, both included."""
    keys = list(series.keys)
    step, span = series.step_us, series.span_us
    ntz = is_ntz(df, series.ts)
    ends = (
        df.select(*keys, micros(df, series.ts).alias(AT))
        .groupBy(*keys).agg(F.min(AT).alias("_lo"), F.max(AT).alias("_hi"))
        .where(F.col("_lo").isNotNull())
        .withColumn("_hi", F.col("_hi") - F.pmod(F.col("_hi") - F.col("_lo"), F.lit(step)))
    )
    chunks = ends.select(
        "*", F.explode(F.sequence(floor_div(F.col("_lo"), span), floor_div(F.col("_hi"), span))).alias(CHUNK)
    )
    return _expand(_clip(chunks, series, 0, 0), series).select(*keys, from_micros(F.col(AT), ntz).alias(series.ts))


def _clip(chunks: DataFrame, series: Series, back: int, ahead: int) -> DataFrame:
    """First and last step of each chunk with its margins, inside the series' own range."""
    step, span = series.step_us, series.span_us
    start = F.col(CHUNK) * F.lit(span) + F.pmod(F.col("_lo"), F.lit(step))
    return (
        chunks.withColumn("_first", F.greatest(F.col("_lo"), start - back * step))
        .withColumn("_last", F.least(F.col("_hi"), start + (span - step) + ahead * step))
        .where(F.col("_first") <= F.col("_last"))
    )


def align_to_grid(df: DataFrame, grid: DataFrame, series: Series) -> DataFrame:
    """All grid rows with the matching rows of ``df``; off-grid rows vanish, duplicates fan out."""
    return grid.join(df, list(series.row_key), "left")


def coalesce_sources(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    """Per column the first known value of (own, ``prefix`` + own); the prefixed columns go."""
    filled = df.withColumns({c: F.coalesce(F.col(c), F.col(prefix + c)) for c in cols})
    return filled.drop(*(prefix + c for c in cols))


def fill_from(df: DataFrame, aux: DataFrame, series: Series, cols: list[str], prefix: str = "aux_") -> DataFrame:
    """Fill nulls of ``cols`` from the row of ``aux`` with the same keys and time."""
    other = aux.select(*series.row_key, *(F.col(c).alias(prefix + c) for c in cols))
    return coalesce_sources(df.join(other, list(series.row_key), "left"), cols, prefix)


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})


def forward_fill(df: DataFrame, cols: list[str], series: Series) -> DataFrame:
    """Replace nulls by the last known value before them, for each column on its own.

    Fills inside time chunks; what enters a chunk comes from a two-level scan over one row per chunk.
    """
    keys = list(series.keys)
    placed = spread(df, micros(df, series.ts), series.step_us, series.chunk_steps)
    last_known = placed.groupBy(*keys, CHUNK).agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(AT))).alias(c) for c in cols)
    )
    entering = before_each(
        last_known, keys, CHUNK, series.chunk_group, lasts={f"_in_{i}": c for i, c in enumerate(cols)}
    ).drop(*cols)
    running = chunk_window(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in cols})
    joined = inside.join(entering, [*keys, CHUNK], "left")
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_in_{i}")) for i, c in enumerate(cols)})
    return filled.select(*df.columns)


def _chunk_seeds(primary, aux, series: Series, bars: Bars, back: int, ahead: int) -> DataFrame:
    """One row per (keys, chunk) of the dense grid with the prices known before its first step.

    Both sources are reduced to one row per (keys, chunk, offset from the step) on the map side; then only
    the offset of the series stays, before anything is ordered by series. The chunk borders used here lie
    ``back`` steps early, where the margin of the chunk begins. With ``series.group_chunks`` last known prices pass
    over groups of chunks, then over the chunks of each group; without it over all chunks of a series.
    """
    keys, step, span = list(series.keys), series.step_us, series.span_us
    prices = bars.prices

    def observed(df, own: bool):
        return df.select(
            *keys, micros(df, series.ts).alias(AT), *prices, F.lit(1 if own else 0).cast("long").alias("_own")
        )

    at = F.col(AT)
    # at equal times the primary source wins
    latest = "max_by(`{c}`, IF(`{c}` IS NOT NULL, _at * 2 + _own, NULL)) AS _v{i}"
    latest_at = "max(_at) FILTER (WHERE `{c}` IS NOT NULL) AS _t{i}"
    summary = (
        observed(primary, True).unionByName(observed(aux, False))
        .groupBy(*keys, floor_div(at + back * step, span).alias("_slot"), F.pmod(at, F.lit(step)).alias("_phase"))
        .agg(
            *(F.expr(line.format(c=c, i=i)) for i, c in enumerate(prices) for line in (latest, latest_at)),
        )
    )
    lo = F.col("_lo")
    ends = (
        primary.select(*keys, micros(primary, series.ts).alias(AT)).where(at.isNotNull()).groupBy(*keys)
        .agg(F.min(AT).alias("_lo"), F.max(AT).alias("_hi"))
        .withColumn("_phase", F.pmod(lo, F.lit(step)))
        # by offset too: joined by keys alone, all off-grid rows of a series would meet in one task
        .repartition(shuffle_width(primary.sparkSession), *keys, "_phase")
    )
    # off-grid times may have as many offsets as rows: they go before chunks are put in order
    found = (_seeds_by_series if series.group_chunks is None else _seeds_by_group)(summary, ends, series, back, len(prices))
    return _clip(found, series, back, ahead).select(*keys, CHUNK, "_first", "_last", *(f"_seed{i}" for i in range(len(prices))))


def _seeds_by_series(summary: DataFrame, ends: DataFrame, series: Series, back: int, prices: int) -> DataFrame:
    """Every chunk with its seeds, from one ordered pass over a series' chunks that have values."""
    keys, step, span = list(series.keys), series.step_us, series.span_us
    lo, hi, slot = F.col("_lo"), F.col("_hi"), F.col("_slot")
    bounded = (
        summary.join(ends, [*keys, "_phase"])
        .where(slot >= floor_div(lo + back * step, span))
        .withColumn("_hi", hi - F.pmod(hi - lo, F.lit(step)))
        # values seen only before the series begins are not carried into it
        .withColumns({f"_v{i}": F.expr(f"IF(_t{i} >= _lo, _v{i}, NULL)") for i in range(prices)})
    )
    ordered = Window.partitionBy(*keys).orderBy("_slot")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    final = floor_div(hi, span)
    carried = bounded.withColumns({
        **{f"_v{i}": F.last(f"_v{i}", ignorenulls=True).over(running) for i in range(prices)},
        "_from": F.when(F.lag("_slot").over(ordered).isNull(), floor_div(lo, span)).otherwise(slot + 1),
        "_to": F.least(F.coalesce(F.lead("_slot").over(ordered), final), final),
    }).where(F.col("_from") <= F.col("_to"))
    chunks = carried.withColumn(CHUNK, F.explode(F.sequence("_from", "_to")))
    return chunks.select("*", *(F.expr(f"IF({CHUNK} > _slot, _v{i}, NULL) AS _seed{i}") for i in range(prices)))


def _seeds_by_group(summary: DataFrame, ends: DataFrame, series: Series, back: int, prices: int) -> DataFrame:
    """The same from two levels: what enters each group of chunks, then, inside the group, each chunk."""
    keys, step, span = list(series.keys), series.step_us, series.span_us
    lo, hi, slot = F.col("_lo"), F.col("_hi"), F.col("_slot")
    first, final, group, n = floor_div(lo, span), floor_div(hi, span), series.group_chunks, range(prices)
    values = (
        summary.join(ends, [*keys, "_phase"])
        .where((slot >= floor_div(lo + back * step, span)) & (slot <= final))
        # values seen only before the series begins are not carried into it
        .select(*keys, group_of(slot, group).alias(GROUP), slot.alias(CHUNK),
                *(F.expr(f"IF(_t{i} >= _lo, _v{i}, NULL)").alias(f"_v{i}") for i in n))
    )
    totals = values.groupBy(*keys, GROUP).agg(
        *(F.expr(f"max_by(_v{i}, IF(_v{i} IS NOT NULL, {CHUNK}, NULL))").alias(f"_g{i}") for i in n)
    )
    groups = ends.select(*keys, "_lo", (hi - F.pmod(hi - lo, F.lit(step))).alias("_hi"),
                         F.explode(F.sequence(floor_div(first, group), floor_div(final, group))).alias(GROUP))
    earlier = Window.partitionBy(*keys).orderBy(GROUP).rowsBetween(Window.unboundedPreceding, -1)
    entered = groups.join(totals, [*keys, GROUP], "left").select(
        *keys, GROUP, "_lo", "_hi", *(F.last(f"_g{i}", ignorenulls=True).over(earlier).alias(f"_g{i}") for i in n)
    ).repartition(shuffle_width(summary.sparkSession), *keys, GROUP)
    start = F.col(GROUP) * group
    chunks = entered.select("*", F.explode(F.sequence(
        F.greatest(first, start), F.least(floor_div(F.col("_hi"), span), start + (group - 1)))).alias(CHUNK))
    inside = Window.partitionBy(*keys, GROUP).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return chunks.join(values, [*keys, GROUP, CHUNK], "left").withColumns({
        f"_seed{i}": F.coalesce(F.last(f"_v{i}", ignorenulls=True).over(inside), F.col(f"_g{i}")) for i in n
    })


def dense_chunks(
    primary: DataFrame,
    aux: DataFrame,
    series: Series,
    bars: Bars = Bars(),
    back: int = 0,
    ahead: int = 0,
    duplicates: str = "error",
) -> DataFrame:
    """Filled bars on the dense grid, still in chunks and with ``back`` / ``ahead`` steps of margin.

    Each source is shuffled once, the grid not at all, and windows over (keys, chunk) add no shuffle.
    ``duplicates``: "error" rejects repeated times of a series, "keep" lets them fan out.
    """
    if duplicates not in ("error", "keep"):
        raise ValueError("duplicates must be 'error' or 'keep'")
    keys = list(series.keys)
    prices = bars.prices
    seeds = [f"_seed{i}" for i in range(len(prices))]

    def source(df, prefix):
        placed = spread(
            df.select(*series.row_key, *bars.all),
            micros(df, series.ts), series.step_us, series.chunk_steps, back, ahead,
        )
        return placed.select(*keys, CHUNK, AT, *(F.col(c).alias(prefix + c) for c in bars.all))

    first_only = [F.col("_first"), *map(F.col, seeds)]
    grid = _expand(_chunk_seeds(primary, aux, series, bars, back, ahead), series, first_only)
    on = [*keys, CHUNK, AT]
    rows = grid.join(source(primary, "p_"), on, "left").join(source(aux, "a_"), on, "left")

    w = chunk_window(keys)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    price = "last(coalesce(`p_{c}`, `a_{c}`, IF(_at = _first, {s}, NULL)), true)"
    columns = {
        **{c: F.expr(price.format(c=c, s=s)).over(running) for c, s in zip(prices, seeds)},
        **{c: F.expr(f"coalesce(`p_{c}`, `a_{c}`, 0.0D)") for c in bars.volumes},
    }
    missing = f"`p_{bars.open}` IS NULL"
    filled = rows.select(
        *keys, CHUNK, AT, *(columns[c].alias(c) for c in bars.all),
        F.expr(f"{missing} AS {MISSING}"),
        F.expr(f"{missing} AND `a_{bars.open}` IS NOT NULL AS {FROM_AUX}"),
        F.lag(AT).over(w).alias("_previous"),
    )
    return single_times(filled) if duplicates == "error" else filled.drop("_previous")


def own_rows(chunked: DataFrame, series: Series, ntz: bool) -> DataFrame:
    """Drop the margins and restore the timestamp."""
    kept = [c for c in chunked.columns if c not in (*series.keys, CHUNK, AT)]
    return chunked.where(owned(series.step_us, series.chunk_steps)).select(
        *series.keys, from_micros(F.col(AT), ntz).alias(series.ts), *kept
    )


def fill_stats(flagged: DataFrame) -> DataFrame:
    """Counts and shares of missing, aux-filled and forward-filled rows; shares null if none is missing."""
    missing = F.count_if(F.col(MISSING))
    from_aux = F.count_if(F.col(FROM_AUX))
    counted = flagged.agg(
        F.count(F.lit(1)).alias("rows"), missing.alias("missing"), from_aux.alias("aux_filled"),
        (missing - from_aux).alias("forward_filled"), (missing - from_aux).alias("zero_volume"),
    )
    share = lambda c: F.try_divide(F.col(c) * 100.0, F.col("missing"))
    return counted.withColumns({
        "aux_filled_pct": share("aux_filled"), "forward_filled_pct": share("forward_filled"),
    })
