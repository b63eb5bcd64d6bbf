"""Prefix scans over chunk summaries on two levels: chunks inside a group, then whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barflow.functions.timeline import floor_div

GROUP = "_group"


def group_of(position: Column, group: int) -> Column:
    return floor_div(position, group)


def before_each(
    summary: DataFrame, keys: list[str], position: str, group: int, sums: dict[str, str] = {}, lasts: dict[str, str] = {}
) -> DataFrame:
    """``summary``, one row per (keys, ``position``), with what the rows before each row add up to.

    ``sums`` and ``lasts`` give the new column and the column it is made from: the sum (0 where there is no earlier row)
    or the last value that is not null. Both combine associatively, so rows are scanned in groups of ``group``
    positions, and one total per group is scanned by series. A task thus sees at most ``group`` rows, or one row per
    group: with the square root of the positions as ``group`` neither exceeds it.
    """
    place = F.col(position)
    placed = summary.withColumn(GROUP, group_of(place, group))
    totals = placed.groupBy(*keys, GROUP).agg(
        *(F.sum(c).alias(f"_total_{n}") for n, c in sums.items()),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_total_{n}") for n, c in lasts.items()),
    )
    groups = Window.partitionBy(*keys).orderBy(GROUP).rowsBetween(Window.unboundedPreceding, -1)
    entering = totals.select(
        *keys, GROUP, *(F.sum(f"_total_{n}").over(groups).alias(f"_in_{n}") for n in sums),
        *(F.last(f"_total_{n}", ignorenulls=True).over(groups).alias(f"_in_{n}") for n in lasts),
    )
    inside = Window.partitionBy(*keys, GROUP).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    scanned = placed.withColumns({
        **{n: F.sum(c).over(inside) for n, c in sums.items()},
        **{n: F.last(c, ignorenulls=True).over(inside) for n, c in lasts.items()},
    }).join(entering, [*keys, GROUP], "left")
    none = F.lit(0).cast("long")
    return scanned.withColumns({
        **{n: F.coalesce(F.col(n), none) + F.coalesce(F.col(f"_in_{n}"), none) for n in sums},
        **{n: F.coalesce(F.col(n), F.col(f"_in_{n}")) for n in lasts},
    }).drop(GROUP, *(f"_in_{n}" for n in (*sums, *lasts)))
