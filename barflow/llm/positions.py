"""Global positions over a table in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barflow.session import shuffle_width, stage

AT = "_at"  # part number and place within the part; grows along the global order
PART = "_part"
PLACES = 33


def laid_out(rows: DataFrame, *order: Column, name: str = "ordered") -> DataFrame:
    """``rows`` sorted by ``order`` over as many parts as the shuffle is wide, stored, with their place ``_at``.

    Rows equal in ``order`` may fill any number of parts: the place they were read from is the last sort key.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(shuffle_width(rows.sparkSession), *order, F.col("_salt"))
    ranged = ranged.sortWithinPartitions(*order, "_salt").drop("_salt")
    return stage(ranged.withColumn(AT, F.monotonically_increasing_id()), name)


def part_of(at: str = AT) -> Column:
    return F.shiftright(F.col(at), PLACES).alias(PART)


def place_of(at: str = AT) -> Column:
    """The row's number within its part, from 0."""
    return F.col(at).bitwiseAND(F.lit((1 << PLACES) - 1))


def part_totals(laid: DataFrame, **sums: Column) -> DataFrame:
    """(_part, rows, rows_before, and each of ``sums`` with its ``…_before``): one row per part.

    The running sums see the parts alone, no more rows than the shuffle is wide.
    """
    totals = laid.groupBy(part_of()).agg(
        F.count(F.lit(1)).alias("rows"), *(F.sum(c).alias(n) for n, c in sums.items())
    )
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({
        f"{n}_before": F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in ("rows", *sums)
    })


def numbered(laid: DataFrame, name: str) -> DataFrame:
    """``laid`` with the row's number in the global order, from 1, instead of its place.

    Broadcast is one row per part, at most the width of the shuffle.
    """
    before = part_totals(laid).select(F.col(PART).alias("_of"), "rows_before")
    joined = laid.join(F.broadcast(before), part_of() == F.col("_of"))
    return joined.withColumn(name, F.col("rows_before") + place_of() + 1).drop("_of", "rows_before", AT)
