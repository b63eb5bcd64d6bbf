"""Price expressions. Each takes columns, and a window where it looks at other rows."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

# Fixed value: weight of the squared open-to-close log ratio, with five digits.
GK_OPEN_CLOSE_WEIGHT = 0.38629


def log_ratio(a: Column, b: Column) -> Column:
    """ln(a / b); null where b is zero or the ratio is not positive."""
    return F.ln(F.try_divide(a, b))


def log_return(price: Column, w: WindowSpec) -> Column:
    return log_ratio(price, F.lag(price, 1).over(w))


def trailing_mean(value: Column, w: WindowSpec, n: int) -> Column:
    """Mean of the n rows before this one; fewer at the head of a series, null on its first row."""
    return F.avg(value).over(w.rowsBetween(-n, -1))


def trailing_std(value: Column, w: WindowSpec, n: int) -> Column:
    """Sample deviation of the n rows before this one; null below two values."""
    return F.stddev_samp(value).over(w.rowsBetween(-n, -1))


def relative_deviation(value: Column, reference: Column) -> Column:
    return F.try_divide(value - reference, reference)


def garman_klass(open_: Column, high: Column, low: Column, close: Column) -> Column:
    hl, co = log_ratio(high, low), log_ratio(close, open_)
    return F.lit(0.5) * hl * hl - F.lit(GK_OPEN_CLOSE_WEIGHT) * co * co


def direction(value: Column, future: Column) -> Column:
    """1 where the future value is above this one; ties and unknown futures are 0."""
    return F.when(future > value, F.lit(1)).otherwise(F.lit(0))


def value_at(value: Column, w: WindowSpec, offset: int) -> Column:
    """The value of the row whose order position is exactly ``offset`` away; null where there is none."""
    return F.max(value).over(w.rangeBetween(offset, offset))
