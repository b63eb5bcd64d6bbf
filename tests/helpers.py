"""Small literal tables and plain reference computations."""

from datetime import datetime, timedelta

from barflow.series import Bars, Series

BARS = Bars("open", "high", "low", "close", "volume", "turnover", "wprice")
START = datetime(2024, 3, 10, 1, 0)
SCHEMA = "sym string, ts {kind}, open double, high double, low double, close double, volume double, turnover double, wprice double"


def series(chunk_steps=40, keys=("sym",)):
    return Series("ts", keys, timedelta(minutes=1), chunk_steps)


def at(minute):
    return START + timedelta(minutes=minute)


def bar(minute, price, volume=1.0, sym="a", **changes):
    row = dict(sym=sym, ts=at(minute), open=price, high=price, low=price, close=price, volume=volume,
               turnover=None if volume is None or price is None else volume * price, wprice=price)
    row.update(changes)
    return tuple(row.values())


def frame(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, SCHEMA.format(kind=kind))


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def assert_same(left, right):
    """The same bag of rows; doubles to nine decimals."""
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    flat = lambda df: sorted(
        (tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )
    assert flat(left) == flat(right)
