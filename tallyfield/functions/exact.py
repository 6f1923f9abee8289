"""Repeatable sums for amounts with two decimals.

A double sum depends on the order rows reach the reducer, so a re-run on another cluster
size can flip a HAVING test or a tie.  Points have two decimals by construction; summing
them as whole hundredths in a bigint is exact, associative and stays in codegen (a wide
decimal sum does not).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(c: Column) -> Column:
    return F.rint(c * 100.0).cast("bigint")


def sum2(c: Column) -> Column:
    """Exact sum of a two-decimal amount, as double."""
    return F.sum(hundredths(c)) / F.lit(100.0)


def avg2(c: Column) -> Column:
    """Mean of a two-decimal amount from its exact sum; NULL for no values."""
    return F.sum(hundredths(c)) / F.lit(100.0) / F.nullif(F.count(c), F.lit(0))


def stddev2(c: Column) -> Column:
    """Sample standard deviation of a two-decimal amount from exact moments; NULL for fewer than two values.

    Sums of hundredths and of their squares are integers of up to 38 digits, so the variance is one
    ratio of integers: its bits do not depend on the order of rows or on how they were dealt out.
    """
    n, whole = F.count(c).cast("decimal(19,0)"), hundredths(c).cast("decimal(19,0)")
    total, squares = F.sum(whole).cast("decimal(38,0)"), F.sum(whole * whole)
    above = n * squares - total * total
    return F.sqrt(ratio(above, n * (n - F.lit(1)))) / F.lit(100.0)


def bitmap_bucket(c: Column) -> Column:
    """The bucket of an integer; distinct integers of one bucket fit in one bitmap of 4 KB."""
    return F.bitmap_bucket_number(c.cast("bigint"))


def bitmap_of(c: Column) -> Column:
    """Aggregate: the integers of a group that lies in one bucket, as a bitmap; NULLs are left out.

    ``sum(bitmap_count(...))`` over the buckets is the exact distinct count. It combines map-side,
    and several of them need one pass where ``count_distinct`` copies the rows for each.
    """
    return F.bitmap_construct_agg(F.bitmap_bit_position(c.cast("bigint")))


def ratio(a: Column, b: Column) -> Column:
    """a / b in doubles, NULL when b is zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
