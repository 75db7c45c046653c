"""Rounding and exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_round(c: Column, n: int) -> Column:
    """Half-even rounding to n places, by scaling, which is how array libraries round."""
    return F.rint(c * float(10**n)) / float(10**n)


def units(c: Column, n: int) -> Column:
    """c as a whole number of 10**-n: sums of these do not depend on the order of rows."""
    return F.rint(c * float(10**n)).cast("bigint")


def sum_rounded(c: Column, n: int, places: int) -> Column:
    """Aggregate: the sum of values of n decimals, rounded half-even to fewer places; null values are left out."""
    return F.coalesce(F.rint(F.sum(units(c, n)) / float(10 ** (n - places))) / float(10**places), F.lit(0.0))


def mean_rounded(c: Column, n: int, places: int) -> Column:
    """Aggregate: the mean of values of n decimals, rounded half-even."""
    return F.rint(F.sum(units(c, n)) / F.count(c) / float(10**n) * float(10**places)) / float(10**places)
