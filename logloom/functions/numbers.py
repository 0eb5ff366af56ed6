"""Exact decimal ratios and means."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole(number: Column) -> Column:
    """A count or integer sum as a decimal, so that dividing keeps 18 decimals."""
    return number.cast("decimal(20,0)")


def share(part: Column, total: Column) -> Column:
    """100 * part / total, not rounded; NULL where the total is zero."""
    return whole(part * 100) / F.nullif(whole(total), F.lit(0))


def pct(part: Column, total: Column) -> Column:
    return F.round(share(part, total), 2)


def mean(total: Column, count: Column, digits: int = 2) -> Column:
    """total / count, rounded half away from zero; NULL where the count is zero."""
    return F.round(whole(total) / F.nullif(whole(count), F.lit(0)), digits)


def mean_of(values: Column, digits: int = 2) -> Column:
    """Mean of an integer column as an aggregate, ignoring NULL."""
    return mean(F.sum(values), F.count(values), digits)
