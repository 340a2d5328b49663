"""Shared arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(n: Column, total: Column, digits: int = 4) -> Column:
    """Share in percent. One division only, so a tie is a tie when it is rounded."""
    return F.round(100 * n / total, digits)


def percent_true(condition: Column, digits: int = 4) -> Column:
    """Share of rows for which a never-NULL condition holds, as an aggregate."""
    return percent(F.count_if(condition), F.count(F.lit(1)), digits)
