"""Pearson correlation that yields null (not an ANSI divide error, not NaN)
when a variance is zero. Pairwise-complete: only rows where both fields are
set take part, as in pandas DataFrame.corr."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_corr(x: str, y: str) -> Column:
    cx, cy = F.col(x), F.col(y)
    both_x = F.when(cy.isNotNull(), cx)
    both_y = F.when(cx.isNotNull(), cy)
    return F.try_divide(F.covar_pop(cx, cy), F.stddev_pop(both_x) * F.stddev_pop(both_y))


def self_corr(x: str) -> Column:
    """1.0 for a field with spread, null for a constant or empty one."""
    v = F.var_pop(F.col(x))
    return F.try_divide(v, v)
