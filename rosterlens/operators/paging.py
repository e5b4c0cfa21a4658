"""Top-k and paging over a sorted result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows in ``order`` (planned as TakeOrderedAndProject:
    each task keeps its own top n, so memory is bounded by n)."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[Column | str], page_no: int = 0, size: int = 20,
         where: Column | str | None = None) -> DataFrame:
    """One page of a filtered, sorted table. ``order`` should end in columns
    that make it total, or pages may overlap."""
    if where is not None:
        df = df.where(where)
    return df.orderBy(*order).offset(page_no * size).limit(size)


def after(order: Sequence[tuple[str, bool]], last: Sequence) -> Column:
    """Whether a row comes after one whose sort keys are ``last``, in ``order``:
    (column, ascending) pairs, nulls first when ascending and last when not."""
    same, out = F.lit(True), F.lit(False)
    for (name, ascending), value in zip(order, last):
        c = F.col(name)
        if ascending:
            later = c.isNotNull() if value is None else c > F.lit(value)
        else:
            later = F.lit(False) if value is None else c.isNull() | (c < F.lit(value))
        out = out | (same & F.coalesce(later, F.lit(False)))
        same = same & c.eqNullSafe(F.lit(value))
    return out


def page_after(df: DataFrame, order: Sequence[tuple[str, bool]], last: Sequence | None = None, size: int = 20,
               where: Column | str | None = None) -> DataFrame:
    """The page that follows a row with the sort keys ``last`` (None: the first
    page): rows up to there are filtered out, so each task keeps ``size`` rows
    however far the page is. ``order`` must be total, as (column, ascending)."""
    if where is not None:
        df = df.where(where)
    if last is not None:
        df = df.where(after(order, last))
    return df.orderBy(*(F.col(c).asc() if up else F.col(c).desc() for c, up in order)).limit(size)
