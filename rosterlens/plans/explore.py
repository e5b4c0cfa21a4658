"""Data behind the dashboard: top-k lists, filtered class reports, the long
explorer table with paging, the correlation matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.text import matches_ci
from rosterlens.operators.correlation import corr_matrix
from rosterlens.operators.paging import page, page_after, top_n
from rosterlens.plans import reports
from rosterlens.plans.model import Relations
from rosterlens.schema import (
    CORRELATION_COLUMNS,
    EXCLUDED_CLASS_PATTERN,
    EXPLORER_PAGE_SIZE,
    EXPLORER_SLICES,
    TOP_CLASSES,
    TOP_RACES,
    TOP_SUBCLASSES,
)


def top_classes(rels: Relations, n: int = TOP_CLASSES) -> DataFrame:
    """D1."""
    return top_n(reports.class_popularity(rels), [F.desc("character_count"), "class"], n)


def top_races(rels: Relations, n: int = TOP_RACES) -> DataFrame:
    """D2."""
    return top_n(reports.race_popularity(rels), [F.desc("character_count"), "race"], n)


def maxed_sorted(rels: Relations) -> DataFrame:
    """D3."""
    return reports.maxed_stats(rels, ordered=True)


def dump_sorted(rels: Relations) -> DataFrame:
    """D4."""
    return reports.dump_stats(rels, ordered=True)


def top_subclasses(rels: Relations, n: int = TOP_SUBCLASSES) -> DataFrame:
    """The n classes whose top subclass is most common."""
    return top_n(reports.top_subclass_per_class(rels), [F.desc("subclass_count"), "class"], n)


def _not_excluded(pattern: str) -> Column:
    # A null class is kept (the pattern test counts as false).
    return ~F.coalesce(matches_ci("class", pattern), F.lit(False))


def notes_filtered(rels: Relations, pattern: str = EXCLUDED_CLASS_PATTERN) -> DataFrame:
    """Notes summary without excluded classes, by average descending."""
    return reports.class_notes_summary(rels).where(_not_excluded(pattern)).orderBy(F.desc("avg_notes_len"), "class")


def multiclass_filtered(rels: Relations, pattern: str = EXCLUDED_CLASS_PATTERN) -> DataFrame:
    """Multiclass rate without excluded classes, in R9's order."""
    return reports.multiclass_rate_by_class(rels, ordered=True).where(_not_excluded(pattern))


_REPORTS = {
    "class_popularity": reports.class_popularity,
    "race_popularity": reports.race_popularity,
    "class_notes_summary": reports.class_notes_summary,
    "multiclass_rate_by_class": lambda r: reports.multiclass_rate_by_class(r, ordered=False),
    "maxed_stats": reports.maxed_stats,
    "dump_stats": reports.dump_stats,
    "top_subclass_per_class": reports.top_subclass_per_class,
}


def explorer_union(rels: Relations) -> DataFrame:
    """The report slices stacked as (metric, category, count double). Each
    report is one branch of the union and emits all of its slices itself."""
    slices: dict[str, list] = {}
    for metric, report, cat, val in EXPLORER_SLICES:
        slices.setdefault(report, []).append(F.struct(
            F.lit(metric).alias("metric"), F.col(cat).alias("category"), F.col(val).cast("double").alias("count")))
    parts = [_REPORTS[report](rels).select(F.inline(F.array(*cells))) for report, cells in slices.items()]
    return reduce(DataFrame.unionByName, parts)


def explorer_page(rels: Relations, where: Column | str | None = None, order=None, page_no: int = 0,
                  size: int = EXPLORER_PAGE_SIZE) -> DataFrame:
    """Filter, sort and page the explorer table (ties broken by metric,
    then category, so pages do not overlap)."""
    order = list(order) if order else [F.desc("count")]
    return page(explorer_union(rels), order + ["metric", "category"], page_no, size, where)


EXPLORER_ORDER = [("count", False), ("metric", True), ("category", True)]


def explorer_after(rels: Relations, last=None, where: Column | str | None = None, size: int = EXPLORER_PAGE_SIZE) -> DataFrame:
    """D9 by cursor: the page after the row with (count, metric, category) ``last``."""
    return page_after(explorer_union(rels), EXPLORER_ORDER, last, size, where)


def correlation_matrix(rels: Relations) -> DataFrame:
    """Pearson matrix of the nine numeric fields, long form, 2 decimals."""
    return corr_matrix(rels.character, CORRELATION_COLUMNS)


kpi_cards = reports.kpi_cards  # D11
