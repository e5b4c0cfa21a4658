"""The reporting questions (the reference's views and their ordered twins).

Each takes the keyed relations; ``ordered=True`` gives the analysis form
with its ORDER BY. Sort keys get a final tie-breaker so the order is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.numeric import format_count, format_fixed2
from rosterlens.operators import aggregates as agg
from rosterlens.plans.model import Relations
from rosterlens.schema import KPI_CARDS, MAXED_STAT_THRESHOLD, STAT_COLUMNS, TOP_LEVEL


def class_popularity(rels: Relations, ordered: bool = False) -> DataFrame:
    """Distinct characters per class (two subclasses of one class count once)."""
    df = agg.popularity(rels.classes, "class", "char_id", "character_count")
    return df.orderBy(F.desc("character_count"), "class") if ordered else df


def race_popularity(rels: Relations, ordered: bool = False) -> DataFrame:
    """R2: characters per race, race set and not ''."""
    race = F.col("race")
    df = agg.popularity(rels.character, "race", None, "character_count", where=race.isNotNull() & (race != ""))
    return df.orderBy(F.desc("character_count"), "race") if ordered else df


def multiclass_count(rels: Relations) -> DataFrame:
    """Characters with more than one class row."""
    return agg.entities_with_many(rels.classes, "char_id", "multiclass_characters")


def level_20_count(rels: Relations) -> DataFrame:
    """Characters at the top level (one row, 0 when none)."""
    return agg.count_where(rels.character, F.col("total_level") == TOP_LEVEL, "level_20_characters")


def maxed_stats(rels: Relations, ordered: bool = False) -> DataFrame:
    """Per stat, characters with the stat >= 20."""
    df = agg.threshold_counts(rels.character, STAT_COLUMNS, MAXED_STAT_THRESHOLD, "maxed_count")
    return df.orderBy(F.desc("maxed_count"), "stat_name") if ordered else df


def dump_stats(rels: Relations, ordered: bool = False) -> DataFrame:
    """Per stat, characters whose lowest stat it is (ties all counted)."""
    df = agg.argmin_counts(rels.character, STAT_COLUMNS, "dump_count")
    return df.orderBy(F.desc("dump_count"), "stat_name") if ordered else df


def class_notes_summary(rels: Relations, ordered: bool = False) -> DataFrame:
    """Per class, distinct characters with notes, and mean and median
    notes length over the class rows (a character with two rows of a class
    weighs twice, as the join does)."""
    joined = rels.classes.select("char_id", "class").join(
        rels.character.select("char_id", "notes_len").where(F.col("notes_len").isNotNull()), "char_id"
    )
    df = agg.group_summary(joined, "class", "char_id", "notes_len",
                           ("characters", "avg_notes_len", "median_notes_len"))
    return df.orderBy(F.desc("avg_notes_len"), "class") if ordered else df


def top_subclass_per_class(rels: Relations, ordered: bool = False, collation: str | None = None) -> DataFrame:
    """Most common subclass within each class (ties: smallest name, in
    binary order unless a collation such as 'UNICODE' is given)."""
    sub = F.col("subclass")
    df = agg.top_per_group(rels.classes, "class", "subclass", ("most_popular_subclass", "subclass_count"),
                           where=sub.isNotNull() & (sub != ""), collation=collation)
    if ordered:
        df = df.orderBy(F.collate(F.col("class"), collation) if collation else F.col("class"))
    return df


def multiclass_rate_by_class(rels: Relations, ordered: bool = True) -> DataFrame:
    """Per class, characters with it, those with more than one distinct
    class, and the rate in percent (2 decimals, half up)."""
    df = agg.membership_rate(rels.classes, "char_id", "class",
                             ("characters_with_class", "multiclass_characters", "multiclass_rate_pct"))
    if ordered:
        df = df.orderBy(F.desc("multiclass_rate_pct"), F.desc("characters_with_class"), "class")
    return df


def _with_multiclass(rels: Relations, one: DataFrame) -> DataFrame:
    """The one row of ``one`` with R3's count beside it (an equality join of two single rows)."""
    return one.withColumn("_one", F.lit(1)).join(multiclass_count(rels).withColumn("_one", F.lit(1)), "_one").drop("_one")


def dashboard_kpis(rels: Relations) -> DataFrame:
    """Total, level-20 characters and average level in one pass over
    ``character``; multiclass characters as R3 counts them from the class rows."""
    one = rels.character.agg(
        F.count(F.lit(1)).alias("total_characters"),
        F.count_if(F.col("total_level") == TOP_LEVEL).alias("level_20_characters"),
        F.avg("total_level").alias("avg_total_level"),
    )
    return _with_multiclass(rels, one).select(
        "total_characters", "multiclass_characters", "level_20_characters", "avg_total_level")


def kpi_cards(rels: Relations) -> DataFrame:
    """The KPI row formatted for display as (title, value): counts with
    thousands separators, the average level with two decimals."""
    one = _with_multiclass(rels, rels.character.agg(
        F.count(F.lit(1)).alias("total_characters"),
        F.count_if(F.col("total_level") == TOP_LEVEL).alias("level_20_characters"),
        F.sum("total_level").alias("_level_sum"),
        F.count("total_level").alias("_level_n"),
    ))
    values = {
        "total_characters": format_count("total_characters"),
        "multiclass_characters": format_count("multiclass_characters"),
        "level_20_characters": format_count("level_20_characters"),
        "avg_total_level": format_fixed2("_level_sum", "_level_n"),
    }
    cards = F.array(*[F.struct(F.lit(t).alias("title"), values[col].alias("value")) for t, col, _ in KPI_CARDS])
    return one.select(F.inline(cards))
