"""Generic aggregates behind the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.functions.numeric import exact_rate_pct


def popularity(df: DataFrame, group: str, entity: str | None = None, name: str = "character_count",
               where: Column | None = None) -> DataFrame:
    """Rows (or distinct ``entity`` values) per ``group``. Distinct counting is
    planned as two hash aggregations with the shuffle on (group, entity), so a
    large group is spread over many reducers and pre-aggregated map-side."""
    if where is not None:
        df = df.where(where)
    agg = F.count_distinct(entity) if entity else F.count(F.lit(1))
    return df.groupBy(group).agg(agg.alias(name))


def count_where(df: DataFrame, cond: Column, name: str) -> DataFrame:
    """One row with the number of rows meeting ``cond`` (0 when none)."""
    return df.agg(F.count_if(cond).alias(name))


def entities_with_many(df: DataFrame, entity: str, name: str, more_than: int = 1) -> DataFrame:
    """Number of entities with more than ``more_than`` rows: per-entity counts
    (partial aggregation before the shuffle), then one global count."""
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_rows"))
    return per.agg(F.count_if(F.col("_rows") > more_than).alias(name))


def unpivot_measures(df: DataFrame, ids: Sequence[str], measures: Sequence[str],
                     name_col: str = "stat_name", value_col: str = "stat_value") -> DataFrame:
    """Long form of several measure columns (one scan + Expand). Null values
    are kept, as UNION ALL would."""
    return df.unpivot(list(ids), list(measures), name_col, value_col)


def _stacked(counts: DataFrame, measures: Sequence[str], name: str, name_col: str) -> DataFrame:
    """One-row counts per measure -> (measure, count) rows, zero counts
    dropped (a GROUP BY over matching rows has no row for them)."""
    cells = F.array(*[F.struct(F.lit(m).alias(name_col), F.col(m).alias(name)) for m in measures])
    return counts.select(F.inline(cells)).where(F.col(name) > 0)


def threshold_counts(df: DataFrame, measures: Sequence[str], threshold, name: str,
                     name_col: str = "stat_name") -> DataFrame:
    """Per measure, the rows whose value is >= threshold. Measures with no such
    row give no output row. One pass: one conditional count per measure in a
    single aggregate (no row multiplication, no group-by shuffle)."""
    counts = df.agg(*[F.count_if(F.col(m) >= threshold).alias(m) for m in measures])
    return _stacked(counts, measures, name, name_col)


def argmin_counts(df: DataFrame, measures: Sequence[str], name: str, name_col: str = "stat_name") -> DataFrame:
    """Per measure, the rows where it equals the row's minimum over all
    measures (nulls skipped by least; ties all counted). One pass, as above;
    the row minimum is a shared subexpression."""
    low = F.least(*[F.col(m) for m in measures])
    counts = df.agg(*[F.count_if(F.col(m) == low).alias(m) for m in measures])
    return _stacked(counts, measures, name, name_col)


def group_summary(df: DataFrame, group: str, entity: str, value: str,
                  names=("characters", "avg_value", "median_value")) -> DataFrame:
    """Per group: distinct entities, mean and exact interpolated median of
    ``value`` over the non-null rows.

    Rows are first merged to (group, entity, value) with a weight, then to
    (group, value); the median is where the running weight of a group's distinct
    values, a sorted window that spills, passes the two middle ranks. No step
    keeps a map per group or entity. An entity may have several values."""
    n_name, avg_name, med_name = names
    per_value = df.where(F.col(value).isNotNull()).groupBy(entity, group, value).agg(F.count(F.lit(1)).alias("_w"))
    # an entity counts once a group: with its first value there
    per_entity = per_value.groupBy(entity, group).agg(F.collect_list(F.struct(F.col(value), F.col("_w"))).alias("_values"))
    rows = per_entity.select(group, F.posexplode("_values").alias("_i", "_v")).select(
        group, F.col("_v." + value).alias(value), F.col("_v._w").alias("_w"), (F.col("_i") == 0).cast("long").alias("_one"))
    merged = rows.groupBy(group, value).agg(F.sum("_w").alias("_w"), F.sum("_one").alias("_one"))
    same = Window.partitionBy(group)
    upto = same.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.select(group, value, "_w", "_one", F.sum("_w").over(upto).alias("_upto"), F.sum("_w").over(same).alias("_all"))

    def at(rank: str):
        """The value of a 0-based rank among the rows, the weights counted."""
        return F.max(F.when((F.col("_upto") > F.expr(rank)) & (F.col("_upto") - F.col("_w") <= F.expr(rank)), F.col(value)))

    return ranked.groupBy(group).agg(
        F.sum("_one").alias(n_name),
        (F.sum(F.col("_w") * F.col(value)) / F.sum("_w")).alias(avg_name),
        ((at("(_all - 1) div 2") + at("_all div 2")) / 2).alias(med_name),
    )


def top_per_group(df: DataFrame, group: str, item: str, names=("item", "item_count"),
                  where: Column | None = None, collation: str | None = None) -> DataFrame:
    """Most frequent ``item`` in each ``group`` (ties: smallest item, in
    binary order or in ``collation`` such as 'UNICODE'). The window runs over
    already aggregated (group, item) rows and is limited to rank 1 before its
    shuffle (WindowGroupLimit)."""
    item_name, count_name = names
    if where is not None:
        df = df.where(where)
    counts = df.groupBy(group, item).agg(F.count(F.lit(1)).alias(count_name))
    tie = F.collate(F.col(item), collation) if collation else F.col(item)
    w = Window.partitionBy(group).orderBy(F.col(count_name).desc(), tie.asc())
    return (
        counts.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select(group, F.col(item).alias(item_name), count_name)
    )


def membership_rate(df: DataFrame, entity: str, group: str,
                    names=("members", "multi_members", "rate_pct")) -> DataFrame:
    """Per group: entities in it, those of them that belong to more than one
    distinct group, and the exact percentage (2 decimals, half up).

    One scan and no join: a window over the distinct (entity, group) rows of an
    entity counts its groups.
    """
    members_name, multi_name, rate_name = names
    membership = df.select(entity, group).where(F.col(group).isNotNull()).distinct()
    flags = membership.withColumn("_multi", F.count(F.lit(1)).over(Window.partitionBy(entity)) > 1)
    per_group = flags.groupBy(group).agg(
        F.count(F.lit(1)).alias(members_name),
        F.sum(F.col("_multi").cast("long")).alias(multi_name),
    )
    return per_group.withColumn(rate_name, exact_rate_pct(F.col(multi_name), F.col(members_name)))
