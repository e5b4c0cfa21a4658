"""Pairwise Pearson correlation matrix in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.stats import pair_corr


def corr_matrix(df: DataFrame, cols: Sequence[str], decimals: int = 2,
                names=("field_x", "field_y", "corr")) -> DataFrame:
    """All len(cols)^2 cells as (field_x, field_y, corr), rounded half-even.

    One pass over the data: each row is spread into its k(k+1)/2 unordered
    (x, y) value pairs, grouped by pair with three aggregates each. The
    grouping has a fixed, tiny number of keys, so partial aggregation leaves
    one row per pair per task before the shuffle. The diagonal is the pair
    (x, x): 1.0, or null for zero variance. Mirror cells are copied.
    """
    cols = list(cols)
    fx, fy, fc = names
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i:]]
    # Rows are spread into (pair number, x, y); names are attached after the
    # aggregation, so the grouping key is one int, not two strings.
    spread = F.array(*[
        F.struct(F.lit(k).alias("_pair"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        for k, (x, y) in enumerate(pairs)
    ])
    cells = df.select(F.inline(spread)).groupBy("_pair").agg(pair_corr("_x", "_y").alias(fc))
    names_of = F.array(*[F.struct(F.lit(x).alias(fx), F.lit(y).alias(fy)) for x, y in pairs])
    named = cells.select(F.element_at(names_of, F.col("_pair") + 1).alias("_n"), fc)
    mirrored = named.select(
        F.explode(
            F.when(F.col("_n")[fx] == F.col("_n")[fy], F.array(F.col("_n")))
            .otherwise(F.array(F.col("_n"), F.struct(F.col("_n")[fy].alias(fx), F.col("_n")[fx].alias(fy))))
        ).alias("_cell"),
        fc,
    )
    return mirrored.select(F.col(f"_cell.{fx}").alias(fx), F.col(f"_cell.{fy}").alias(fy),
                           F.bround(F.col(fc), decimals).alias(fc))
