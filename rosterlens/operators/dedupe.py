"""Keep one version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "_version_rank"


def keep_version(df: DataFrame, key: str | Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key, like pandas ``sort_values([key, *order])`` (nulls
    last) followed by ``drop_duplicates(key, keep=keep)``.

    ``order`` must end in a column that is unique within a key (a source
    ordinal) so the winner is deterministic. A null key is one group, as in
    pandas. Planned as ``row_number() == 1``, which Spark turns into a partial
    WindowGroupLimit before the shuffle: each map task forwards at most one
    row per key, so a key holding a large share of the rows does not land in
    one reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if keep == "last":
        sort = [F.col(c).desc_nulls_first() for c in order]
    elif keep == "first":
        sort = [F.col(c).asc_nulls_last() for c in order]
    else:
        raise ValueError("keep must be 'first' or 'last'")
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
