"""Generic DataFrame operators; the domain plans are thin calls of these."""

from rosterlens.operators.aggregates import (
    argmin_counts,
    count_where,
    entities_with_many,
    group_summary,
    membership_rate,
    popularity,
    threshold_counts,
    top_per_group,
    unpivot_measures,
)
from rosterlens.operators.correlation import corr_matrix
from rosterlens.operators.dedupe import keep_version
from rosterlens.operators.integrity import cascade_delete, check_relations, relation_counts
from rosterlens.operators.keys import attach_keys, dense_key
from rosterlens.operators.paging import page, top_n

__all__ = [
    "argmin_counts", "count_where", "entities_with_many", "group_summary", "membership_rate",
    "popularity", "threshold_counts", "top_per_group", "unpivot_measures", "corr_matrix",
    "keep_version", "cascade_delete", "check_relations", "relation_counts", "attach_keys",
    "dense_key", "page", "top_n",
]
