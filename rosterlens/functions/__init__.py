"""Column expressions. All are built-in Spark expressions (no UDFs), so they
stay inside whole-stage code generation where Spark supports it."""

from rosterlens.functions.numeric import (
    bounded,
    exact_rate_pct,
    format_count,
    format_fixed2,
    parse_number,
    to_int,
    to_smallint,
)
from rosterlens.functions.stats import pair_corr, self_corr
from rosterlens.functions.text import (
    is_placeholder_name,
    matches_ci,
    na_to_null,
    normalize_text,
    split_list,
    strip_text,
)

__all__ = [
    "bounded", "exact_rate_pct", "format_count", "format_fixed2", "parse_number",
    "to_int", "to_smallint", "pair_corr", "self_corr", "is_placeholder_name",
    "matches_ci", "na_to_null", "normalize_text", "split_list", "strip_text",
]
