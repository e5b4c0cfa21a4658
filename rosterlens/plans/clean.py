"""Cleaning of raw profile versions (all-string columns plus ``src_ord``).

Order matters and is kept: names are normalised and filtered before the
latest version is chosen, so the latest version *with a usable name* wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.numeric import bounded, parse_number
from rosterlens.functions.text import is_placeholder_name, normalize_text
from rosterlens.operators.dedupe import keep_version
from rosterlens.operators.keys import placed
from rosterlens.schema import NUMERIC_BOUNDS, RAW_NUMERIC_COLUMNS
from rosterlens.session import kept

KEY = "char_id"
DATE = "date_modified"
SOURCE_ORDER = "src_ord"
# Rows a task sorts at most, about, and versions of a key from which they are cut down before the exchange.
TASK_ROWS = 100_000
HOT_VERSIONS = 100_000


def normalize_names(df: DataFrame) -> DataFrame:
    """Normalise ``name``; drop rows without one and placeholder rows whose
    name contains "'s character" (straight or curly apostrophe, any case)."""
    df = df.withColumn("name", normalize_text("name"))
    return df.where(F.col("name").isNotNull() & ~is_placeholder_name("name"))


def parse_dates(df: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """``date_modified`` -> timestamp (session zone UTC); bad values -> null.
    Without a format, ISO date and date-time forms are accepted row by row."""
    if DATE not in df.columns:
        return df
    c = F.col(DATE)
    ts = F.try_to_timestamp(c, F.lit(timestamp_format)) if timestamp_format else F.try_to_timestamp(c)
    return df.withColumn(DATE, ts)


def latest_versions(df: DataFrame) -> DataFrame:
    """Latest version per key by date; an unparsable (null) date sorts last
    and therefore wins; equal dates go to the later source row. Without a
    date column, the first version in source order is kept."""
    if DATE not in df.columns:
        return first_versions(df)
    return keep_version(df, KEY, [DATE, SOURCE_ORDER], keep="last")


def first_versions(df: DataFrame) -> DataFrame:
    """First version per key in source order."""
    return keep_version(df, KEY, [SOURCE_ORDER], keep="first")


def few_versions(df: DataFrame, most: int = HOT_VERSIONS) -> DataFrame:
    """``df`` with the latest version alone of each key that has more than ``most``
    (there are few such keys: their number is bounded by the rows over ``most``)."""
    hot = kept(df.groupBy(F.col(KEY).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("_hot"), "hot")
    if hot.isEmpty():
        return df
    same = F.col(KEY).eqNullSafe(F.col("_hot"))
    return (df.join(F.broadcast(hot), same, "left_anti")
            .unionByName(latest_versions(df.join(F.broadcast(hot), same, "left_semi"))))


def latest_in_order(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``latest_versions``, range-partitioned and sorted in the insert order of
    characters (``model.source_order``): the versions of a key are beside each
    other in that order, so one exchange of the rows does for both. ``rows``, the
    number of rows that can be read again at little cost, gives the partitions."""
    text = F.col(KEY).cast("string")
    number = text.try_cast("decimal(38,0)")
    by = {"_no_number": number.isNull(), "_number": number, "_text": text}
    if rows is not None:
        df = few_versions(df)
    df = df.withColumns(by)
    if rows is not None:
        df = df.repartitionByRange(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *by)
    else:
        df = df.repartitionByRange(*by)
    if DATE in df.columns:
        df = keep_version(df, list(by), [DATE, SOURCE_ORDER], keep="last")
    else:
        df = keep_version(df, list(by), [SOURCE_ORDER], keep="first")
    return df.sortWithinPartitions(*by).drop(*by)


def coerce_numerics(df: DataFrame) -> DataFrame:
    """Numeric coercion (bad -> null) and range rules, for the columns present."""
    present = [c for c in RAW_NUMERIC_COLUMNS if c in df.columns]
    # Two projections: the parse is referenced several times by the bound
    # test, and Spark does not inline a non-trivial expression into a
    # projection that uses it more than once, so each value is parsed once.
    parsed = df.withColumns({c: parse_number(c) for c in present})
    return parsed.withColumns({c: bounded(c, *NUMERIC_BOUNDS.get(c, (None, None))) for c in present})


def clean_profiles(raw: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """The whole cleaning: names, dates, latest version, numbers."""
    df = normalize_names(raw)
    df = parse_dates(df, timestamp_format)
    df = latest_versions(df)
    return coerce_numerics(df)


def clean_in_order(raw: DataFrame, timestamp_format: str | None = None, rows: int | None = None) -> DataFrame:
    """The rows of ``clean_profiles`` in the insert order of characters, each
    with its place (see ``keys.placed``). Numbers are made first, as they are
    narrower to exchange; a bad one is null, so older versions cannot fail."""
    df = coerce_numerics(parse_dates(normalize_names(raw), timestamp_format))
    return placed(latest_in_order(df, rows))
