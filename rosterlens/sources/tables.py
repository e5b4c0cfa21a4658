"""Reads of loaded relations and named reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.schema import CORRELATION_COLUMNS


def key_map(character: DataFrame) -> DataFrame:
    """(source_id, char_id) of the loaded characters."""
    return character.select("source_id", "char_id")


def load_view(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A whole table or view of a database (the current one by default) by
    name; a temporary view of that name is not meant."""
    return spark.table(f"`{database or spark.catalog.currentDatabase()}`.`{name}`")


def numeric_projection(character: DataFrame) -> DataFrame:
    """The nine numeric fields; ``int`` is exposed as ``int_stat``."""
    return character.select(*[F.col(c).alias("int_stat" if c == "int" else c) for c in CORRELATION_COLUMNS])


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """A table or view of an external database (the key map, a report view).

    With ``partition_column`` (a numeric key such as char_id) and its bounds,
    the read is split into ``num_partitions`` parallel range queries instead
    of one connection streaming the whole table.
    """
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions or 1, properties=dict(properties))
    return spark.read.jdbc(url, table, properties=dict(properties))
