"""Writing the relations: catalog tables, JDBC, schema and views."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_schema(spark: SparkSession, database: str, drop: bool = True, location: str | None = None) -> None:
    """DROP ... CASCADE (optional) and CREATE the database, optionally at an
    explicit (shared) location instead of the session's warehouse."""
    if drop:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def use_schema(spark: SparkSession, database: str) -> None:
    """Default database for unqualified names."""
    spark.catalog.setCurrentDatabase(database)


def sink_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns to insert, with floating NaN turned into SQL NULL."""
    out = []
    types = dict(df.dtypes)
    for c in columns:
        col = F.col(c)
        if types[c] in ("double", "float"):
            col = F.nanvl(col, F.lit(None).cast(types[c]))
        out.append(col.alias(c))
    return df.select(*out)


BUCKET_ROWS = 250_000


def auto_buckets(spark: SparkSession, source: DataFrame) -> int:
    """About one bucket per ``BUCKET_ROWS`` rows of ``source`` (a count of it), at least
    the session's parallelism, without an upper limit."""
    return max(spark.sparkContext.defaultParallelism, -(-source.count() // BUCKET_ROWS))


def as_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; floating NaN becomes
    SQL NULL and a null in a required column fails the load."""
    out = []
    for f in schema:
        col = F.col(f.name)
        if dict(df.dtypes)[f.name] in ("double", "float"):
            col = F.nanvl(col, F.lit(None).cast("double"))
        col = col.cast(f.dataType)
        if not f.nullable:
            col = F.coalesce(col, F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType))
        out.append(col.alias(f.name))
    return df.select(*out)


def write_table(df: DataFrame, database: str, table: str, mode: str = "overwrite",
                bucket_key: str | None = None, buckets: int | None = None, fmt: str = "parquet",
                observation: Observation | None = None) -> None:
    """Full refresh of one catalog table. With ``bucket_key`` the table is
    bucketed and sorted on it, so later joins on that key between tables with
    the same bucket count read co-located files instead of shuffling.
    ``observation`` gets the ``rows`` that the writing tasks saw."""
    if bucket_key and buckets:
        # Hash-partition with the bucketing hash first, so each task writes
        # the file of one bucket (not one file per bucket per task).
        df = df.repartition(buckets, bucket_key)
    if observation is not None:  # in the writing stage, so a task that runs again counts once
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    if bucket_key and buckets:
        writer = df.write.mode(mode).format(fmt).bucketBy(buckets, bucket_key).sortBy(bucket_key)
    else:
        writer = df.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    writer.saveAsTable(f"`{database}`.`{table}`")


def write_relations(relations: Mapping[str, DataFrame], database: str, columns: Mapping[str, Sequence[str]],
                    buckets: int | None = None, bucket_key: str = "char_id") -> None:
    for name, df in relations.items():
        write_table(sink_rows(df, columns[name]), database, name, bucket_key=bucket_key if buckets else None,
                    buckets=buckets)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
               truncate: bool = True, cascade_truncate: bool = True, batchsize: int = 10000,
               num_partitions: int | None = None) -> None:
    """Full refresh through JDBC: TRUNCATE (keeping the table and its keys)
    instead of DROP, partition-parallel batched inserts."""
    if num_partitions:  # so many connections; the steps before keep their own parallelism
        df = df.repartition(num_partitions)
    (
        df.write.mode("overwrite")
        .option("truncate", str(truncate).lower())
        .option("cascadeTruncate", str(cascade_truncate).lower())
        .option("batchsize", str(batchsize))
        .jdbc(url, table, properties=dict(properties))
    )


POINTER = "current_load"
LOADS = "loads"


def execute(spark: SparkSession, sql: str) -> None:
    """One catalog statement of a publication."""
    spark.sql(sql)


def versioned(name: str, version: int) -> str:
    return f"{name}__v{version}"


def load_versions(spark: SparkSession, database: str, names: Sequence[str]) -> dict[int, list[str]]:
    """The tables of each load that is in the database, whole or not."""
    found: dict[int, list[str]] = {}
    for r in spark.sql(f"SHOW TABLES IN `{database}`").collect():
        m = re.fullmatch(r"(.+)__v(\d+)", r["tableName"])
        if m and m[1] in names:
            found.setdefault(int(m[2]), []).append(r["tableName"])
    return found


def current_version(spark: SparkSession, database: str) -> int:
    """The published load; 0 when there is none."""
    if not spark.catalog.tableExists(f"`{database}`.`{POINTER}`"):
        return 0
    return spark.table(f"`{database}`.`{POINTER}`").first()["version"]


def _show(spark: SparkSession, database: str, tables: Mapping[str, T.StructType], versions: Sequence[int]) -> None:
    """The public names as views of one load, or of that of several which the
    pointer names (its number is a literal: the others are pruned in planning)."""
    for name, schema in tables.items():
        columns = ", ".join(f"`{c}`" for c in schema.names)
        guard = f" WHERE (SELECT version FROM `{database}`.`{POINTER}`) = {{v}}" if len(versions) > 1 else ""
        parts = [f"SELECT {columns} FROM `{database}`.`{versioned(name, v)}`" + guard.format(v=v) for v in versions]
        execute(spark, f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS " + " UNION ALL ".join(parts))


def begin_load(spark: SparkSession, database: str, tables: Mapping[str, T.StructType]) -> int:
    """The number of a new load. What earlier loads left behind is dropped, but
    for the published one and the one before it, which readers may still hold."""
    plain = [n for n in tables if spark.catalog.tableExists(f"`{database}`.`{n}`")
             and spark.catalog.getTable(f"`{database}`.`{n}`").tableType != "VIEW"]
    if plain:
        raise ValueError(f"{', '.join(plain)} of {database} are tables, not views of a load: drop them or take another database")
    now, found = current_version(spark, database), load_versions(spark, database, list(tables))
    if now:
        _show(spark, database, tables, [now])  # a load that was cut off may have left views of its own tables
    before = max((v for v in found if v < now), default=0)
    for v, names in found.items():
        if v not in (now, before):
            for name in names:
                execute(spark, f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    return max([now, *found]) + 1


def publish(spark: SparkSession, database: str, tables: Mapping[str, T.StructType], version: int) -> None:
    """All tables of a load in one step: the public names first become views of
    the old and the new load, of which the pointer picks one; then the pointer, one
    catalog statement, changes; then the views drop the old load. Cut off anywhere,
    all names show one load. For readers without a catalog the load's number is
    added to the ``loads`` folder beside the tables, as one file."""
    now = current_version(spark, database)
    point = f"CREATE OR REPLACE VIEW `{database}`.`{POINTER}` AS SELECT {{v}} AS version"
    if now:
        _show(spark, database, tables, [now, version])
    execute(spark, point.format(v=version))
    _show(spark, database, tables, [version])
    folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    spark.range(1).select(F.lit(version).cast("long").alias("version")).write.mode("append").json(f"{folder}/{LOADS}")


def load_folders(spark: SparkSession, folder: str, names: Sequence[str]) -> list[DataFrame]:
    """The tables of the last load published in a database's folder, without a catalog."""
    folder = folder.rstrip("/")
    version = spark.read.schema("version long").json(f"{folder}/{LOADS}").agg(F.max("version")).first()[0]
    return [spark.read.parquet(f"{folder}/{versioned(n, version)}") for n in names]


def shadowing(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that the session has temporary views of."""
    temporary = {t.name for t in spark.catalog.listTables("default") if t.isTemporary}  # listed with every database
    return [n for n in names if n.lower() in temporary]


def create_views(spark: SparkSession, database: str, views: Mapping[str, str]) -> list[str]:
    """Create or replace the database's own views, in the given (dependency)
    order. ``{db}`` in a view's SQL is the quoted database name."""
    for name, sql in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {sql.format(db=f'`{database}`')}")
    return list(views)
