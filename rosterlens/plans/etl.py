"""End-to-end jobs: extract -> clean -> build keyed relations -> load -> counts,
and the full refresh (schema, tables, views)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from rosterlens.operators.integrity import assert_sound, relation_counts
from rosterlens.plans.clean import TASK_ROWS, clean_in_order
from rosterlens.plans.model import Relations, build_relations
from rosterlens.plans.views import VIEWS
from rosterlens.schema import CHARACTER_SCHEMA, CLASS_SCHEMA, FEAT_SCHEMA, VIEW_NAMES
from rosterlens.session import sized, use_utc
from rosterlens.sources import csv_landing, sinks
from rosterlens.streaming.landing import land_csv_stream

# The declared tables; a load writes exactly these columns.
TABLES = {"character": CHARACTER_SCHEMA, "character_class": CLASS_SCHEMA, "character_feats": FEAT_SCHEMA}
LOAD_COLUMNS = {name: schema.names for name, schema in TABLES.items()}

# Rows a task numbers the entries of, on average: whole ranges of the sort meet in a
# task by their hash, so there are more tasks than ranges.
KEYING_TASK_ROWS = 50_000


@dataclass
class Settings:
    """Where data comes from and goes to (no credentials in code: JDBC
    properties are passed in by the caller)."""
    source: str | None = None          # CSV file or folder
    landing: str | None = None         # Parquet landing folder
    stream_checkpoint: str | None = None  # with `landing`: land only new files of a drop folder
    database: str = "characters"       # catalog database of the tables
    database_location: str | None = None  # where a (re)created database lives
    sample_rows: int | None = None
    timestamp_format: str | None = None
    buckets: int | str | None = "auto"  # bucket the tables on char_id: a count, "auto" or None
    validate: bool = True              # check keys and references before the new tables replace the old
    jdbc_url: str | None = None
    jdbc_partitions: int | None = None  # connections of a JDBC load
    jdbc_properties: dict = field(default_factory=dict)


def extract(spark: SparkSession, settings: Settings) -> DataFrame:
    """Land the CSV once (if a landing folder is given) and return the usable
    raw rows, optionally only the first ``sample_rows``."""
    if settings.landing and settings.stream_checkpoint:
        # Drop folder: each CSV file is landed once (Structured Streaming,
        # availableNow); the cleaning then sees every landed version.
        columns = csv_landing.header_columns(spark, settings.source)
        land_csv_stream(spark, settings.source, settings.landing, settings.stream_checkpoint, columns)
        raw = csv_landing.read_landed(spark, settings.landing, columns=columns)
        return csv_landing.sample_rows(raw, settings.sample_rows)
    source = settings.source
    if settings.sample_rows is not None:  # the first files that hold so many rows, and no others
        source = csv_landing.first_files(spark, source, settings.sample_rows)
    headers = csv_landing.file_headers(spark, source)
    columns = csv_landing.all_columns(headers)
    if settings.landing:
        csv_landing.land_csv(spark, source, settings.landing, columns, headers=headers)
        raw = csv_landing.read_landed(spark, settings.landing, columns=columns)
    else:
        raw = csv_landing.read_profile_csv(spark, source, columns, headers=headers)
        raw = raw.where(raw[csv_landing.STATUS] == csv_landing.OK).drop(csv_landing.STATUS)
    return csv_landing.sample_rows(raw, settings.sample_rows)


def transform(raw: DataFrame, settings: Settings | None = None) -> Relations:
    fmt = settings.timestamp_format if settings else None
    # landed rows are counted without reading a column
    rows = raw.count() if settings and settings.landing else None
    return build_relations(clean_in_order(raw, fmt, rows), keyed=True)


def load_jdbc(rels: Relations, settings: Settings) -> None:
    """Full refresh of the three tables behind a JDBC URL."""
    for name, df in rels.as_dict().items():
        sinks.write_jdbc(sinks.sink_rows(df, LOAD_COLUMNS[name]), settings.jdbc_url, f"{settings.database}.{name}",
                         settings.jdbc_properties, num_partitions=settings.jdbc_partitions)


def load_catalog(spark: SparkSession, rels: Relations, settings: Settings, raw: DataFrame) -> dict[str, int]:
    """Full refresh of the catalog tables: written beside the old ones, checked
    there, and published together by one pointer. A load that ends at any point
    before leaves the old tables, all three. Returns the rows written."""
    db = settings.database
    version = sinks.begin_load(spark, db, TABLES)
    # the kept character rows, where there are some: their count reads no column
    source = rels.ordered if rels.ordered is not None else raw
    buckets = sinks.auto_buckets(spark, source) if settings.buckets == "auto" else settings.buckets
    counts = {}
    for name, df in rels.as_dict().items():
        seen = Observation(f"{name}_rows")
        sinks.write_table(sinks.as_declared(df, TABLES[name]), db, sinks.versioned(name, version),
                          bucket_key="char_id" if buckets else None, buckets=buckets, observation=seen)
        counts[name] = int(seen.get.get("rows") or 0)
    if settings.validate:
        assert_sound(*(spark.table(f"`{db}`.`{sinks.versioned(n, version)}`") for n in TABLES))
    sinks.publish(spark, db, TABLES, version)
    return counts


def run_pipeline(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Extract, transform, load; returns rows per loaded relation, as the
    writing tasks counted them."""
    use_utc(spark)
    raw = extract(spark, settings)
    rows = raw.count() if settings.landing else None
    with sized(spark, rows, TASK_ROWS):
        rels = transform(raw, settings)
    with sized(spark, rows, KEYING_TASK_ROWS):
        if settings.jdbc_url:
            if settings.validate:
                assert_sound(rels.character, rels.classes, rels.feats)
            load_jdbc(rels, settings)
            return {r["relation"]: r["rows"] for r in relation_counts(rels.as_dict()).collect()}
        return load_catalog(spark, rels, settings, raw)


def refresh(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Database -> tables -> the database's views, which then is the current
    one. Behind a JDBC URL only the tables are refreshed; the catalog is not
    touched. Temporary views that would hide the names of the database's tables
    and views are an error, before anything is done."""
    if settings.jdbc_url:
        return run_pipeline(spark, settings)
    hiding = sinks.shadowing(spark, [*TABLES, *VIEW_NAMES])
    if hiding:
        raise ValueError(f"temporary views of this session hide names of the database: {', '.join(hiding)}")
    sinks.create_schema(spark, settings.database, drop=False, location=settings.database_location)
    counts = run_pipeline(spark, settings)
    sinks.create_views(spark, settings.database, VIEWS)
    sinks.use_schema(spark, settings.database)
    return counts
