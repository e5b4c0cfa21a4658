"""Named queries over the supplied tables: name -> fn(spark, sf_dir) -> DataFrame.

Every query starts from the raw profile rows that Spark derives from the
whole ``orders``/``customer``/``lineitem``/``part`` tables. Queries on the
loaded relations share one keyed build per session and folder, the way the
reference's reports read tables loaded once by its ETL.
"""

from __future__ import annotations

import hashlib
import os
import re
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.operators.integrity import cascade_delete, check_relations, relation_counts
from rosterlens.operators.keys import PID, ROW, attach_keys
from rosterlens.plans import clean as cl
from rosterlens.plans import explore, reports
from rosterlens.plans.model import Relations, build_relations, split_lists
from rosterlens.plans.etl import KEYING_TASK_ROWS, LOAD_COLUMNS, Settings, refresh
from rosterlens.plans.views import VIEWS
from rosterlens.schema import RAW_NUMERIC_COLUMNS, VIEW_NAMES
from rosterlens.session import ensure_checkpoint_dir, sized, use_utc
from rosterlens.sources.csv_landing import OK, STATUS, read_profile_csv, sample_rows, write_profile_csv
from rosterlens.sources.fixtures import most_rows, raw_profiles
from rosterlens.sources.sinks import auto_buckets, create_schema, create_views, write_table
from rosterlens.sources.tables import key_map, load_view, numeric_projection

# Oracle tests exercise the class exclusion with a pattern that matches the
# fixture's classes; the dashboard default is schema.EXCLUDED_CLASS_PATTERN.
FIXTURE_EXCLUDED_CLASSES = "promo|small"
SAMPLE_ROWS = 1000
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
LANDING_TASK_ROWS = 400_000  # of the largest table, a task of the landing

# Per session and folder: landed rows, cleaned rows, loaded relations.
_LANDED: dict[tuple[str, str], DataFrame] = {}
_REFRESHED: set[tuple[str, str]] = set()
_CLEANED: dict[tuple[str, str], DataFrame] = {}
_BUILT: dict[tuple[str, str], Relations] = {}
_CSV: dict[tuple[str, str], str] = {}
# One build at a time: two threads must not overwrite the same folders.
_LOCK = threading.RLock()


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir)


def _scratch(spark: SparkSession, *parts: str) -> str:
    """A folder under this application's checkpoint directory (shared
    storage on a cluster: spark.checkpoint.dir)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "rosterlens", *parts])


def _slug(sf_dir: str) -> str:
    path = os.path.abspath(sf_dir)
    return f"{os.path.basename(path)}-{hashlib.sha1(path.encode()).hexdigest()[:8]}"


def _database(sf_dir: str) -> str:
    return "rosterlens_" + re.sub(r"[^0-9a-zA-Z]", "_", _slug(sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw profile rows, landed once per session and folder as Parquet in
    the shared checkpoint folder, as the reference extracts its CSV once per
    run. Reading Parquet back (not an RDD checkpoint) lets every query prune
    columns and push filters into the scan."""
    use_utc(spark)
    key = _key(spark, sf_dir)
    with _LOCK:
        if key not in _LANDED:
            path = _scratch(spark, "landed", _slug(sf_dir))
            with sized(spark, most_rows(spark, sf_dir), LANDING_TASK_ROWS):
                raw_profiles(spark, sf_dir).write.mode("overwrite").parquet(path, compression="zstd")
            _LANDED[key] = spark.read.parquet(path)
        return _LANDED[key]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned profiles, computed once per session and folder and kept as
    Parquet: like the reference's one cleaned frame, they feed all three
    relation builders (M10). The cleaning queries themselves run C1-C12 from
    the landed rows each time."""
    return _cleaned(spark, sf_dir).drop(PID, ROW)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned profiles with their places in the insert order of characters."""
    key = _key(spark, sf_dir)
    with _LOCK:
        if key not in _CLEANED:
            path = _scratch(spark, "cleaned", _slug(sf_dir))
            landed = raw(spark, sf_dir)
            rows = landed.count()
            with sized(spark, rows, cl.TASK_ROWS):
                cl.clean_in_order(landed, rows=rows).write.mode("overwrite").parquet(path, compression="zstd")
            _CLEANED[key] = spark.read.parquet(path)
        return _CLEANED[key]


def relations(spark: SparkSession, sf_dir: str) -> Relations:
    """Keyed relations, built once per session and folder and loaded as
    tables bucketed on char_id."""
    use_utc(spark)
    key = _key(spark, sf_dir)
    with _LOCK:
        return _relations(spark, sf_dir, key)


def _relations(spark: SparkSession, sf_dir: str, key) -> Relations:
    if key not in _BUILT:
        rows = _cleaned(spark, sf_dir).count()
        with sized(spark, rows, KEYING_TASK_ROWS):
            built = build_relations(_cleaned(spark, sf_dir), keyed=True)
        # Loaded once, like the reference's tables: Parquet tables bucketed on
        # char_id in a database under the shared checkpoint folder. Reports
        # scan only the columns they use, with filters pushed down, and their
        # joins and per-character aggregations read co-located buckets
        # instead of shuffling.
        db = _database(sf_dir)
        create_schema(spark, db, drop=True, location=_scratch(spark, "tables", _slug(sf_dir)))
        buckets = auto_buckets(spark, cleaned(spark, sf_dir))
        with sized(spark, rows, KEYING_TASK_ROWS):
            for name, df in built.as_dict().items():
                write_table(df, db, name, bucket_key="char_id", buckets=buckets)
        _BUILT[key] = Relations(*(spark.table(f"`{db}`.`{n}`") for n in built.as_dict()))
    return _BUILT[key]


def unkeyed(spark: SparkSession, sf_dir: str) -> Relations:
    return build_relations(cleaned(spark, sf_dir), keyed=False)


def _ts(df: DataFrame, col: str) -> DataFrame:
    """Timestamps leave as UTC text, so no client time zone shifts them."""
    return df.withColumn(col, F.date_format(F.col(col), TS_FORMAT))


def _ord(df: DataFrame) -> DataFrame:
    return df.withColumn("src_ord", F.col("src_ord").cast("long"))


def q_clean_profiles(spark, d):
    return _ord(_ts(cl.clean_profiles(raw(spark, d)), "date_modified"))


def q_normalize_names(spark, d):
    return _ord(cl.normalize_names(raw(spark, d))).select("char_id", "src_ord", "name")


def q_latest_versions(spark, d):
    df = cl.latest_versions(cl.parse_dates(cl.normalize_names(raw(spark, d))))
    return _ord(_ts(df, "date_modified")).select("char_id", "src_ord", "date_modified", "name")


def q_first_versions(spark, d):
    return _ord(cl.first_versions(cl.normalize_names(raw(spark, d)))).select("char_id", "src_ord", "name")


def q_bounded_numerics(spark, d):
    return _ord(cl.coerce_numerics(raw(spark, d))).select("char_id", "src_ord", *RAW_NUMERIC_COLUMNS)


def q_characters(spark, d):
    return _ts(unkeyed(spark, d).character, "recorded_at")


def q_split_lists(spark, d):
    return split_lists(cleaned(spark, d))


def q_class_rows(spark, d):
    return unkeyed(spark, d).classes


def q_feat_rows(spark, d):
    return unkeyed(spark, d).feats


def q_keyed_characters(spark, d):
    return _ts(relations(spark, d).character, "recorded_at")


def q_key_map(spark, d):
    return key_map(relations(spark, d).character)


def q_keyed_classes(spark, d):
    return attach_keys(unkeyed(spark, d).classes, key_map(relations(spark, d).character))


def q_keyed_feats(spark, d):
    return attach_keys(unkeyed(spark, d).feats, key_map(relations(spark, d).character))


def q_class_keys(spark, d):
    return relations(spark, d).classes


def q_feat_keys(spark, d):
    return relations(spark, d).feats


def q_relation_counts(spark, d):
    return relation_counts(relations(spark, d).as_dict())


def q_orphan_check(spark, d):
    r = relations(spark, d)
    return check_relations(r.character, r.classes, r.feats)


def q_cascade_delete(spark, d):
    """Delete characters whose version date could not be parsed; their class and
    feat rows go with them. Returns what remains of all three relations."""
    r = relations(spark, d)
    doomed = r.character.where(F.col("recorded_at").isNull())
    parents, children = cascade_delete(r.character, {"character_class": r.classes, "character_feats": r.feats}, doomed)

    def rows(name, df, key, item):
        return df.select(F.lit(name).alias("relation"), F.col(key).alias("row_id"), "char_id", F.col(item).alias("item"))

    return (rows("character", parents, "char_id", "source_id")
            .unionByName(rows("character_class", children["character_class"], "class_id", "class"))
            .unionByName(rows("character_feats", children["character_feats"], "feat_id", "feat")))


def q_numeric_projection(spark, d):
    return numeric_projection(relations(spark, d).character)


def q_sample_rows(spark, d):
    df = raw(spark, d).withColumn("_n", F.col("char_id").try_cast("decimal(38,0)"))
    return _ord(sample_rows(df, SAMPLE_ROWS, ("src_ord", "_n", "char_id")).drop("_n"))


def q_csv_landing(spark, d):
    """S1 on the whole fixture: the raw columns written once per session as a
    CSV file set, then scanned with the all-string schema, NA tokens, status
    and source order; the usable rows are returned (without the new
    ``src_ord``, which numbers file rows)."""
    landed = read_profile_csv(spark, _profile_csv(spark, d))
    return landed.where(F.col(STATUS) == OK).drop(STATUS, "src_ord")


def _profile_csv(spark: SparkSession, d: str) -> str:
    """The raw columns as a CSV file set, written once per session and folder
    (the landing assigns its own source order, so ``src_ord`` is left out)."""
    key = _key(spark, d)
    with _LOCK:
        if key not in _CSV:
            path = _scratch(spark, "csv", _slug(d))
            _CSV[key] = write_profile_csv(raw(spark, d).drop("src_ord"), path)
        return _CSV[key]


def _refreshed(spark: SparkSession, d: str) -> str:
    """P1/P2 end to end on the fixture's CSV, once per session and folder: land,
    clean, build keyed relations, stage, check and switch the tables (L4, L5,
    L6), create the views. Returns the database. ``current`` is put back."""
    slug = _slug(d)
    db = "rosterlens_refresh_" + re.sub(r"[^0-9a-zA-Z]", "_", slug)
    path = _profile_csv(spark, d)
    key = _key(spark, d)
    with _LOCK:
        if key not in _REFRESHED:
            before = spark.catalog.currentDatabase()
            refresh(spark, Settings(source=path, landing=_scratch(spark, "refresh", slug, "landed"),
                                    database=db, database_location=_scratch(spark, "refresh", slug, "db")))
            spark.catalog.setCurrentDatabase(before if spark.catalog.databaseExists(before) else "default")
            _REFRESHED.add(key)
    return db


def q_refresh_counts(spark, d):
    """Rows per refreshed table."""
    db = _refreshed(spark, d)
    return relation_counts({n: spark.table(f"`{db}`.`{n}`") for n in LOAD_COLUMNS})


def q_refreshed_character(spark, d):
    """The refreshed ``character`` table, its 15 declared columns."""
    return _ts(spark.table(f"`{_refreshed(spark, d)}`.character"), "recorded_at")


def q_refreshed_classes(spark, d):
    return spark.table(f"`{_refreshed(spark, d)}`.character_class")


def q_refreshed_feats(spark, d):
    return spark.table(f"`{_refreshed(spark, d)}`.character_feats")


def q_refreshed_views(spark, d):
    """All nine views of the refreshed database, stacked as (view, category, value)."""
    db = _refreshed(spark, d)
    parts = []
    for name in VIEW_NAMES:
        df = spark.table(f"`{db}`.`{name}`")
        label = df.columns[0] if dict(df.dtypes)[df.columns[0]] == "string" else None
        cells = [F.struct(F.lit(name).alias("view"), (F.col(label) if label else F.lit(c)).alias("category"),
                          F.lit(c).alias("field"), F.round(F.col(c).cast("double"), 6).alias("value"))
                 for c in df.columns if dict(df.dtypes)[c] != "string"]
        parts.append(df.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def q_view_lookup(spark, d):
    """A report read by its view's name, from the database of the loaded tables."""
    relations(spark, d)
    db = _database(d)
    with _LOCK:
        create_views(spark, db, VIEWS)
    return load_view(spark, "vw_top_subclass_per_class", db)


def _on_relations(fn: Callable[[Relations], DataFrame]):
    return lambda spark, d: fn(relations(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_profiles": q_clean_profiles,
    "normalize_names": q_normalize_names,
    "latest_versions": q_latest_versions,
    "first_versions": q_first_versions,
    "bounded_numerics": q_bounded_numerics,
    "characters": q_characters,
    "split_lists": q_split_lists,
    "class_rows": q_class_rows,
    "feat_rows": q_feat_rows,
    "keyed_characters": q_keyed_characters,
    "key_map": q_key_map,
    "keyed_classes": q_keyed_classes,
    "keyed_feats": q_keyed_feats,
    "class_keys": q_class_keys,
    "feat_keys": q_feat_keys,
    "relation_counts": q_relation_counts,
    "orphan_check": q_orphan_check,
    "cascade_delete": q_cascade_delete,
    "numeric_projection": q_numeric_projection,
    "sample_rows": q_sample_rows,
    "view_lookup": q_view_lookup,
    "csv_landing": q_csv_landing,
    "refresh_counts": q_refresh_counts,
    "refreshed_character": q_refreshed_character,
    "refreshed_classes": q_refreshed_classes,
    "refreshed_feats": q_refreshed_feats,
    "refreshed_views": q_refreshed_views,
    "class_popularity": _on_relations(lambda r: reports.class_popularity(r, ordered=True)),
    "race_popularity": _on_relations(lambda r: reports.race_popularity(r, ordered=True)),
    "multiclass_count": _on_relations(reports.multiclass_count),
    "level_20_count": _on_relations(reports.level_20_count),
    "maxed_stats": _on_relations(lambda r: reports.maxed_stats(r, ordered=True)),
    "dump_stats": _on_relations(lambda r: reports.dump_stats(r, ordered=True)),
    "class_notes_summary": _on_relations(lambda r: reports.class_notes_summary(r, ordered=True)),
    "top_subclass_per_class": _on_relations(lambda r: reports.top_subclass_per_class(r, ordered=True)),
    "multiclass_rate_by_class": _on_relations(reports.multiclass_rate_by_class),
    "dashboard_kpis": _on_relations(reports.dashboard_kpis),
    "top_classes": _on_relations(explore.top_classes),
    "top_races": _on_relations(explore.top_races),
    "maxed_sorted": _on_relations(explore.maxed_sorted),
    "dump_sorted": _on_relations(explore.dump_sorted),
    "top_subclasses": _on_relations(explore.top_subclasses),
    "notes_filtered": _on_relations(lambda r: explore.notes_filtered(r, FIXTURE_EXCLUDED_CLASSES)),
    "multiclass_filtered": _on_relations(lambda r: explore.multiclass_filtered(r, FIXTURE_EXCLUDED_CLASSES)),
    "explorer_union": _on_relations(explore.explorer_union),
    "explorer_page": _on_relations(
        lambda r: explore.explorer_page(r, where=F.col("metric") != "avg_notes_len_by_class", page_no=1)),
    "correlation_matrix": _on_relations(explore.correlation_matrix),
    "kpi_cards": _on_relations(explore.kpi_cards),
}
