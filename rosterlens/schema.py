"""Column lists, bounds and tokens of the profile data model.

Everything under "fixed values" must equal the reference's for equal results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Raw (CSV) columns the cleaning reads, in no particular order of the file.
RAW_TEXT_COLUMNS = ["char_id", "name", "race", "background", "date_modified",
                    "class_starting", "subclass_starting", "class_other", "subclass_other", "feats"]
# Raw columns coerced to numbers, then bounded.
RAW_NUMERIC_COLUMNS = ["total_level", "class_starting_level", "base_hp",
                       "stats_1", "stats_2", "stats_3", "stats_4", "stats_5", "stats_6", "notes_len"]
# Inclusive bounds; None = unbounded. Values outside become null, the row stays.
NUMERIC_BOUNDS = {
    "base_hp": (0, None),
    "notes_len": (0, None),
    "total_level": (1, 20),
    "class_starting_level": (1, 20),
    "stats_1": (1, 30),
    "stats_2": (1, 30),
    "stats_3": (1, 30),
    "stats_4": (1, 30),
    "stats_5": (1, 30),
    "stats_6": (1, 30),
}
# Raw name -> relation name.
RENAME_MAP = {
    "char_id": "source_id",
    "base_hp": "hp",
    "stats_1": "str",
    "stats_2": "dex",
    "stats_3": "con",
    "stats_4": "int",
    "stats_5": "wis",
    "stats_6": "cha",
    "date_modified": "recorded_at",
}
CHARACTER_COLUMNS = ["source_id", "name", "race", "background", "total_level", "hp",
                     "str", "dex", "con", "int", "wis", "cha", "notes_len", "recorded_at"]
STAT_COLUMNS = ["str", "dex", "con", "int", "wis", "cha"]
SMALLINT_COLUMNS = ["total_level", "hp", "str", "dex", "con", "int", "wis", "cha"]
INT_COLUMNS = ["notes_len"]
# Numeric fields of the correlation matrix, in order.
CORRELATION_COLUMNS = ["total_level", "hp", "str", "dex", "con", "int", "wis", "cha", "notes_len"]

# White space removed by Python's str.strip(), as code points.
STRIP_CODE_POINTS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
                     8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
                     8232, 8233, 8239, 8287, 12288]
# Text normalisation: after stripping, these exact values become null.
EMPTY_TEXT_TOKENS = ["", "nan", "None"]
# List items dropped after splitting, compared lower-cased.
LIST_DROP_TOKENS = ["nan", "none"]
LIST_SEPARATOR = "/"
# Placeholder (non-character) rows: name contains this, case-insensitive.
PLACEHOLDER_NAME_PATTERN = "['’]s character"
# Dashboard exclusion of classes, case-insensitive.
EXCLUDED_CLASS_PATTERN = "artificer|blood hunter"
# A stat counts as maxed at or above this value.
MAXED_STAT_THRESHOLD = 20
# Level counted by the level-20 report.
TOP_LEVEL = 20
# pandas read_csv default NA tokens, matched exactly on the raw field.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Explorer slices: (metric, report, category column, value column), in order.
EXPLORER_SLICES = [
    ("class_popularity", "class_popularity", "class", "character_count"),
    ("race_popularity", "race_popularity", "race", "character_count"),
    ("notes_sample_size_by_class", "class_notes_summary", "class", "characters"),
    ("avg_notes_len_by_class", "class_notes_summary", "class", "avg_notes_len"),
    ("multiclass_characters_by_class", "multiclass_rate_by_class", "class", "multiclass_characters"),
    ("characters_with_class", "multiclass_rate_by_class", "class", "characters_with_class"),
    ("maxed_stat_count", "maxed_stats", "stat_name", "maxed_count"),
    ("dump_stat_count", "dump_stats", "stat_name", "dump_count"),
    ("top_subclass_count", "top_subclass_per_class", "class", "subclass_count"),
]
# KPI cards: (title, column, decimals).
KPI_CARDS = [
    ("Total Characters", "total_characters", 0),
    ("Multiclass Characters", "multiclass_characters", 0),
    ("Level 20 Characters", "level_20_characters", 0),
    ("Average Level", "avg_total_level", 2),
]
# Reporting views, in creation (dependency) order.
VIEW_NAMES = ["vw_class_popularity", "vw_race_popularity", "vw_multiclass_count", "vw_level_20_count",
              "vw_maxed_stats", "vw_dump_stats", "vw_class_notes_summary", "vw_top_subclass_per_class",
              "vw_dashboard_kpis"]
TOP_CLASSES = 15
TOP_RACES = 15
TOP_SUBCLASSES = 20
EXPLORER_PAGE_SIZE = 20
# ------------------------------------------------------------ end fixed values

RELATIONS = ["character", "character_class", "character_feats"]

CHARACTER_SCHEMA = T.StructType([
    T.StructField("char_id", T.LongType(), False),
    T.StructField("source_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("race", T.StringType()),
    T.StructField("background", T.StringType()),
    *[T.StructField(c, T.ShortType()) for c in SMALLINT_COLUMNS],
    T.StructField("notes_len", T.IntegerType()),
    T.StructField("recorded_at", T.TimestampType()),
])
CLASS_SCHEMA = T.StructType([
    T.StructField("class_id", T.LongType(), False),
    T.StructField("char_id", T.LongType(), False),
    T.StructField("class", T.StringType(), False),
    T.StructField("subclass", T.StringType()),
    T.StructField("level", T.ShortType()),
])
FEAT_SCHEMA = T.StructType([
    T.StructField("feat_id", T.LongType(), False),
    T.StructField("char_id", T.LongType(), False),
    T.StructField("feat", T.StringType(), False),
])
