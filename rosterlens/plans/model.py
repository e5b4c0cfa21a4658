"""From cleaned profiles to the three relations.

Each cleaned row is the only version of its key, so its class and feat
lists can be split, zipped and de-duplicated inside the row (higher-order
array functions, no shuffle); ``is_multiclass`` is the size of that list.
Only the dense keys need a global order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.numeric import to_int, to_smallint
from rosterlens.functions.text import normalize_text, split_list
from rosterlens.operators.keys import PID, ROW, entry_positions, in_order, positions
from rosterlens.schema import CHARACTER_COLUMNS, INT_COLUMNS, RENAME_MAP, SMALLINT_COLUMNS
from rosterlens.session import kept

CLASSES = "_classes"
FEATS = "_feats"
HAS_START = "_has_start"
START_LEVEL = "_start_level"


def class_entries() -> Column:
    """Array of (class, subclass): the starting class first (when it has a
    class), then ``class_other`` zipped by position with ``subclass_other``
    after both lists are split and filtered (a missing subclass is null,
    surplus subclasses are ignored); repeated (class, subclass) pairs keep
    their first occurrence."""
    start_class = normalize_text("class_starting")
    start = F.struct(start_class.alias("class"), normalize_text("subclass_starting").alias("subclass"))
    start_arr = F.when(start_class.isNotNull(), F.array(start)).otherwise(
        F.array().cast("array<struct<class:string,subclass:string>>"))
    classes = split_list("class_other")
    # arrays_zip pads the shorter list with nulls; slicing to the class list
    # drops surplus subclasses. No per-element lambda.
    zipped = F.arrays_zip(classes.alias("class"), split_list("subclass_other").alias("subclass"))
    others = F.slice(zipped, 1, F.size(classes))
    # List items are already stripped and free of ''/nan/none, so the
    # reference's second normalisation pass cannot change them.
    return F.array_distinct(F.concat(start_arr, others))


def feat_entries() -> Column:
    return F.array_distinct(split_list("feats"))


def nest(clean: DataFrame) -> DataFrame:
    """One row per character: renamed, cast character columns, the class and
    feat arrays, and ``is_multiclass`` (more than one class row)."""
    r = {v: k for k, v in RENAME_MAP.items()}  # relation name -> raw name
    cols = []
    for c in CHARACTER_COLUMNS:
        src = F.col(r.get(c, c))
        if c in SMALLINT_COLUMNS:
            src = to_smallint(src)
        elif c in INT_COLUMNS:
            src = to_int(src)
        elif c == "source_id":
            src = src.cast("string")
        cols.append(src.alias(c))
    return clean.select(
        *cols,
        normalize_text("class_starting").isNotNull().alias(HAS_START),
        to_smallint("class_starting_level").alias(START_LEVEL),
        class_entries().alias(CLASSES),
        feat_entries().alias(FEATS),
        *(c for c in (PID, ROW) if c in clean.columns),
    ).withColumn("is_multiclass", F.size(CLASSES) > 1)


def character_rows(nested: DataFrame, key: str | None = None) -> DataFrame:
    head = [key] if key else []
    return nested.select(*head, *CHARACTER_COLUMNS, "is_multiclass")


def class_rows(nested: DataFrame, key: str = "source_id") -> DataFrame:
    """(key, class, subclass, level, _ord): ``_ord`` 0 is the starting class,
    which alone carries the starting level."""
    e = nested.select(key, HAS_START, START_LEVEL, F.posexplode(CLASSES).alias("_pos", "_e"))
    is_start = F.col(HAS_START) & (F.col("_pos") == 0)
    return e.select(
        key,
        F.col("_e.class").alias("class"),
        F.col("_e.subclass").alias("subclass"),
        F.when(is_start, F.col(START_LEVEL)).alias("level"),
        F.when(F.col(HAS_START), F.col("_pos")).otherwise(F.col("_pos") + 1).alias("_ord"),
    )


def feat_rows(nested: DataFrame, key: str = "source_id") -> DataFrame:
    return nested.select(key, F.posexplode(FEATS).alias("_ord", "feat"))


def split_lists(clean: DataFrame) -> DataFrame:
    """The three slash lists in relational form: (source_id, field, pos, item)."""
    fields = ["class_other", "subclass_other", "feats"]
    arr = F.array(*[F.struct(F.lit(f).alias("field"), split_list(f).alias("items")) for f in fields])
    per_field = clean.select(F.col("char_id").cast("string").alias("source_id"), F.explode(arr).alias("_f"))
    return per_field.select("source_id", F.col("_f.field").alias("field"),
                            F.posexplode("_f.items").alias("pos", "item"))


@dataclass
class Relations:
    character: DataFrame
    classes: DataFrame
    feats: DataFrame
    ordered: DataFrame | None = None  # the kept character rows that keyed relations come from

    def as_dict(self) -> dict[str, DataFrame]:
        return {"character": self.character, "character_class": self.classes, "character_feats": self.feats}


def source_order() -> list[Column]:
    """Insert order of characters: numeric ids numerically, others after, by text."""
    sid = F.col("source_id")
    return [sid.try_cast("decimal(38,0)").asc_nulls_last(), sid.asc()]


def build_relations(clean: DataFrame, keyed: bool = True) -> Relations:
    """character / character_class / character_feats.

    ``keyed``: dense surrogate keys 1..N in insert order (characters by
    source id; starting classes before other classes; feats by character
    and position). Characters take one balanced range sort, or none if ``clean``
    comes sorted with its rows' places (``clean_in_order``); class and feat
    rows are numbered inside its ranges. Unkeyed relations
    use ``source_id`` as the key and need no sort at all.
    """
    nested = nest(clean)
    if not keyed:
        return Relations(
            character_rows(nested),
            class_rows(nested).drop("_ord"),
            feat_rows(nested).drop("_ord"),
        )
    rows = kept(nested, "ordered") if PID in clean.columns else in_order(nested, source_order())
    ordered = positions(rows, "char_id")
    # Children are numbered from the kept, sorted character rows: starting
    # classes first, then the other classes, each by character and position;
    # feats by character and position.
    has_start, classes = F.col(HAS_START), F.col(CLASSES)
    none = F.lit(None).cast("smallint")

    def leveled(entries: Column, level: Column) -> Column:
        return F.transform(entries, lambda e: F.struct(e["class"].alias("class"), e["subclass"].alias("subclass"), level.alias("level")))

    starts = F.slice(classes, 1, F.when(has_start, 1).otherwise(0))
    rest = F.when(has_start, F.slice(classes, 2, F.greatest(F.size(classes) - 1, F.lit(0)))).otherwise(classes)
    class_entries_ = entry_positions(ordered, "char_id", [leveled(starts, F.col(START_LEVEL)), leveled(rest, none)], "class_id")
    feats = entry_positions(ordered, "char_id", [F.col(FEATS)], "feat_id")
    return Relations(character_rows(ordered, "char_id"),
                     class_entries_.select("class_id", "char_id", "entry.class", "entry.subclass", "entry.level"),
                     feats.select("feat_id", "char_id", F.col("entry").alias("feat")), rows)
