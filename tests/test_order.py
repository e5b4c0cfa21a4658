"""Ordered reports come in the order that they state: checked row by row, since the oracle test compares sorted rows."""

import pytest

from rosterlens.plans import explore, registry, reports

from conftest import SF_SMALL

# (report, sort keys): a leading minus sorts descending
ORDERED = {
    "class_popularity": ("-character_count", "class"),
    "race_popularity": ("-character_count", "race"),
    "maxed_stats": ("-maxed_count", "stat_name"),
    "dump_stats": ("-dump_count", "stat_name"),
    "class_notes_summary": ("-avg_notes_len", "class"),
    "top_subclass_per_class": ("class",),
    "multiclass_rate_by_class": ("-multiclass_rate_pct", "-characters_with_class", "class"),
    "top_classes": ("-character_count", "class"),
    "top_races": ("-character_count", "race"),
    "maxed_sorted": ("-maxed_count", "stat_name"),
    "dump_sorted": ("-dump_count", "stat_name"),
    "top_subclasses": ("-subclass_count", "class"),
    "notes_filtered": ("-avg_notes_len", "class"),
    "multiclass_filtered": ("-multiclass_rate_pct", "-characters_with_class", "class"),
    "explorer_page": ("-count", "metric", "category"),
}


def in_order(rows, keys):
    """Stable sorts from the last key to the first give the stated order."""
    out = list(rows)
    for key in reversed(keys):
        out.sort(key=lambda r: r[key.lstrip("-")], reverse=key.startswith("-"))
    return out


@pytest.mark.parametrize("name", list(ORDERED))
def test_rows_come_in_the_stated_order(spark, name):
    rows = registry.QUERIES[name](spark, SF_SMALL).collect()
    assert len(rows) > 1 and rows == in_order(rows, ORDERED[name])


def test_default_exclusions_drop_their_classes(spark):
    """D6 and D7 with the dashboard's own pattern, on classes that match it in any case."""
    from rosterlens.plans.model import Relations

    classes = spark.createDataFrame(
        [(1, 1, "Artificer", None, 3), (2, 1, "Bard", None, None), (3, 2, "BLOOD HUNTER", "x", 2), (4, 3, "Bard", "y", 1)],
        "class_id long, char_id long, class string, subclass string, level smallint")
    character = spark.createDataFrame([(1, 10), (2, 20), (3, 40)], "char_id long, notes_len int")
    rels = Relations(character, classes, None)
    assert [tuple(r) for r in explore.notes_filtered(rels).collect()] == [("Bard", 2, 25.0, 25.0)]
    assert [tuple(r) for r in explore.multiclass_filtered(rels).collect()] == [("Bard", 2, 1, 50.0)]
    assert {r["class"] for r in reports.class_notes_summary(rels).collect()} == {"Artificer", "Bard", "BLOOD HUNTER"}
