import pytest
from pyspark.sql import functions as F

from rosterlens.plans import explore, reports
from rosterlens.plans.model import Relations
from rosterlens.schema import CHARACTER_SCHEMA, CLASS_SCHEMA, FEAT_SCHEMA

from conftest import rows


@pytest.fixture(scope="module")
def rels(spark):
    # char 1: Fighter twice (two subclasses) -> multiclass by rows, not by classes
    # char 2: Fighter + Wizard; char 3: Wizard only; char 4: no class rows
    chars = [
        (1, "s1", "A", "Elf", None, 20, 10, 20, 8, 8, 12, 9, 10, 100, None),
        (2, "s2", "B", "Elf", None, 5, 10, 8, 8, 20, 21, 12, 8, 300, None),
        (3, "s3", "C", "", None, None, 10, None, None, None, None, None, None, None, None),
        (4, "s4", "D", None, None, 20, 10, 15, 15, 15, 15, 15, 15, 50, None),
    ]
    character = spark.createDataFrame(chars, CHARACTER_SCHEMA).withColumn(
        "is_multiclass", F.col("char_id").isin(1, 2))
    classes = spark.createDataFrame([
        (1, 1, "Fighter", "Champion", 1), (2, 1, "Fighter", "Battle Master", None),
        (3, 2, "Fighter", "Champion", 2), (4, 2, "Wizard", None, None), (5, 3, "Wizard", "Evocation", 3),
    ], CLASS_SCHEMA)
    feats = spark.createDataFrame([(1, 1, "Alert")], FEAT_SCHEMA)
    return Relations(character, classes, feats)


def test_r1_counts_distinct_characters(rels):
    assert rows(reports.class_popularity(rels)) == [("Fighter", 2), ("Wizard", 2)]


def test_r2_skips_null_and_empty_race(rels):
    assert rows(reports.race_popularity(rels)) == [("Elf", 2)]


def test_r3_rows_vs_r9_distinct_classes(rels):
    assert rows(reports.multiclass_count(rels)) == [(2,)]
    got = rows(reports.multiclass_rate_by_class(rels, ordered=False))
    assert got == [("Fighter", 2, 1, 50.0), ("Wizard", 2, 1, 50.0)]


def test_r4_and_r10(rels):
    assert rows(reports.level_20_count(rels)) == [(2,)]
    assert rows(reports.dashboard_kpis(rels)) == [(4, 2, 2, 15.0)]
    assert rows(reports.kpi_cards(rels)) == sorted([("Total Characters", "4"), ("Multiclass Characters", "2"),
                                                    ("Level 20 Characters", "2"), ("Average Level", "15.00")])


def test_r5_maxed_and_r6_dump_ties(rels):
    assert rows(reports.maxed_stats(rels)) == [("con", 1), ("int", 1), ("str", 1)]
    # char 1: min 8 at dex, con; char 2: min 8 at str, dex, cha; char 4: all six tie; char 3: all null
    assert rows(reports.dump_stats(rels)) == [("cha", 2), ("con", 2), ("dex", 3), ("int", 1), ("str", 2), ("wis", 1)]


def test_r7_avg_and_median_per_class_row(rels):
    got = rows(reports.class_notes_summary(rels))
    # Fighter rows: char1 twice (100, 100) and char2 (300): mean 166.67, median 100
    assert got[0][0] == "Fighter" and got[0][1] == 2
    assert got[0][2] == pytest.approx(500 / 3) and got[0][3] == 100.0
    assert got[1] == ("Wizard", 1, 300.0, 300.0)


def test_r8_top_subclass_tie_break(rels):
    assert rows(reports.top_subclass_per_class(rels)) == [("Fighter", "Champion", 2), ("Wizard", "Evocation", 1)]


def test_d6_exclusion_keeps_null_class(spark, rels):
    got = rows(explore.notes_filtered(rels, pattern="wiz"))
    assert [g[0] for g in got] == ["Fighter"]


def test_d8_explorer_has_nine_metrics_and_d9_pages_do_not_overlap(rels):
    union = explore.explorer_union(rels)
    assert union.select("metric").distinct().count() == 9
    n = union.count()
    pages = [rows(explore.explorer_page(rels, page_no=p, size=4)) for p in range(0, (n + 3) // 4)]
    flat = [r for p in pages for r in p]
    assert len(flat) == n and len(set(flat)) == n


def test_d10_correlation_null_on_zero_variance(rels):
    cells = {(x, y): c for x, y, c in rows(explore.correlation_matrix(rels))}
    assert len(cells) == 81
    assert cells[("hp", "hp")] is None and cells[("hp", "str")] is None   # hp is constant
    assert cells[("str", "str")] == 1.0
    assert cells[("str", "dex")] == cells[("dex", "str")]


def test_r8_tie_break_collation(spark):
    from rosterlens.schema import CLASS_SCHEMA

    classes = spark.createDataFrame([(1, 1, "F", "B", None), (2, 2, "F", "a", None)], CLASS_SCHEMA)
    rels = Relations(None, classes, None)
    assert rows(reports.top_subclass_per_class(rels)) == [("F", "B", 1)]
    assert rows(reports.top_subclass_per_class(rels, collation="UNICODE")) == [("F", "a", 1)]


def test_d9_custom_order_and_filter(rels):
    got = [tuple(r) for r in explore.explorer_page(rels, where="metric = 'class_popularity'",
                                                   order=[F.asc("category")], size=5).collect()]
    assert got == [("class_popularity", "Fighter", 2.0), ("class_popularity", "Wizard", 2.0)]
