from pyspark.sql import functions as F

from rosterlens.plans.model import build_relations, split_lists

from conftest import rows

RAW = ("char_id string, name string, class_starting string, subclass_starting string, "
       "class_starting_level double, class_other string, subclass_other string, feats string")


def rel(spark, data, keyed=False):
    df = spark.createDataFrame(data, RAW)
    for c in ["race", "background", "date_modified"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    for c in ["total_level", "base_hp", "stats_1", "stats_2", "stats_3", "stats_4", "stats_5", "stats_6", "notes_len"]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    df = df.withColumn("date_modified", F.lit(None).cast("timestamp"))
    return build_relations(df, keyed=keyed)


def test_zipped_explode_after_filtering_lists(spark):
    # 'None' is dropped from the subclass list before zipping, so Rogue
    # pairs with Evocation and Wizard has no subclass.
    r = rel(spark, [("1", "a", None, None, None, "Rogue/Wizard", "None/Evocation", None)])
    assert rows(r.classes) == [("1", "Rogue", "Evocation", None), ("1", "Wizard", None, None)]


def test_starting_class_first_keeps_level_and_wins_duplicates(spark):
    # others zip to (Fighter, x), (Fighter, y), (Cleric, None); the starting
    # row (Fighter, None, level 3) comes first and keeps its level.
    r = rel(spark, [("1", "a", " Fighter ", " None ", 3.0, "Fighter/Fighter/Cleric/Fighter", "x/y", "A / B/ a / A")])
    assert rows(r.classes) == [("1", "Cleric", None, None), ("1", "Fighter", "x", None),
                               ("1", "Fighter", "y", None), ("1", "Fighter", None, 3)]
    assert rows(r.feats) == [("1", "A"), ("1", "B"), ("1", "a")]


def test_multiclass_flag_counts_class_rows(spark):
    r = rel(spark, [("1", "a", "Fighter", "x", None, "Fighter", "y", None),
                    ("2", "b", "Fighter", None, None, None, None, None),
                    ("3", "c", None, None, None, None, None, None)])
    assert rows(r.character.select("source_id", "is_multiclass")) == [("1", True), ("2", False), ("3", False)]


def test_keyed_relations_follow_insert_order(spark):
    r = rel(spark, [("10", "a", "F", None, 1.0, "C/D", None, "x/y"), ("9", "b", None, None, None, "E", None, "z"),
                    ("x1", "c", "G", None, None, None, None, None)], keyed=True)
    assert rows(r.character.select("char_id", "source_id")) == [(1, "9"), (2, "10"), (3, "x1")]
    # starting classes first (by character), then the others by character and position
    assert rows(r.classes.select("class_id", "char_id", "class")) == \
        [(1, 2, "F"), (2, 3, "G"), (3, 1, "E"), (4, 2, "C"), (5, 2, "D")]
    assert rows(r.feats.select("feat_id", "char_id", "feat")) == [(1, 1, "z"), (2, 2, "x"), (3, 2, "y")]


def test_split_lists_relational_form(spark):
    df = spark.createDataFrame([("1", "A/ B", None, "f")], "char_id string, class_other string, "
                                                            "subclass_other string, feats string")
    assert rows(split_lists(df)) == [("1", "class_other", 0, "A"), ("1", "class_other", 1, "B"), ("1", "feats", 0, "f")]
