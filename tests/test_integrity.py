import pytest

from rosterlens.operators.integrity import IntegrityError, assert_sound, cascade_delete, check_relations, relation_counts

from conftest import rows


def test_checks_find_duplicates_nulls_and_orphans(spark):
    character = spark.createDataFrame([(1,), (2,), (2,)], "char_id long")
    classes = spark.createDataFrame([(1, 1, "F"), (2, 9, "W"), (3, None, None)], "class_id long, char_id long, class string")
    feats = spark.createDataFrame([(1, 1, "A"), (1, 2, "B")], "feat_id long, char_id long, feat string")
    got = {(r, c): v for r, c, v in rows(check_relations(character, classes, feats))}
    assert got[("character", "unique:char_id")] == 1
    assert got[("character_class", "foreign_key:char_id")] == 1
    assert got[("character_class", "not_null:class")] == 1
    assert got[("character_class", "not_null:char_id")] == 1
    assert got[("character_feats", "unique:feat_id")] == 1
    assert got[("character_feats", "foreign_key:char_id")] == 0


def test_cascade_delete_removes_children(spark):
    character = spark.createDataFrame([(1,), (2,)], "char_id long")
    classes = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "class_id long, char_id long")
    kept, kids = cascade_delete(character, {"c": classes}, spark.createDataFrame([(2,)], "char_id long"))
    assert rows(kept) == [(1,)]
    assert rows(kids["c"].select("class_id")) == [(1,)]


def test_relation_counts(spark):
    got = rows(relation_counts({"a": spark.range(3), "b": spark.range(0)}))
    assert got == [("a", 3), ("b", 0)]


def test_fixture_relations_are_sound(spark):
    from conftest import SF_SMALL
    from rosterlens.plans.registry import relations

    r = relations(spark, SF_SMALL)
    assert all(v == 0 for _, _, v in rows(check_relations(r.character, r.classes, r.feats)))
    # properties: source ids unique, dense keys 1..N, R5/R6 bounded by 6 x characters
    n = r.character.count()
    assert r.character.select("source_id").distinct().count() == n
    ids = sorted(x[0] for x in r.classes.select("class_id").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_assert_sound_raises_with_the_violations(spark):
    character = spark.createDataFrame([(1,)], "char_id long")
    classes = spark.createDataFrame([(1, 2, "F")], "class_id long, char_id long, class string")
    feats = spark.createDataFrame([(1, 1, "A")], "feat_id long, char_id long, feat string")
    with pytest.raises(IntegrityError, match="character_class.foreign_key:char_id: 1 rows"):
        assert_sound(character, classes, feats)
    assert_sound(character, classes.where("char_id = 1"), feats)


def test_report_properties_on_fixture(spark):
    from conftest import SF_SMALL
    from rosterlens.plans import reports
    from rosterlens.plans.registry import relations

    r = relations(spark, SF_SMALL)
    n = r.character.count()
    for df, col in ((reports.maxed_stats(r), "maxed_count"), (reports.dump_stats(r), "dump_count")):
        counts = [row[col] for row in df.collect()]
        assert all(c <= n for c in counts) and sum(counts) <= 6 * n
    rates = reports.multiclass_rate_by_class(r).collect()
    assert rates and all(0 <= x["multiclass_rate_pct"] <= 100 for x in rates)
    assert all(x["multiclass_characters"] <= x["characters_with_class"] for x in rates)
    # R3 (class rows) and R10 (flag made inside each row) agree
    assert reports.multiclass_count(r).first()[0] == reports.dashboard_kpis(r).first()["multiclass_characters"]
