from rosterlens.plans.clean import clean_profiles, coerce_numerics, first_versions, latest_versions, normalize_names, parse_dates

from conftest import rows

COLS = "src_ord long, char_id string, name string, date_modified string"


def test_latest_version_unparsable_date_wins_and_ties_go_to_later_row(spark):
    df = spark.createDataFrame([
        (0, "1", "a", "2020-01-01"), (1, "1", "b", "2021-01-01"),
        (2, "2", "c", "2021-01-01"), (3, "2", "d", "garbage"),
        (4, "3", "e", "2021-01-01"), (5, "3", "f", "2021-01-01"),
    ], COLS)
    got = rows(latest_versions(parse_dates(df)).select("char_id", "name"))
    assert got == [("1", "b"), ("2", "d"), ("3", "f")]


def test_names_are_filtered_before_the_latest_version_is_chosen(spark):
    df = spark.createDataFrame([(0, "1", " Old ", "2020-01-01"), (1, "1", "X's Character", "2021-01-01"),
                                (2, "2", "nan", "2020-01-01")], COLS)
    got = rows(latest_versions(parse_dates(normalize_names(df))).select("char_id", "name"))
    assert got == [("1", "Old")]


def test_first_versions_keeps_source_order(spark):
    df = spark.createDataFrame([(3, "1", "late", None), (1, "1", "early", None)], COLS)
    assert rows(first_versions(df).select("name")) == [("early",)]


def test_rules_apply_to_present_columns_only(spark):
    df = spark.createDataFrame([("1", "25", "-3")], "char_id string, total_level string, base_hp string")
    assert rows(coerce_numerics(df)) == [("1", None, None)]


def test_clean_profiles_without_date_column_keeps_first(spark):
    df = spark.createDataFrame([(0, "1", "a"), (1, "1", "b")], "src_ord long, char_id string, name string")
    assert rows(clean_profiles(df).select("name")) == [("a",)]


def test_cleaning_is_idempotent_on_its_output(spark):
    from conftest import SF_SMALL
    from rosterlens.plans.registry import cleaned

    once = cleaned(spark, SF_SMALL)
    as_raw = once.select(*[once[c].cast("string").alias(c) if c != "src_ord" else once[c] for c in once.columns])
    assert rows(clean_profiles(as_raw).select("char_id", "name", "total_level")) == \
        rows(once.select("char_id", "name", "total_level"))


def test_parse_dates_default_iso_and_explicit_format(spark):
    df = spark.createDataFrame([("2020-01-02",), ("2020-01-02T03:04:05",), ("01/02/2020",), ("garbage",)],
                               "date_modified string")
    iso = [r[0] for r in parse_dates(df).collect()]
    assert [str(v) if v else None for v in iso] == ["2020-01-02 00:00:00", "2020-01-02 03:04:05", None, None]
    us = [r[0] for r in parse_dates(df, "MM/dd/yyyy").collect()]
    assert [str(v) if v else None for v in us] == [None, None, "2020-01-02 00:00:00", None]
