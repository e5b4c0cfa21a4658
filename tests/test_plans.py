"""Plan properties: no Python in any registered query, skew-safe top-1
windows, one scan for the unpivots."""

import pytest

from rosterlens.plans import registry

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_python_udf_in_plan(spark, name):
    p = plan(registry.QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name} runs Python: {node}"


def test_latest_version_is_limited_before_the_shuffle(spark):
    from rosterlens.plans.clean import latest_versions, parse_dates

    df = latest_versions(parse_dates(registry.raw(spark, SF_SMALL)))
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p and "Partial" in p


def test_top_subclass_uses_window_group_limit(spark):
    p = plan(registry.QUERIES["top_subclass_per_class"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_stat_reports_are_one_pass(spark):
    from rosterlens.plans import reports

    rels = registry.relations(spark, SF_SMALL)
    for fn in (reports.maxed_stats, reports.dump_stats):
        p = plan(fn(rels))
        assert p.count("FileScan parquet") == 1      # six stats, one scan
        assert "Expand" not in p and "hashpartitioning" not in p


def test_report_scans_prune_columns_and_push_filters(spark):
    df = registry.QUERIES["race_popularity"](spark, SF_SMALL)
    df._jdf.queryExecution().executedPlan()  # planned
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<race:string>" in formatted
    assert "IsNotNull(race)" in formatted


def test_bucketed_relations_need_no_shuffle_for_character_joins(spark):
    import re

    from rosterlens.plans import reports

    rels = registry.relations(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rels.classes.join(rels.character, "char_id")
        assert "Exchange" not in plan(joined)
        per_char = plan(reports.multiclass_count(rels))
        assert len(re.findall(r"Exchange hashpartitioning", per_char)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
