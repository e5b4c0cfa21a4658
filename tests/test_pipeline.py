import os
import tempfile

from rosterlens.plans.etl import Settings, refresh, run_pipeline
from rosterlens.sources import sinks

from tests_pipeline_data import HEADER, ROWS


def test_refresh_loads_tables_and_views(spark, tmp_path=None):
    d = tempfile.mkdtemp(prefix="etl-", dir="/tmp")
    src = os.path.join(d, "profiles.csv")
    with open(src, "w") as f:
        f.write(HEADER + "\n".join(ROWS) + "\n")
    db = "characters_test"
    counts = refresh(spark, Settings(source=src, landing=os.path.join(d, "landed"), database=db,
                                      database_location=os.path.join(d, "db")))
    assert counts == {"character": 2, "character_class": 4, "character_feats": 2}
    assert spark.table(f"{db}.character").count() == 2
    top = {r["class"]: r["most_popular_subclass"] for r in spark.table("vw_top_subclass_per_class").collect()}
    assert top == {"Wizard": "Evocation", "Fighter": "Champion", "Cleric": "Life"}
    assert spark.table("vw_dashboard_kpis").first()["total_characters"] == 2
    # Unqualified names resolve in the chosen database
    from rosterlens.sources.tables import load_view
    previous = spark.catalog.currentDatabase()
    sinks.use_schema(spark, db)
    try:
        assert spark.table("character_class").count() == 4
        assert load_view(spark, "character_feats", database=db).count() == 2
    finally:
        sinks.use_schema(spark, previous)
    # a second full refresh replaces, it does not append
    assert run_pipeline(spark, Settings(source=src, database=db, sample_rows=2, validate=True)) == \
        {"character": 1, "character_class": 3, "character_feats": 1}
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_sink_rows_turn_nan_into_null(spark):
    df = spark.createDataFrame([(float("nan"), 1)], "x double, y int")
    assert sinks.sink_rows(df, ["x", "y"]).first()["x"] is None


def test_bucketed_tables_join_without_shuffle(spark):
    """Tables written bucketed on char_id: R7's join reads co-located files."""
    from rosterlens.plans import reports
    from rosterlens.plans.model import Relations
    from rosterlens.plans.etl import LOAD_COLUMNS
    from rosterlens.plans.registry import relations

    from conftest import SF_SMALL

    d = tempfile.mkdtemp(prefix="bucket-", dir="/tmp")
    db = "characters_bucketed"
    sinks.create_schema(spark, db, drop=True, location=os.path.join(d, "db"))
    sinks.write_relations(relations(spark, SF_SMALL).as_dict(), db, LOAD_COLUMNS, buckets=4)
    tables = Relations(*(spark.table(f"{db}.{n}") for n in LOAD_COLUMNS))
    joined = tables.classes.join(tables.character, "char_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert reports.class_notes_summary(tables).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_cli_refresh_report_check(spark, capsys):
    from rosterlens.__main__ import main

    d = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    src = os.path.join(d, "profiles.csv")
    with open(src, "w") as f:
        f.write(HEADER + "\n".join(ROWS) + "\n")
    loc = os.path.join(d, "db")
    assert main(["refresh", "--source", src, "--database", "cli_test", "--database-location", loc,
                 "--partitions", "4"]) == 0
    assert '"character": 2' in capsys.readouterr().out
    assert main(["report", "class_popularity", "--tables", loc, "--partitions", "4"]) == 0
    out = capsys.readouterr().out
    assert "Fighter" in out and "Wizard" in out
    assert main(["check", "--database", "cli_test", "--partitions", "4"]) == 0
    spark.sql("DROP DATABASE IF EXISTS cli_test CASCADE")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
