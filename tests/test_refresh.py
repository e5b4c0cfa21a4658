"""A refresh keeps the old tables until the new ones are checked; file sets land by name and in file order."""

import os
import re

import pytest

from conftest import SF_SMALL, rows
from rosterlens.plans.clean import latest_versions
from rosterlens.plans.etl import LOAD_COLUMNS, Settings, refresh
from rosterlens.sources import sinks
from rosterlens.sources.csv_landing import file_headers, land_csv, read_landed, read_profile_csv
from rosterlens.streaming import land_csv_stream
from tests_pipeline_data import HEADER, ROWS


def write(path, *lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def settings(tmp_path, name, source, **more):
    return Settings(source=source, landing=str(tmp_path / f"{name}-landed"), database=name,
                    database_location=str(tmp_path / f"{name}-db"), buckets=2, **more)


def test_failed_refresh_keeps_the_old_tables(spark, tmp_path):
    good = write(tmp_path / "good.csv", HEADER.rstrip(), *ROWS)
    refresh(spark, settings(tmp_path, "keeps", good))
    before = rows(spark.table("keeps.character"))
    assert spark.catalog.currentDatabase() == "keeps"
    bad = write(tmp_path / "bad.csv", HEADER.rstrip(), ROWS[0].replace(",30,", ",40000,"))
    with pytest.raises(Exception):
        refresh(spark, settings(tmp_path, "keeps", bad))
    assert before and rows(spark.table("keeps.character")) == before
    assert spark.table("keeps.character").columns == LOAD_COLUMNS["character"] and len(LOAD_COLUMNS["character"]) == 15
    assert spark.sql("select * from keeps.vw_dashboard_kpis").first()["total_characters"] == len(before)
    spark.catalog.setCurrentDatabase("default")


def test_views_belong_to_their_database(spark, tmp_path):
    one = write(tmp_path / "one.csv", HEADER.rstrip(), *ROWS)
    two = write(tmp_path / "two.csv", HEADER.rstrip(), ROWS[0])
    refresh(spark, settings(tmp_path, "view_a", one))
    refresh(spark, settings(tmp_path, "view_b", two))
    n = [spark.sql(f"select total_characters from {db}.vw_dashboard_kpis").first()[0] for db in ("view_a", "view_b")]
    spark.catalog.setCurrentDatabase("default")
    assert n == [2, 1]


def test_header_only_source_gives_empty_tables(spark, tmp_path):
    src = write(tmp_path / "empty.csv", HEADER.rstrip())
    assert refresh(spark, settings(tmp_path, "empty_db", src)) == {
        "character": 0, "character_class": 0, "character_feats": 0}
    spark.catalog.setCurrentDatabase("default")


def test_jdbc_refresh_writes_the_declared_columns(spark, tmp_path, monkeypatch):
    written = {}
    monkeypatch.setattr(sinks, "write_jdbc", lambda df, url, table, properties, **o: written.update({table: (df.columns, o)}))
    src = write(tmp_path / "in.csv", HEADER.rstrip(), *ROWS)
    counts = refresh(spark, Settings(source=src, database="remote", jdbc_url="jdbc:none", jdbc_partitions=3))
    assert counts["character"] == 2
    assert {t: c for t, (c, _) in written.items()} == {f"remote.{n}": c for n, c in LOAD_COLUMNS.items()}
    assert all(o == {"num_partitions": 3} for _, o in written.values())
    assert not spark.catalog.databaseExists("remote")


def test_columns_go_by_each_files_header(spark, tmp_path):
    write(tmp_path / "a.csv", "char_id,name,race", "1,Ann,Elf")
    write(tmp_path / "b.csv", "name,char_id", "Bob,2")
    df = read_profile_csv(spark, str(tmp_path))
    assert rows(df.select("char_id", "name", "race", "_status")) == [("1", "Ann", "Elf", "ok"), ("2", "Bob", None, "ok")]
    assert len(file_headers(spark, str(tmp_path))) == 2


def test_later_file_wins_a_tie_whatever_its_size(spark, tmp_path):
    head = "char_id,name,date_modified"
    write(tmp_path / "2020.csv", head, "1,Old,2020-01-01")
    write(tmp_path / "2021.csv", head, "1,New,2020-01-01", *(f"{i},{'x' * 50},2020-01-01" for i in range(2, 400)))
    out = str(tmp_path / "landed")
    land_csv(spark, str(tmp_path / "202*.csv"), out)
    df = latest_versions(read_landed(spark, out))
    assert df.where("char_id = '1'").first()["name"] == "New"


def test_a_replayed_batch_lands_once(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    columns = ["char_id", "name"]
    write(src / "a.csv", "char_id,name", "1,Ann", "2,Bob")
    out, checkpoint = str(tmp_path / "out"), tmp_path / "checkpoint"
    assert land_csv_stream(spark, str(src), out, str(checkpoint), columns) == 1
    for f in os.listdir(checkpoint / "commits"):  # as after a crash between the write and the commit
        if re.fullmatch(r"\.?0(\.crc)?", f):
            os.remove(checkpoint / "commits" / f)
    land_csv_stream(spark, str(src), out, str(checkpoint), columns)
    assert read_landed(spark, out).count() == 2


def test_the_fixture_uses_every_line(spark):
    from pyspark.sql import functions as F

    from rosterlens.sources.fixtures import raw_profiles

    used = raw_profiles(spark, SF_SMALL).where("src_ord = 0").agg(F.sum(F.size(F.split("feats", " / ")))).first()[0]
    assert used == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()

TINY = {"character": "a int", "character_class": "a int", "character_feats": "a int"}


def _tiny_load(spark, db, n, monkeypatch=None, stop=None):
    """A load of three one-row tables holding ``n``; ``stop``: the catalog statement at which it is killed."""
    from pyspark.sql import types as T

    tables = {t: T.StructType([T.StructField("a", T.IntegerType())]) for t in TINY}
    ran = []

    def execute(session, sql):
        if stop is not None and len(ran) == stop:
            raise KeyboardInterrupt(sql)
        ran.append(sql)
        session.sql(sql)

    if monkeypatch:
        monkeypatch.setattr(sinks, "execute", execute)
    version = sinks.begin_load(spark, db, tables)
    for t in TINY:
        sinks.write_table(spark.createDataFrame([(n,)], "a int"), db, sinks.versioned(t, version))
    sinks.publish(spark, db, tables, version)
    return ran


def _seen(spark, db):
    return {tuple(r[0] for r in spark.table(f"{db}.{t}").collect()) for t in TINY}


def test_a_load_killed_at_any_statement_leaves_one_version(spark, tmp_path, monkeypatch):
    db = "killed"
    sinks.create_schema(spark, db, location=str(tmp_path / "db"))
    _tiny_load(spark, db, 1)
    _tiny_load(spark, db, 2)
    statements = len(_tiny_load(spark, db, 3, monkeypatch))
    assert statements >= 10 and _seen(spark, db) == {(3,)}
    now = 3
    for stop in range(statements):
        with pytest.raises(KeyboardInterrupt):
            _tiny_load(spark, db, 100 + stop, monkeypatch, stop)
        seen = _seen(spark, db)
        assert seen in ({(now,)}, {(100 + stop,)}), (stop, seen)
        now = next(iter(seen))[0]
        folders = {r[0] for df in sinks.load_folders(spark, str(tmp_path / "db"), list(TINY)) for r in df.collect()}
        assert len(folders) == 1
    _tiny_load(spark, db, 7, monkeypatch)
    assert _seen(spark, db) == {(7,)}
    # the published load and the one before it stay, nothing else
    _tiny_load(spark, db, 8, monkeypatch)
    assert len(sinks.load_versions(spark, db, list(TINY))) <= 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_an_old_load_is_pruned_from_the_views_while_both_are_there(spark, tmp_path, monkeypatch):
    from pyspark.sql import types as T

    db = "pruned"
    tables = {t: T.StructType([T.StructField("a", T.IntegerType())]) for t in TINY}
    sinks.create_schema(spark, db, location=str(tmp_path / "db"))
    _tiny_load(spark, db, 1)
    _tiny_load(spark, db, 2)
    sinks._show(spark, db, tables, [1, 2])
    p = spark.table(f"{db}.character")._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1 and "Union" not in p and _seen(spark, db) == {(2,)}
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_a_refresh_of_real_tables_killed_midway_keeps_the_old_ones(spark, tmp_path, monkeypatch):
    one = write(tmp_path / "one.csv", HEADER.rstrip(), *ROWS)
    two = write(tmp_path / "two.csv", HEADER.rstrip(), ROWS[0])
    refresh(spark, settings(tmp_path, "midway", one))
    write_table = sinks.write_table

    def third_fails(df, database, table, **more):
        if table.startswith("character_feats"):
            raise KeyboardInterrupt
        write_table(df, database, table, **more)

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_table", third_fails)
        with pytest.raises(KeyboardInterrupt):
            refresh(spark, settings(tmp_path, "midway", two))
    assert [spark.table(f"midway.{t}").count() for t in LOAD_COLUMNS] == [2, 4, 2]
    assert refresh(spark, settings(tmp_path, "midway", two)) == {
        t: spark.table(f"midway.{t}").count() for t in LOAD_COLUMNS}
    joined = spark.table("midway.character_class").join(spark.table("midway.character").hint("merge"), "char_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()  # buckets are seen through the views
    spark.catalog.setCurrentDatabase("default")


def test_two_databases_and_hiding_views(spark, tmp_path):
    """Reports of one database do not show another's, and a temporary view of a report's name is refused."""
    from rosterlens.plans import registry
    from rosterlens.sources.tables import load_view

    registry.QUERIES["view_lookup"](spark, SF_SMALL).count()
    src = write(tmp_path / "one.csv", HEADER.rstrip(), ROWS[0])
    refresh(spark, settings(tmp_path, "second", src))
    assert spark.table("vw_dashboard_kpis").first()["total_characters"] == 1
    assert load_view(spark, "vw_dashboard_kpis").first()["total_characters"] == 1
    spark.range(1).createOrReplaceTempView("vw_dashboard_kpis")
    try:
        assert load_view(spark, "vw_dashboard_kpis", "second").first()["total_characters"] == 1
        with pytest.raises(ValueError, match="vw_dashboard_kpis"):
            refresh(spark, settings(tmp_path, "second", src))
    finally:
        spark.catalog.dropTempView("vw_dashboard_kpis")
    spark.catalog.setCurrentDatabase("default")


def test_plain_tables_are_not_replaced(spark, tmp_path):
    sinks.create_schema(spark, "plain_db", location=str(tmp_path / "db"))
    spark.range(1).write.saveAsTable("plain_db.character")
    with pytest.raises(ValueError, match="character"):
        refresh(spark, settings(tmp_path, "plain_db", write(tmp_path / "a.csv", HEADER.rstrip(), ROWS[0])))
    assert spark.table("plain_db.character").count() == 1
    spark.sql("DROP DATABASE plain_db CASCADE")
