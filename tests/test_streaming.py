import os
import tempfile

from rosterlens.plans.clean import clean_profiles
from rosterlens.sources.csv_landing import read_landed
from rosterlens.streaming import land_csv_stream

COLS = ["char_id", "name", "date_modified"]


def test_drop_folder_is_landed_once_and_incrementally(spark):
    d = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("char_id,name,date_modified\n1,Ann,2020-01-01\n2,Bob,2020-01-01\n,NoKey,2020-01-01\n")
    land_csv_stream(spark, src, out, ck, COLS)
    assert read_landed(spark, out).count() == 2
    assert read_landed(spark, out, "null_key").count() == 1
    # nothing new: nothing landed twice
    land_csv_stream(spark, src, out, ck, COLS)
    assert read_landed(spark, out).count() == 2
    # a later file with a newer version of 1 and the same date for 2
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("char_id,name,date_modified\n1,Ann2,2021-01-01\n2,Bob2,2020-01-01\n")
    land_csv_stream(spark, src, out, ck, COLS)
    rows = sorted((r["char_id"], r["name"]) for r in clean_profiles(read_landed(spark, out)).collect())
    assert rows == [("1", "Ann2"), ("2", "Bob2")]    # same date: the later-landed row wins


def test_files_of_one_batch_go_by_their_own_headers(spark):
    d = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    for name, text in (("a.csv", "char_id,name,date_modified\n1,Ann,2020-01-01\n"),
                       ("b.csv", "name,char_id\nBob,2\n")):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    assert land_csv_stream(spark, src, out, ck, COLS) == 1
    got = sorted((r["char_id"], r["name"], r["date_modified"]) for r in read_landed(spark, out).collect())
    assert got == [("1", "Ann", "2020-01-01"), ("2", "Bob", None)]


def test_pipeline_with_incremental_landing(spark):
    from rosterlens.plans.etl import Settings, run_pipeline
    from tests_pipeline_data import HEADER, ROWS

    d = tempfile.mkdtemp(prefix="stream-etl-", dir="/tmp")
    src = os.path.join(d, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(HEADER + "\n".join(ROWS[:1]) + "\n")
    from rosterlens.sources import sinks
    sinks.create_schema(spark, "stream_db", location=os.path.join(d, "db"))
    settings = Settings(source=src, landing=os.path.join(d, "landed"), stream_checkpoint=os.path.join(d, "ck"),
                        database="stream_db")
    assert run_pipeline(spark, settings)["character"] == 1
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(HEADER + "\n".join(ROWS[1:]) + "\n")
    counts = run_pipeline(spark, settings)
    assert counts == {"character": 2, "character_class": 4, "character_feats": 2}
    spark.sql("DROP DATABASE IF EXISTS stream_db CASCADE")
