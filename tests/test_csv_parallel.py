"""One CSV file by many tasks: records, order, status and bytes read, against one task and Python's csv."""

import csv
import glob
import io
import json
import os
import random
import subprocess
import sys

import pytest

from rosterlens.sources import csv_landing as landing

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def field(rnd):
    k = rnd.random()
    if k < .3:
        return rnd.choice(["x", "", "abc", " sp ", "NA", "é日"])
    if k < .5:
        return '"' + rnd.choice(["a,b", "l1\nl2", 'q""q', "\n\n", "", '""', ',\n"",', "x" * 300, "\n" * 5]) + '"'
    if k < .6:
        return rnd.choice(['5"', 'a"b"c', 'x"'])
    return str(rnd.randint(0, 9999))


def make(path, rnd, rows, end="\n", head="char_id,a,b,c"):
    with open(path, "w", newline="") as f:
        f.write(head + end)
        for i in range(rows):
            f.write(",".join([str(i) if rnd.random() < .95 else "", *(field(rnd) for _ in range(rnd.choice([3, 3, 3, 2, 4, 5])))]) + end)
            if rnd.random() < .02:
                f.write(end)
    return str(path)


@pytest.fixture
def ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [134217728, 1500, 97])
def test_many_tasks_give_the_rows_of_one(spark, tmp_path, ranges, size):
    rnd = random.Random(size)
    make(tmp_path / "a.csv", rnd, 150)
    make(tmp_path / "b.csv", rnd, 150, head='"char_id","b","a\nline",c')
    whole = [(r["src_ord"]["file"], *(r[c] for c in ("char_id", "a", "b", "c")))
             for r in landing.read_profile_csv(spark, str(tmp_path), ["char_id", "a", "b", "c"], by_file=True).orderBy("src_ord").collect()]
    ranges(size)
    df = landing.read_profile_csv(spark, str(tmp_path), ["char_id", "a", "b", "c"])
    rows = df.orderBy("src_ord").collect()
    assert [(r["src_ord"]["file"], *(r[c] for c in ("char_id", "a", "b", "c"))) for r in rows] == whole
    # status by Python's csv, which counts the fields of each record
    want = []
    for name in ("a.csv", "b.csv"):
        records = [r for r in csv.reader(io.StringIO((tmp_path / name).read_bytes().decode(), newline="")) if r]
        want += ["long_row" if len(r) > 4 else "null_key" if not r[0] else "ok" for r in records[1:]]
    assert [r["_status"] for r in rows] == want


def test_line_ends_and_empty_files(spark, tmp_path, ranges):
    make(tmp_path / "crlf.csv", random.Random(1), 60, end="\r\n")
    (tmp_path / "zero.csv").write_text("")
    (tmp_path / "head.csv").write_text("char_id,a")
    (tmp_path / "bom.csv").write_text("﻿char_id,a\n1,x\n", encoding="utf-8")
    ranges(50)
    df = landing.read_profile_csv(spark, str(tmp_path / "crlf.csv"))
    records = [r for r in csv.reader(io.StringIO((tmp_path / "crlf.csv").read_bytes().decode(), newline="")) if r][1:]
    got = [r["char_id"] for r in df.orderBy("src_ord").collect()]
    assert got == [r[0] or None for r in records]
    rows = landing.read_profile_csv(spark, [str(tmp_path / n) for n in ("head.csv", "bom.csv")]).collect()
    assert [(r["char_id"], r["a"]) for r in rows] == [("1", "x")]
    assert landing.file_headers(spark, str(tmp_path / "zero.csv")) == []
    assert landing.read_profile_csv(spark, str(tmp_path / "zero.csv"), ["char_id"]).count() == 0


def test_extra_field_beside_an_empty_one_is_a_long_row(spark, tmp_path):
    (tmp_path / "x.csv").write_text('char_id,name\n1,a\n2,B,,x\n3,,\n4\n5,"a,b"\n6,"a,b",\n')
    got = {r["char_id"]: r["_status"] for r in landing.read_profile_csv(spark, str(tmp_path / "x.csv")).collect()}
    assert got == {"1": "ok", "2": "long_row", "3": "long_row", "4": "ok", "5": "ok", "6": "long_row"}


SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.compress", "false").config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.files.maxPartitionBytes", str(1 << 20)).getOrCreate())
from rosterlens.plans.etl import Settings, extract
if sys.argv[3] == "all":
    from rosterlens.sources import csv_landing
    csv_landing.land_csv(spark, sys.argv[2], sys.argv[1] + "/../landed")
else:
    print(extract(spark, Settings(source=sys.argv[2], sample_rows=int(sys.argv[3]))).count())
spark.stop()
"""


def bytes_read(log):
    total, most = 0, 0
    for path in glob.glob(f"{log}/**/*", recursive=True):
        if os.path.isfile(path) and "events" in os.path.basename(path) or os.path.isfile(path) and "local-" in os.path.basename(path):
            for line in open(path):
                e = json.loads(line)
                if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    n = e["Task Metrics"]["Input Metrics"]["Bytes Read"]
                    total, most = total + n, max(most, n)
    return total, most


@pytest.mark.parametrize("what", ["all", "1000"])
def test_bytes_read(tmp_path, what):
    """A landing reads its source once, by many tasks; a sample reads its first file or two."""
    (tmp_path / "src").mkdir()
    names = ["one.csv"] if what == "all" else [f"f{i:02}.csv" for i in range(20)]
    for name in names:
        with open(tmp_path / "src" / name, "w") as f:
            f.write("char_id,name\n")
            f.writelines(f'{i},"two\nlines {"x" * 200}"\n' for i in range(30_000 if what == "all" else 800))
    (tmp_path / "log").mkdir()
    out = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path / "log"), str(tmp_path / "src"), what], cwd=ROOT,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    size = sum(os.path.getsize(tmp_path / "src" / n) for n in names)
    total, most = bytes_read(tmp_path / "log")
    if what == "all":
        assert size <= total <= 1.15 * size  # ranges of 1 MB, which overlap by a buffer each
        assert most < size / 4
    else:
        # three files were read to find and once more to give the rows
        assert out.stdout.split()[-1] == "1000" and 0 < total <= 7 * size / 20


@pytest.mark.parametrize("name", ["a.csv", "a.csv.gz"])
def test_lines_that_are_records_are_not_exchanged(spark, tmp_path, ranges, name):
    import gzip

    text = "\n\n" + 'char_id,a\n' + "".join(f'{i},"x, ""{i}"""\n' + "\n" * (i % 7 == 0) for i in range(200))
    (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
    ranges(97)
    df = landing.read_profile_csv(spark, str(tmp_path))
    assert "REPARTITION_BY" not in df._jdf.queryExecution().executedPlan().toString()
    assert [(r["char_id"], r["a"]) for r in df.orderBy("src_ord").collect()] == [(str(i), f'x, "{i}"') for i in range(200)]
    # one line break in quotes, far in the file: the lines are exchanged, once
    text += '200,"two\nlines"\n201,z\n'
    (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
    df = landing.read_profile_csv(spark, str(tmp_path))
    rows = [(r["char_id"], r["a"]) for r in df.orderBy("src_ord").collect()]
    assert len(rows) == 202 and rows[-2:] == [("200", "two\nlines"), ("201", "z")]
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan


def test_a_written_file_set_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_ROWS", 100)
    df = spark.range(0, 1000, 1, 2).selectExpr("cast(id AS string) AS char_id", "repeat('x', 50) AS name")
    landing.write_profile_csv(df, str(tmp_path / "out"))
    files = glob.glob(str(tmp_path / "out" / "*.csv.gz"))
    assert len(files) == 10 and sum(map(os.path.getsize, files)) < 20_000
    assert landing.read_profile_csv(spark, str(tmp_path / "out")).select("char_id", "name").exceptAll(df).count() == 0
