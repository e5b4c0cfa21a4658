import os
import tempfile

from rosterlens.sources.csv_landing import land_csv, read_landed, read_profile_csv, sample_rows

from conftest import rows

CSV = '''char_id,name,race,notes
1,"Bob, the ""Bold""",Elf,"line one
line two"
2,Ann,#N/A,NULL
3,Short
4,Long,Elf,x,extra
,NoKey,Elf,y
5, NA ,nan,
'''


def write(text):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    p = os.path.join(d, "profiles.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return d, p


def test_scan_quotes_newlines_na_tokens_and_status(spark):
    _, p = write(CSV)
    df = read_profile_csv(spark, p)
    got = {r["char_id"]: r for r in df.collect()}
    assert got["1"]["name"] == 'Bob, the "Bold"'
    assert got["1"]["notes"] == "line one\nline two"
    assert got["2"]["race"] is None and got["2"]["notes"] is None      # '#N/A', 'NULL'
    assert got["3"]["race"] is None and got["3"]["_status"] == "ok"     # short row: nulls
    assert got["4"]["_status"] == "long_row"
    assert got["5"]["name"] == " NA " and got["5"]["race"] is None      # tokens match exactly
    assert [r["_status"] for r in df.collect() if r["char_id"] is None] == ["null_key"]
    ords = [r["src_ord"] for r in df.orderBy("src_ord").collect()]
    assert [got_id for got_id in [r["char_id"] for r in df.orderBy("src_ord").collect()]] == ["1", "2", "3", "4", None, "5"]
    assert len(set(ords)) == 6


def test_land_once_and_read_usable_rows_and_quarantine(spark):
    d, p = write(CSV)
    out = os.path.join(d, "landed")
    land_csv(spark, p, out)
    assert rows(read_landed(spark, out).select("char_id")) == [("1",), ("2",), ("3",), ("5",)]
    assert read_landed(spark, out, "long_row").count() == 1
    assert read_landed(spark, out, "null_key").count() == 1
    assert [r["char_id"] for r in sample_rows(read_landed(spark, out), 2).collect()] == ["1", "2"]


def test_one_empty_extra_field_is_a_long_row(spark):
    _, p = write("char_id,name\n1,a\n2,b,\n3,c,x,y\n")
    got = {r["char_id"]: r["_status"] for r in read_profile_csv(spark, p).collect()}
    assert got == {"1": "ok", "2": "long_row", "3": "long_row"}
