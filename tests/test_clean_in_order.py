"""The version choice and the order of keys by one exchange: the rows of clean_profiles, in insert order."""

import pytest
from pyspark.sql import functions as F

from rosterlens.operators.keys import PID, ROW
from rosterlens.plans import clean as cl
from rosterlens.plans.model import build_relations
from rosterlens.schema import RAW_NUMERIC_COLUMNS

TEXT = ["race", "background", "class_starting", "subclass_starting", "class_other", "subclass_other", "feats"]


def raw(spark, versions=7, keys=("10", "9", "010", "x", "2", None, "-3", "ab", "")):
    rows = [(k, f"n{v}" if (v + i) % 5 else "nan", f"2024-01-{1 + v % 3:02}" if (v * i) % 4 else "bad", i * versions + v)
            for i, k in enumerate(keys) for v in range(versions)]
    df = spark.createDataFrame(rows, "char_id string, name string, date_modified string, src_ord int").repartition(5)
    return df.select("*", *[F.lit(c).alias(c) for c in TEXT], *[(F.col("src_ord") % 40).cast("string").alias(c) for c in RAW_NUMERIC_COLUMNS])


def told(df):
    return sorted(map(str, df.select("char_id", "name", "date_modified", "src_ord", *TEXT, *RAW_NUMERIC_COLUMNS).collect()))


@pytest.mark.parametrize("most", [100_000, 3])
def test_rows_are_those_of_clean_profiles(spark, monkeypatch, most):
    monkeypatch.setattr(cl.few_versions, "__defaults__", (most,))
    df = raw(spark)
    for rows in (None, df.count()):
        assert told(cl.clean_in_order(df, rows=rows)) == told(cl.clean_profiles(df))
    undated = df.drop("date_modified")
    got = cl.clean_in_order(undated, rows=1).select("char_id", "src_ord")
    assert sorted(map(str, got.collect())) == sorted(map(str, cl.clean_profiles(undated).select("char_id", "src_ord").collect()))


def test_one_exchange_and_insert_order(spark, monkeypatch):
    monkeypatch.setattr(cl, "TASK_ROWS", 5)
    df = raw(spark)
    out = cl.clean_in_order(df, rows=df.count())
    assert sorted(c for c in out.columns if c.startswith("_")) == sorted([PID, ROW])
    plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Exchange hashpartitioning" not in plan
    new = build_relations(out).character.orderBy("char_id").select("char_id", "source_id", "name").collect()
    old = build_relations(cl.clean_profiles(df)).character.orderBy("char_id").select("char_id", "source_id", "name").collect()
    assert new == old and [r["char_id"] for r in new] == list(range(1, len(new) + 1))
