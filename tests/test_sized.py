"""Builds of large tables: tasks follow the rows, and lines are not collected before their exchange."""

import datetime

import pytest
from pyspark.sql import functions as F

from rosterlens.plans import registry
from rosterlens.session import sized
from rosterlens.sources import fixtures

PARTITIONS, MERGE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"


@pytest.fixture
def folder(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    tables = {
        "customer": ([(i, f"c{i}", "SEG") for i in range(5)], "c_custkey long, c_name string, c_mktsegment string"),
        "orders": ([(i, i % 5, day, "1-HIGH") for i in range(1, 101)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "part": ([(i, f"type{i}", f"brand{i}", f"name{i}") for i in range(7)],
                 "p_partkey long, p_type string, p_brand string, p_name string"),
        "lineitem": ([(i, (i + n) % 7, 1, n) for i in range(1, 101) for n in range(1, 4)] + [(None, 1, 1, 1)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_sized_follows_the_rows_and_restores(spark):
    before = spark.conf.get(PARTITIONS), spark.conf.get(MERGE)
    least = spark.sparkContext.defaultParallelism
    with pytest.raises(ValueError):
        with sized(spark, 1000 * least, 100):
            assert spark.range(10).repartition("id").rdd.getNumPartitions() == 10 * least
            raise ValueError
    assert (spark.conf.get(PARTITIONS), spark.conf.get(MERGE)) == before
    with sized(spark, 5, 100):
        assert spark.conf.get(PARTITIONS) == str(least)
    with sized(spark, None, 1):
        assert (spark.conf.get(PARTITIONS), spark.conf.get(MERGE)) == before


def test_lines_are_collected_behind_their_exchange(spark, folder):
    lines = fixtures.order_lines(spark, folder)
    plan = lines._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("Exchange hashpartitioning(k")  # the exchange is below
    got = {r["k"]: [x["l_linenumber"] for x in r["lines"]] for r in lines.collect()}
    assert got == {None: [1]} | {i: [1, 2, 3] for i in range(1, 101)}


def test_landing_tasks_follow_the_rows(spark, folder, monkeypatch):
    assert fixtures.most_rows(spark, folder) == 301
    least = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(registry, "LANDING_TASK_ROWS", max(1, 301 // (5 * least)))
    landed = registry.raw(spark, folder)
    assert len(landed.inputFiles()) > least
    feats = {r["char_id"]: r["feats"] for r in landed.where("src_ord = 0").select("char_id", "feats").collect()}
    assert len(feats) == 100 and feats["1"] == "name2 / name3 / name4"
    assert landed.count() == 110 and landed.where(F.col("feats").isNull()).isEmpty()
