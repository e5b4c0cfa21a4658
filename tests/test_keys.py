from pyspark.sql import functions as F

from rosterlens.operators.keys import attach_keys, dense_key

from conftest import rows


def test_dense_key_is_dense_and_ordered_across_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5000).alias("v")).repartition(11)
    keyed = dense_key(df, [F.col("v").desc()], "k", partitions=9)
    got = sorted(tuple(r) for r in keyed.select("k", "v").collect())
    assert [k for k, _ in got] == list(range(1, 5001))
    assert [v for _, v in got] == list(range(4999, -1, -1))


def test_dense_key_on_empty_input(spark):
    df = spark.range(0).select(F.col("id").alias("v"))
    assert dense_key(df, ["v"], "k").count() == 0


def test_attach_keys_inner_join(spark):
    kids = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "source_id string, x int")
    keys = spark.createDataFrame([("a", 10), ("b", 20)], "source_id string, char_id long")
    assert rows(attach_keys(kids, keys).select("char_id", "x")) == [(10, 1), (20, 2)]


def test_dense_key_without_input_cache(spark):
    df = spark.range(0, 300, 1, 5).select((299 - F.col("id")).alias("v"))
    got = sorted(tuple(r) for r in dense_key(df, ["v"], "k", cache_input=None).select("k", "v").collect())
    assert got == [(i + 1, i) for i in range(300)]


def test_ordered_numbering_of_filtered_and_exploded_groups(spark):
    from rosterlens.operators.keys import ordered_numbering

    base = spark.range(0, 2000, 1, 7).select((F.col("id") * 7 % 2000).alias("v"))
    ordered = base.repartitionByRange(9, "v").sortWithinPartitions("v").checkpoint(eager=True)
    evens = ordered.where(F.col("v") % 2 == 0).select("v")
    pairs = ordered.select("v", F.explode(F.array(F.lit(0), F.lit(1))).alias("j"))
    a, b = ordered_numbering([evens, pairs], "k")
    got_a = sorted(tuple(r) for r in a.select("k", "v").collect())
    got_b = sorted(tuple(r) for r in b.select("k", "v", "j").collect())
    assert got_a == [(i + 1, 2 * i) for i in range(1000)]
    assert got_b == [(1001 + 2 * v + j, v, j) for v in range(2000) for j in (0, 1)]
