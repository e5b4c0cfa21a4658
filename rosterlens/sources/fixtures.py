"""Raw profile rows derived from the supplied TPC-H-like tables.

``orders`` gives the profile, ``customer`` name and race, all lines of an
order (``lineitem`` x ``part``) the classes (p_type), subclasses (p_brand) and
feats (p_name): line 1 the starting class, the others the listed ones. Dirt is put in by key arithmetic so that every
cleaning rule has work to do; the rules and their targets are listed in
FIXTURES.md section 4. Output: all-string raw columns plus ``src_ord``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, lines): all lines of each order, by (line number, part, supplier),
    with their part's type, brand and name. The list is the profile's own
    content, so its length is that of one order."""
    li = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("pk"), "l_linenumber", "l_suppkey"
    )
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk"), "p_type", "p_brand", "p_name")
    line = F.struct("l_linenumber", "pk", "l_suppkey", "p_type", "p_brand", "p_name")
    # lists do not shrink before the exchange, so lines travel as they are and are collected behind it
    return li.join(part, "pk").repartition("k").groupBy("k").agg(F.sort_array(F.collect_list(line)).alias("lines"))


def most_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the largest table that ``raw_profiles`` exchanges (counts that read no column)."""
    return max(_table(spark, sf_dir, name).count() for name in ("lineitem", "orders", "customer", "part"))


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw profile versions: one per order, plus a second version for every
    tenth order (newer date, unparsable date, or same date)."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("d"),
        F.col("o_orderpriority").alias("background"), F.col("o_custkey").alias("ck"),
    )
    customer = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ck"), "c_name", "c_mktsegment")
    base = orders.join(customer, "ck").join(order_lines(spark, sf_dir), "k", "left")

    k = F.col("k")
    # Both versions from one pass over `base` (no self-union).
    v_list = F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    versions = base.withColumn("v", F.explode(v_list))
    v = F.col("v")
    d_str = F.col("d").cast("string")
    ds = F.when(v == 0, d_str).otherwise(
        F.when(k % 20 == 0, F.lit("garbage"))
        .when(k % 30 == 0, d_str)
        .otherwise((F.col("d") + F.expr("INTERVAL 1 DAY")).cast("string"))
    )
    c_name = F.col("c_name")
    name = (
        F.when((k % 37 == 0) | ((v == 1) & (k % 70 == 0)), F.concat(c_name, F.lit("'s Character")))
        .when(k % 41 == 0, F.lit("   "))
        .when(k % 43 == 0, F.lit("nan"))
        .when(k % 47 == 0, F.lit(None).cast("string"))
        .when(k % 53 == 0, F.concat(F.lit("  "), c_name, F.lit("\t")))
        .otherwise(c_name)
    )

    def s(e):
        return e.cast("string")

    def listed(sep, *parts):
        joined = F.concat_ws(sep, *parts)
        return F.when(joined != "", joined)

    lines = F.col("lines")

    def some(field, first, n=None, sep="/", shape=None):
        """Lines first, first + 1, ... (n of them, or all) as one list; null when there are none."""
        part = F.slice(lines[field], F.lit(first), F.lit(n) if n else F.greatest(F.size(lines), F.lit(1)))
        return F.when(F.size(lines) >= first, F.array_join(F.transform(part, shape) if shape else part, sep))

    return versions.select(
        v.alias("src_ord"),
        s(k).alias("char_id"),
        name.alias("name"),
        F.when(k % 59 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("race"),
        F.col("background"),
        F.when(k % 67 == 0, F.lit("unknown")).otherwise(s((k + v) % 23)).alias("total_level"),
        s(k % 200 - 10).alias("base_hp"),
        s((k * 7 + 1) % 33).alias("stats_1"),
        s((k * 11 + 2) % 33).alias("stats_2"),
        s((k * 13 + 3) % 33).alias("stats_3"),
        s((k * 17 + 4) % 33).alias("stats_4"),
        F.when(k % 29 == 0, F.lit(None).cast("string")).otherwise(s((k * 19 + 5) % 33)).alias("stats_5"),
        s((k * 23 + 6) % 33).alias("stats_6"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(s((k * 13) % 5000 - 50)).alias("notes_len"),
        ds.alias("date_modified"),
        F.get(lines, F.lit(0))["p_type"].alias("class_starting"),
        F.when(k % 31 == 0, F.lit(" None ")).otherwise(F.get(lines, F.lit(0))["p_brand"]).alias("subclass_starting"),
        s(k % 22).alias("class_starting_level"),
        listed("/", some("p_type", 2, 1), some("p_type", 3, 1, shape=lambda c: F.concat(F.lit(" "), c, F.lit(" "))),
               F.when(k % 13 == 0, F.lit("NONE")), F.lit(""), some("p_type", 4)).alias("class_other"),
        listed("/", some("p_brand", 2), F.when(k % 23 == 0, F.lit("Extra/More"))).alias("subclass_other"),
        listed(" / ", some("p_name", 1, sep=" / ")).alias("feats"),
    )
