"""One key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from rosterlens.plans import reports
from rosterlens.plans.clean import clean_profiles
from rosterlens.plans.model import build_relations


def test_hot_key_and_hot_class(spark):
    n = 30000
    ids = spark.range(n, numPartitions=8)
    hot = F.col("id") % 3 == 0                       # a third of the rows share key "hot"
    raw = ids.select(
        F.col("id").alias("src_ord"),
        F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("char_id"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
        F.lit("Elf").alias("race"), F.lit(None).cast("string").alias("background"),
        (F.col("id") % 20 + 1).cast("string").alias("total_level"),
        *[F.lit("10").alias(c) for c in ["base_hp", "stats_1", "stats_2", "stats_3", "stats_4", "stats_5",
                                         "stats_6", "notes_len", "class_starting_level"]],
        F.date_format(F.timestamp_seconds(F.col("id")), "yyyy-MM-dd HH:mm:ss").alias("date_modified"),
        F.when(F.col("id") % 10 == 0, F.lit("Rare")).otherwise(F.lit("Common")).alias("class_starting"),
        F.lit("Sub").alias("subclass_starting"),
        F.lit(None).cast("string").alias("class_other"), F.lit(None).cast("string").alias("subclass_other"),
        F.lit("A/B").alias("feats"),
    )
    rels = build_relations(clean_profiles(raw), keyed=True)
    chars = rels.character
    expected = n - n // 3 + 1                        # every non-hot id, plus one row for "hot"
    assert chars.count() == expected
    hot_row = chars.where(F.col("source_id") == "hot").first()
    assert hot_row["name"] == f"n{n - 3}"            # the latest of the hot versions
    assert sorted(r[0] for r in chars.select("char_id").collect()) == list(range(1, expected + 1))
    pop = {r["class"]: r["character_count"] for r in reports.class_popularity(rels).collect()}
    common = sum(1 for i in range(n) if i % 3 != 0 and i % 10 != 0) + (1 if (n - 3) % 10 else 0)
    assert pop["Common"] == common and pop["Common"] + pop["Rare"] == expected
    assert rels.feats.count() == 2 * expected
