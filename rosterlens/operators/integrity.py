"""Integrity checks, cascade delete and row counts for keyed relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one(relation: str, check: str, value_df: DataFrame) -> DataFrame:
    return value_df.select(F.lit(relation).alias("relation"), F.lit(check).alias("check_name"),
                           F.col("violations").cast("long").alias("violations"))


def null_violations(df: DataFrame, relation: str, *cols: str) -> DataFrame:
    """Null counts of several columns from one scan, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(f"not_null:{c}").alias("check_name"), F.col(f"_n{i}").alias("violations"))
                     for i, c in enumerate(cols)])
    return counts.select(F.inline(rows)).select(
        F.lit(relation).alias("relation"), "check_name", F.col("violations").cast("long").alias("violations"))


def duplicate_violations(df: DataFrame, relation: str, key: str) -> DataFrame:
    """Rows beyond the first for each repeated key value."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    v = per.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations"))
    return _one(relation, f"unique:{key}", v)


def orphan_violations(child: DataFrame, parent: DataFrame, relation: str, key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join)."""
    orphans = child.select(key).where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
    return _one(relation, f"foreign_key:{key}", orphans.agg(F.count(F.lit(1)).alias("violations")))


def check_relations(character: DataFrame, classes: DataFrame, feats: DataFrame) -> DataFrame:
    """Every declared constraint of the three relations as
    (relation, check_name, violations); all zero when the load is sound."""
    checks = [
        null_violations(character, "character", "char_id"),
        duplicate_violations(character, "character", "char_id"),
        null_violations(classes, "character_class", "class_id", "char_id", "class"),
        duplicate_violations(classes, "character_class", "class_id"),
        orphan_violations(classes, character, "character_class", "char_id"),
        null_violations(feats, "character_feats", "feat_id", "char_id", "feat"),
        duplicate_violations(feats, "character_feats", "feat_id"),
        orphan_violations(feats, character, "character_feats", "char_id"),
    ]
    return reduce(DataFrame.unionByName, checks)


def cascade_delete(character: DataFrame, children: dict[str, DataFrame], doomed: DataFrame,
                   key: str = "char_id") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete the parent rows whose ``key`` is in ``doomed`` and, as ON DELETE
    CASCADE would, every child row pointing at them (anti joins; Spark picks
    a broadcast at run time when ``doomed`` is small)."""
    gone = doomed.select(key).distinct()
    kept = character.join(gone, key, "left_anti")
    return kept, {name: df.join(gone, key, "left_anti") for name, df in children.items()}


def relation_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """(relation, rows) for each named relation."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("relation"), "rows")
             for name, df in relations.items()]
    return reduce(DataFrame.unionByName, parts)


class IntegrityError(ValueError):
    """Raised when a declared constraint of the relations does not hold."""


def assert_sound(character: DataFrame, classes: DataFrame, feats: DataFrame) -> None:
    """Raise IntegrityError listing every violated constraint. Only the
    check report (one row per check) comes back to the driver."""
    bad = [(r["relation"], r["check_name"], r["violations"])
           for r in check_relations(character, classes, feats).where(F.col("violations") > 0).collect()]
    if bad:
        raise IntegrityError("; ".join(f"{rel}.{chk}: {n} rows" for rel, chk, n in bad))
