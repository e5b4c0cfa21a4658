"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in a shuffled order fixed by their hash, form one
stream of words cut into blocks equal to within a word: at least ``ENOUGH``,
and as many more as keep them to a size fixed for the corpus. The schedule has
one slot for each block of the mix; slot t belongs to the source whose stretch
of the cumulative weights (in blocks) holds the golden-ratio point frac(t *
phi), so every stretch of the schedule has each source within a few blocks of
its share, and a small source's few blocks are few of its words. A source's
k-th slot takes its k-th block, and starts over at its end.

No source is one task's work: positions in a stream and ranks in the schedule
are counts per bucket, offsets over buckets, and sums inside a bucket.

Defined results: null or empty text has size 0 and takes 0; the null source is
a source of its own, last in order; a target is at most ``most`` times its
source's size; equal rows are separate documents; null ids stay; a very long
text is many blocks, of which the mix may take some; other columns may have any
names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.textnum import Words, blocks, text_buffers
from rosterlens.llm.work import carried, keep, lean, ship_code

BLOCK_BYTES = 4_000_000
BUCKET_ROWS = 20_000  # documents or slots of one source summed together, on average
SLOTS = 4_000_000  # aimed at; a block has at most 16 to 4096 words
ENOUGH = 1024  # blocks of a source at least; some are empty where it has fewer words
GOLDEN = (5 ** 0.5 - 1) / 2


def _sizes(batches):
    for batch in batches:
        data, bounds = text_buffers(batch.column(2))
        n = [Words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]).count for i, j in blocks(bounds, BLOCK_BYTES)]
        n = np.concatenate(n) if n else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(3), pa.array(n, pa.int64())], ["doc", "source", "rid", "size"])


def source_targets(sizes: DataFrame, weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, number, target): weights by the order of the
    sources, the total shared by weight, no target above ``most`` times its
    source's size. The sources whose limit comes first, in the order of limit by
    weight, are at their limit; the rest share what is left. One row a source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    all_ = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    per = (per.withColumn("number", (F.row_number().over(all_) - 1).cast("long")).withColumn("weight", weight)
           .withColumn("limit", (most * F.col("source_size")).cast("double")))
    by = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(whole).cast("double"))
           .withColumn("weights", F.sum("weight").over(whole))
           .withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
           .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", (F.col("total") - F.col("spent")) / (F.col("weights") - F.col("gone")))
           .withColumn("open", F.col("level") * F.col("weight") <= F.col("limit")))
    level = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), F.col("number"), F.col("level"))))
    per = per.withColumn("share", level.over(whole).getField("level"))
    open_ = F.col("limit") > F.col("share") * F.col("weight")
    return per.select("source", "source_size", "number",
                      F.when(open_, F.col("share") * F.col("weight")).otherwise(F.col("limit")).alias("target"))


def _running(df: DataFrame, group: str, order: list, value, name: str) -> DataFrame:
    """``name``: sum of ``value`` over the rows of the group before this one, in
    the order of ``_bucket`` (which the first of ``order`` fixes) and ``order``."""
    sums = df.groupBy(group, "_bucket").agg(F.sum(value).alias("_n"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_n").over(
        Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.sum(value).over(Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_in", F.coalesce(inside, F.lit(0))).join(base, [group, "_bucket"]).withColumn(
        name, F.col("_base") + F.col("_in")).drop("_in", "_base")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=(5, 2, 1), most: int = 3) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(documents, blocks' pieces, schedule, most words of a block).

    documents: rid, doc, source, size, source_size, number, target, before.
    pieces: rid, before, number, block, words. schedule: slot, number, turn,
    block, epoch, in the order of the mix."""
    spark = docs.sparkSession
    ship_code(spark)
    sizes = keep(docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(source_col).alias("source"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col)).alias("rid")).mapInArrow(
            lean(_sizes), "doc long, source string, rid long, size long"), "sizes")
    targets = keep(source_targets(sizes, weights, most), "targets")
    total = int(targets.agg(F.sum("source_size")).first()[0] or 0)
    words = int(min(4096, max(16, total // SLOTS)))
    # few rows, one a source: small against a task, but of no proven size, so joined, not sent
    named = sizes.join(targets, sizes.source.eqNullSafe(targets.source)).drop(targets.source)
    rows = sizes.count()
    buckets = max(1, rows // BUCKET_ROWS)
    # the shuffled order: by hash, the bucket being its top stretch
    mixed = F.xxhash64(F.col("rid"), F.lit(17))
    named = named.withColumn("mixed", mixed).withColumn(
        "_bucket", F.floor((F.col("mixed").cast("double") / 2.0 ** 64 + 0.5) * buckets).cast("long"))
    placed = keep(_running(named, "number", ["mixed", "rid", "doc"], F.col("size"), "before"), "streams")
    n = F.greatest(F.lit(ENOUGH).cast("long"), F.ceil(F.col("source_size") / words))

    def edge(block: str) -> str:
        """The word at which a block of ``n`` begins: block * source_size / n, rounded, in whole numbers."""
        return f"({block}) * (source_size div n) + (2 * ({block}) * (source_size % n) + n) div (2 * n)"

    # a block to either side, for the rounding; those without words of the document go
    per = F.col("n") / F.col("source_size")
    pieces = (placed.where("size > 0").withColumn("n", n)
              .withColumn("block", F.explode(F.sequence(
                  F.greatest(F.floor(F.col("before") * per) - 1, F.lit(0)),
                  F.least(F.floor((F.col("before") + F.col("size")) * per) + 1, F.col("n") - 1))))
              .withColumn("words", F.least(F.col("before") + F.col("size"), F.expr(edge("block + 1")))
                          - F.greatest("before", F.expr(edge("block"))))
              .where("words > 0").select("rid", "doc", "size", "before", "number", "block", "words"))
    # stretches of the cumulative weights, one row a source; a block weighs the same in each
    edges = targets.where("target > 0").withColumn("blocks", F.col("target") / F.col("source_size") * n)
    weight = float(edges.agg(F.sum("blocks")).first()[0] or 0)
    slots = round(weight)
    edges = edges.withColumn("hi", F.sum("blocks").over(Window.orderBy("number")) / (weight or 1.0))
    edges = edges.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("number")), F.lit(0.0)))
    # a grid over [0, 1) turns the range join into an equality join
    cells = 1024
    grid = edges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(
        F.floor(F.col("hi") * cells), F.lit(cells - 1))))).select("number", "lo", "hi", "cell", "source_size")
    top = edges.agg(F.max("number")).first()[0]
    t = spark.range(slots).withColumnRenamed("id", "slot")
    u = (F.col("slot") + 0.5) * GOLDEN
    t = t.withColumn("u", u - F.floor(u)).withColumn("cell", F.floor(F.col("u") * cells))
    t = t.join(grid, "cell").where((F.col("u") >= F.col("lo")) & ((F.col("u") < F.col("hi")) | (
        (F.col("number") == (top if top is not None else -1)) & (F.col("hi") < 1.0) & (F.col("u") >= F.col("hi")))))
    t = t.withColumn("_bucket", F.floor(F.col("slot") / BUCKET_ROWS))
    turns = _running(t.select("slot", "number", "source_size", "_bucket"), "number", ["slot"], F.lit(1), "turn")
    schedule = turns.withColumn("block", F.col("turn") % n).withColumn("epoch", F.floor(F.col("turn") / n)).where(
        F.col("epoch") < most).select("slot", "number", "turn", "block", "epoch")
    return placed, pieces, schedule, words


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document: the words of it that the mix takes."""
    placed, pieces, schedule, _ = mix_plan(docs, id_col, text_col, source_col, weights, most)
    drawn = schedule.groupBy("number", "block").agg(F.count("*").alias("times"))
    taken = pieces.join(drawn, ["number", "block"]).groupBy("rid", "before", "number").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"))
    return placed.join(taken.withColumnRenamed("before", "_before").withColumnRenamed("number", "_number").withColumnRenamed(
        "rid", "_rid"), (F.col("rid") == F.col("_rid")) & (F.col("before") == F.col("_before")) & (
            F.col("number") == F.col("_number")) & (F.col("size") > 0), "left").select(
        F.col("doc").alias(id_col), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """The mix as rows of ``docs``: each document once for every pass over its
    source that takes at least half of its words. Documents without words are
    left out. Equal rows are separate documents: the passes of all of them are
    dealt to them one by one, so none has more than one pass more than another."""
    placed, pieces, schedule, _ = mix_plan(docs, id_col, text_col, source_col, weights, most)
    drawn = schedule.groupBy("number", "block", "epoch").agg(F.count("*").alias("times"))
    passes = (pieces.join(drawn, ["number", "block"]).groupBy("rid", "before", "number", "epoch", "size")
              .agg(F.sum("words").alias("words")).where(2 * F.col("words") >= F.col("size")))
    # equal rows share rid: passes and rows of a rid are counted together
    copies = placed.where("size > 0").groupBy("rid").agg(F.count("*").alias("copies"))
    times = keep(passes.groupBy("rid").agg(F.count("*").alias("times")).join(copies, "rid"), "times")
    rows = carried(docs, rid=F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col)))
    even = rows.join(times.where("times % copies = 0"), "rid").select("row", F.expr("times div copies").alias("passes"))
    # the few whose passes do not come out even are numbered, by buckets, as one rid may have many
    uneven = keep(times.where("times % copies <> 0"), "uneven")
    both = even
    if not uneven.isEmpty():
        odd = keep(rows.join(uneven, "rid").withColumn("at", F.monotonically_increasing_id()), "odd")
        buckets = max(1, odd.count() // BUCKET_ROWS)
        odd = _running(odd.withColumn("_bucket", F.pmod(F.xxhash64("at"), F.lit(buckets))), "rid", ["at"], F.lit(1), "turn")
        both = even.unionByName(odd.select("row", (F.expr("times div copies") + F.when(
            F.col("turn") < F.expr("times % copies"), 1).otherwise(0)).alias("passes")))
    return both.where("passes > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int")))).select("row.*")
