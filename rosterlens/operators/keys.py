"""Surrogate keys and key attachment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.session import kept

PID, ROW = "_pid", "_row"
_PID = "_key_pid"
_LOCAL = "_key_local"
_OFFSET = "_key_offset"


def placed(ranged: DataFrame) -> DataFrame:
    """Range-sorted rows with their place, ``_pid`` and ``_row`` (see ``in_order``): to be written as they are."""
    pid = F.spark_partition_id()
    row = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return ranged.select("*", pid.alias(PID), row.alias(ROW))


def in_order(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None,
             cache_input: StorageLevel | None = StorageLevel.MEMORY_AND_DISK, keep: Callable = kept) -> DataFrame:
    """``df`` range-sorted by ``order`` (a total order) and kept as Parquet with
    each row's place: ``_pid``, its partition of the sort, and ``_row``, its
    number in it from 0. The place is a column, so it holds whatever the splits
    are in which the files are read again."""
    # The range partitioner samples its whole input in a job of its own before
    # the sort runs; keeping the input for the two passes avoids computing it
    # twice. What later steps read is the written table, so losing a cached
    # block only costs a recomputation.
    src = df.persist(cache_input) if cache_input is not None else df
    try:
        if partitions:
            ranged = src.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        else:
            # A global sort: its range exchange may be coalesced by AQE, which
            # only merges neighbouring ranges, so the order is kept.
            ranged = src.orderBy(*order)
        return keep(placed(ranged), "ordered")
    finally:
        if cache_input is not None:
            src.unpersist()


def _offsets(ordered: DataFrame, sizes: dict[str, Column]) -> DataFrame:
    """One row a partition of the sort: for each name, the entries before the
    partition's first, all entries of one name coming before those of the next.
    Bounded by the number of partitions, like the window over it."""
    counts = ordered.groupBy(PID).agg(*(F.sum(n.cast("long")).alias(name) for name, n in sizes.items()))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    out, first = [], F.lit(0)
    for name in sizes:
        out.append((first + F.coalesce(F.sum(name).over(before), F.lit(0))).cast("long").alias(name))
        first = first + F.sum(name).over(whole)
    return counts.select(PID, *out)


def positions(ordered: DataFrame, name: str) -> DataFrame:
    """The rows of ``in_order`` with ``name`` = 1..N in their order: a count of
    one column, and a broadcast of one number a partition."""
    offsets = _offsets(ordered, {_OFFSET: F.lit(1)})
    at = F.col(_OFFSET) + F.col(ROW) + F.lit(1)
    return ordered.join(F.broadcast(offsets), PID).select(at.alias(name), *ordered.columns)


def entry_positions(ordered: DataFrame, key: str, lists: Sequence[Column], name: str) -> DataFrame:
    """(name, key, list, entry): the entries of array columns of the rows of
    ``in_order`` numbered 1..N as one sequence: all of ``lists[0]`` by row and
    place, then all of ``lists[1]``, ... (of one type).

    One exchange by ``_pid`` (the balanced ranges of the sort) of the arrays
    alone; the running number of a partition's entries is a window there."""
    arrays, sizes = [f"_a{i}" for i in range(len(lists))], [f"_n{i}" for i in range(len(lists))]
    offsets = _offsets(ordered, {n: F.size(a) for n, a in zip(sizes, lists)})
    rows = ordered.select(key, PID, ROW, *(a.alias(c) for a, c in zip(lists, arrays)))
    before = Window.partitionBy(PID).orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_b{i}": F.coalesce(F.sum(F.size(a)).over(before), F.lit(0)) for i, a in enumerate(arrays)})
    rows = rows.join(F.broadcast(offsets), PID)

    def numbered(i: int) -> Column:
        first = F.col(sizes[i]) + F.col(f"_b{i}") + F.lit(1)
        return F.transform(arrays[i], lambda e, k: F.struct((first + k).alias(name), F.lit(i).alias("list"), e.alias("entry")))

    return rows.select(key, F.inline(F.concat(*map(numbered, range(len(lists)))))).select(name, key, "list", "entry")


def dense_key(df: DataFrame, order: Sequence[Column | str], name: str, partitions: int | None = None,
              cache_input: StorageLevel | None = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Add ``name`` = 1..N following ``order`` (which must be a total order),
    like an identity column filled in that insert order: a range-partitioned
    sort (balanced, since the order is unique) kept as Parquet, and the offsets
    of its partitions. No window over the data itself, no single-partition step
    over rows, nothing collected to the driver.
    """
    return positions(in_order(df, order, partitions, cache_input), name).drop(PID, ROW)


def ordered_numbering(groups: Sequence[DataFrame], name: str) -> list[DataFrame]:
    """Number the rows of several groups 1..N as one sequence: every row of
    ``groups[0]`` first, then ``groups[1]``, ..., each group in its parent's
    order.

    Each group must be derived from the same range-sorted DataFrame, whose
    partitions are fixed (a checkpoint), by narrow, order-preserving steps only (filter, explode,
    project, broadcast join), so that within each partition
    ``monotonically_increasing_id`` is the running index of the group's rows.
    Then only a tiny table is needed: rows per (group, partition), running
    offsets over it (written once, at most groups x partitions rows) and
    a broadcast join. The groups themselves are never sorted or shuffled.
    """
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    sizes = None
    for i, g in enumerate(groups):
        part = g.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("_n")).withColumn("_grp", F.lit(i))
        sizes = part if sizes is None else sizes.unionByName(part)
    w = Window.orderBy("_grp", _PID)
    offsets = sizes.select("_grp", _PID, (F.sum("_n").over(w) - F.col("_n")).alias(_OFFSET))
    offsets = kept(offsets, "offsets")
    out = []
    for i, g in enumerate(groups):
        mine = F.broadcast(offsets.where(F.col("_grp") == i).drop("_grp"))
        indexed = g.select("*", pid.alias(_PID), local.alias(_LOCAL))
        out.append(indexed.join(mine, _PID).select((F.col(_OFFSET) + F.col(_LOCAL) + F.lit(1)).alias(name),
                                                   *g.columns))
    return out


def attach_keys(children: DataFrame, key_map: DataFrame, on: str = "source_id", key: str = "char_id") -> DataFrame:
    """Inner equi-join of child rows to the ``(on, key)`` map of their parent.
    Children whose parent is absent are dropped, as the reference's merge
    does. Null join values never match (Spark equality)."""
    return children.join(key_map.select(on, key), on, "inner")
