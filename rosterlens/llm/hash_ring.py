"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``virtual`` points on a ring of 64-bit hashes. A document starts
at the hash of its text, so equal texts start together, and goes to the shard of
the next point clockwise; a shard that is full is passed over, and the document
continues clockwise to the next point of one that is not. Documents come in a
fixed order: by their text's hash, their id's, then their row's.

``bound`` gives the shards' bounds: ``rows`` shares the rows so that counts are
at most one apart, ``bytes`` takes documents while a shard has less than
``1 + slack`` of its equal share of the bytes. The documents that move when a
shard is added are those between the new points and their forerunners, and those
that the changed bounds pass on; the rest stay.

1. Only a document's hashes, size and start (the stretch between two points)
   are kept. A stretch has one order of shards, so what a stretch's documents do
   depends only on which shards are full.
2. A shard fills once. The moment is found by a histogram of sizes over
   (stretch, range of the order): the driver adds ranges up until one fills a
   shard, and asks for a histogram inside that range, down to single rows. A
   histogram has at most ``virtual * shards * 512`` rows; shards fill once
   each, so the jobs are a few for each shard, whatever the number of documents.
3. A document's shard is the first of its stretch's that was not full yet: an
   expression over at most ``shards`` moments.
4. Slots are the ranks in a shard, by that order: a range sort, and offsets of
   its partitions. A text with a third of all rows is spread by the row's hash.

Defined results: null text counts as empty (size 0 + 1); equal rows are separate
documents, and take any of their places; null ids stay; other columns are
ignored; very long texts are only hashed and measured; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.work import keep, ship_code
from rosterlens.operators.keys import in_order, positions

VIRTUAL = 32
RANGE_BITS = 9  # a histogram has 2**9 parts of a range of the order
FEW = 10_000  # rows of a range that are put in order one by one
KEYS = ("by_text", "by_id", "by_row")
LOW = -(2 ** 63)


def _hash(*parts) -> int:
    """64-bit hash of numbers, for the points on the ring."""
    import xxhash

    return xxhash.xxh64_intdigest(":".join(map(str, parts)).encode()) + LOW


@dataclass
class Ring:
    """Points in order, and for each stretch that ends at one the shards in the
    order in which the ring gives them."""
    points: np.ndarray
    orders: np.ndarray

    @classmethod
    def of(cls, shards: int, virtual: int) -> "Ring":
        at = sorted((_hash("ring", s, v), s) for s in range(shards) for v in range(virtual))
        owner = [s for _, s in at]
        orders = [list(dict.fromkeys(owner[i:] + owner[:i])) for i in range(len(at))]
        return cls(np.array([p for p, _ in at], np.int64), np.array(orders, np.int32).reshape(len(at), shards))


def _starts(points: np.ndarray):
    """The stretch of each ring position: the first point at or after it, the first of all after the last."""
    @F.pandas_udf("int")
    def stretch(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, position.to_numpy(), "left") % len(points))

    return stretch


class _Filling:
    """Loads of the shards while documents come in their order."""

    def __init__(self, keys: DataFrame, ring: Ring, limits: list):
        self.keys, self.orders, self.limits = keys, ring.orders, np.array(limits, np.float64)
        self.loads = np.zeros(len(limits), np.float64)
        self.full_at: list = [() if x <= 0 else None for x in limits]  # key after which a shard takes none

    def _open(self) -> np.ndarray:
        """For each stretch, the first shard that is not full; -1 when all are."""
        free = np.array([x is None for x in self.full_at])[self.orders]
        first = free.argmax(1)
        return np.where(free.any(1), self.orders[np.arange(len(self.orders)), first], -1)

    def _add(self, stretches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        owner = self._open()[stretches]
        return np.bincount(owner[owner >= 0], weights=sizes[owner >= 0], minlength=len(self.limits))

    def run(self, prefix: tuple = (), low: int = LOW, bits: int = 64) -> None:
        """Takes in the rows whose first keys are ``prefix`` and whose next is in
        [low, low + 2**bits), in order."""
        key = F.col(KEYS[len(prefix)])
        rows = self.keys
        for name, value in zip(KEYS, prefix):
            rows = rows.where(F.col(name) == F.lit(value))

        def within(first: int, bits: int) -> DataFrame:
            return rows.where(key.between(F.lit(first), F.lit(first + 2 ** bits - 1)))

        step = min(RANGE_BITS, bits)
        rest = bits - step
        part = F.shiftrightunsigned(key.bitwiseXOR(F.lit(LOW)), rest).bitwiseAND(F.lit(2 ** step - 1))
        found = (within(low, bits).groupBy(part.alias("part"), "stretch").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
                 .toPandas().sort_values("part", kind="stable"))
        for p, group in found.groupby("part"):
            open_ = np.array([x is None for x in self.full_at])
            if not open_.any():
                return
            added = self._add(group["stretch"].to_numpy(), group["weight"].to_numpy(np.float64))
            first = low + (int(p) << rest)
            if not ((self.loads + added >= self.limits) & open_).any():
                self.loads += added
            elif group["n"].sum() <= FEW:
                self._rows(within(first, rest))
            elif rest:
                self.run(prefix, first, rest)
            else:  # one value of this key: by the next one
                self.run((*prefix, first))

    def _rows(self, rows: DataFrame) -> None:
        few = rows.select(*KEYS, "stretch", "weight").toPandas().sort_values(list(KEYS), kind="stable")
        open_ = self._open()
        for *at, stretch, weight in zip(*(few[c].tolist() for c in few.columns)):
            s = open_[stretch]
            if s < 0:
                return
            self.loads[s] += weight
            if self.loads[s] >= self.limits[s]:
                self.full_at[s] = tuple(at)
                open_ = self._open()


def ring_shards(docs: DataFrame, shards: int = 8, virtual: int = VIRTUAL, bound: str = "rows", slack: float = 0.0,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of each document; ``size`` is its
    text's UTF-8 bytes and one, ``slot`` counts from 0 in each shard."""
    spark = docs.sparkSession
    ship_code(spark)
    ring = Ring.of(shards, virtual)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("by_text"),
        F.xxhash64(F.col(id_col).cast("long"), F.lit(7)).alias("by_id"),
        F.xxhash64(F.monotonically_increasing_id()).alias("by_row"))
    # the place on the ring is a second hash: the order of coming must not follow the ring
    keys = keys.withColumn("stretch", _starts(ring.points)(F.xxhash64("by_text", F.lit(11))))
    keys = keep(keys.withColumn("weight", F.lit(1).cast("long") if bound == "rows" else F.col("size")), "ring-keys")
    total = int(keys.agg(F.sum("weight")).first()[0] or 0)
    if bound == "rows":
        limits = [total // shards + (s < total % shards) for s in range(shards)]
    elif bound == "bytes":
        limits = [(1 + slack) * total / shards] * shards
    else:
        raise ValueError("bound is rows or bytes")
    filling = _Filling(keys, ring, limits)
    if total:
        filling.run()
    at = F.struct(*(F.col(k) for k in KEYS))

    def may(s: int):
        """Whether shard s was not full when the document came."""
        when = filling.full_at[s]
        if when is None:
            return F.lit(True)
        return F.lit(False) if when == () else at <= F.struct(*(F.lit(v).alias(k) for v, k in zip(when, KEYS)))

    # one row a stretch, virtual * shards in all
    orders = spark.createDataFrame([(i, o) for i, o in enumerate(ring.orders.tolist())], "stretch int, shards array<int>")
    placed = keys.join(F.broadcast(orders), "stretch").withColumn("may", F.array(*(may(s) for s in range(shards))))
    first = F.get(F.filter("shards", lambda s: F.get(F.col("may"), s)), F.lit(0))
    placed = placed.select("doc_id", "size", "text_crc32", *KEYS, first.alias("shard"))
    ordered = in_order(placed, ["shard", *KEYS], cache_input=None, keep=keep)
    # one row a shard
    sizes = ordered.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("first"))
    return positions(ordered, "slot").join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1 - F.col("first")).alias("slot"))
