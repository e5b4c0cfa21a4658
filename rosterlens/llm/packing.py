"""Best-fit packing by the linear grouping scheme.

Documents are tokenised, closed with an end id, and only those longer than a
sequence are cut. Packing then runs on counts of equal lengths (at most
``capacity`` numbers, whatever the corpus holds), and Spark puts the documents
in:

1. Large lengths, in descending order, form ``groups`` groups of equal
   cardinality; each length is rounded up to its group's largest.
2. Configurations of the few sizes come from a linear programme over all of
   them, new ones being generated by a knapsack at the sizes' prices. A room
   that small documents can use costs next to nothing, a smaller one is lost.
   Whole uses are taken; what is left of each size goes largest first, with
   the best configuration beside it. Of a few rooms that may count as usable
   and a few bounds of large lengths those with the fewest sequences in all
   are taken.
3. The actual documents take the places of their group by rank, so every
   sequence keeps at least the room the rounding promised.
4. Small lengths, longest first, go where they leave the least room (best fit)
   over the counts of sequences by room; what fits nowhere opens sequences.

Ranks come from counts per (length, hash bucket) and ranks inside a bucket, so
no task sees all documents of a length.

Defined results: null and empty texts are one piece, the end id; a very long
text is cut into as many pieces as it takes, in the one task that holds it;
equal rows are packed separately; null ids stay; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.textnum import blocks, text_buffers
from rosterlens.llm.tokens import WordIds
from rosterlens.llm.work import keep, lean, ship_code

BLOCK_BYTES = 1_000_000  # of texts tokenised at once: their words take many times as much
RANK_ROWS = 20_000  # rows of one length ranked together, on average
ROUNDS = 4  # configurations generated for each size, at most
GAIN = 1e-3  # of a sequence: a configuration that saves less ends the search
OPEN = 0.02  # of a sequence: cost of an empty one whose room small documents can use
LOST = 0.05  # of a sequence: what one without a usable room costs more
CLOSE = 1e-3  # share of sequences over the least possible that ends the search
SHARES = (8, 4, 2)  # lengths over this part of the capacity count as large


def _tokenise(path: str, capacity: int, end_id: int, with_ids: bool):
    names = ["doc", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        words = WordIds.of(path)
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            doc = batch.column(0)
            for i, j in blocks(bounds, BLOCK_BYTES):
                ids, ends = words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
                rows = []
                for d in range(i, j):
                    own = np.append(ids[ends[d - i]:ends[d - i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        part = own[at:at + capacity].tobytes()
                        row = (d, k, at, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if with_ids else row)
                cols = list(zip(*rows))
                out = [doc.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                       *(pa.array(c, pa.int64()) for c in cols[2:5])]
                if with_ids:
                    out.append(pa.array(cols[5], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names)
    return run


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
           end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc, piece, start, length, ids_crc32[, ids]) of all documents."""
    ship_code(docs.sparkSession)
    schema = "doc long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        lean(_tokenise(vocabulary, capacity, end_id, with_ids), keeps=True), schema + ", ids binary" * with_ids)


def ranked(df: DataFrame, by: str, order: list, name: str) -> tuple[DataFrame, dict[int, int]]:
    """``df`` with ``name``, 0, 1, ... within each value of ``by`` (an integer of
    bounded range), and the count of each value. Rows are ranked inside hash
    buckets; the buckets' counts give the offsets."""
    total = df.count()
    buckets = max(1, total // RANK_ROWS)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(by, "_bucket").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_base", F.sum("_n").over(
        Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).select(
        by, "_bucket", F.coalesce("_base", F.lit(0)).alias("_base"))
    counts = {r[0]: r[1] for r in sizes.groupBy(by).agg(F.sum("_n")).collect()}
    inside = F.row_number().over(Window.partitionBy(by, "_bucket").orderBy(*order))
    out = dealt.withColumn("_at", inside).join(offsets, [by, "_bucket"])
    return out.withColumn(name, F.col("_base") + F.col("_at") - 1).drop("_bucket", "_at", "_base"), counts


def _configuration(sizes: np.ndarray, worth: np.ndarray, most: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """How often each size is in the sequence of largest worth less cost, with
    no more of a size than ``most``, and that value. ``cost`` goes by load."""
    room = len(cost) - 1
    best = np.full(room + 1, -np.inf)
    best[0] = 0.0
    steps = []
    for s, w, n in zip(sizes.tolist(), worth.tolist(), most.tolist()):
        times = np.zeros(room + 1, np.int16)
        before = best
        for t in range(1, min(n, room // s) + 1):
            value = before[:room + 1 - t * s] + t * w
            if t == 1:
                best = before.copy()
            better = np.flatnonzero(value > best[t * s:]) + t * s
            best[better] = value[better - t * s]
            times[better] = t
        steps.append(times)
    value = best - cost
    load = int(value.argmax())
    found, value = np.zeros(len(sizes), np.int64), float(value[load])
    for k in range(len(sizes) - 1, -1, -1):
        found[k] = steps[k][load]
        load -= found[k] * int(sizes[k])
    return found, value


def _optimal(sizes: np.ndarray, counts: np.ndarray, cost: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each (fractions) at the least total
    cost: a linear programme over all configurations, which are generated as
    the prices of the sizes call for them."""
    room, n = len(cost) - 1, len(sizes)
    alone = room // sizes
    columns = np.diag(alone).astype(float)
    inverse = np.diag(1.0 / alone)
    used = counts / alone
    prices = cost[alone * sizes]
    for _ in range(ROUNDS * n):
        worth = prices @ inverse
        fresh, gain = _configuration(sizes, worth, alone, cost)
        if gain < GAIN:
            break
        step = inverse @ fresh
        up = step > 1e-9
        ratio = np.where(up, used / np.where(up, step, 1.0), np.inf)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * step, 0.0)
        used[out] = ratio[out]
        columns[:, out], prices[out] = fresh, cost[int(fresh @ sizes)]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
    return [(columns[:, i].astype(np.int64), float(used[i])) for i in np.argsort(-used, kind="stable") if used[i] > 0]


def _grouped(lengths: dict[int, int], groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rank, size and cardinality of the groups over the descending
    lengths; groups of one size are one."""
    order = np.array(sorted(lengths, reverse=True), np.int64)
    ends = np.cumsum([lengths[x] for x in order.tolist()])
    total = int(ends[-1])
    starts = np.arange(0, total, -(-total // groups))
    sizes = order[np.searchsorted(ends, starts, "right")]  # rounded up to the group's first
    first = np.flatnonzero(np.append(True, sizes[1:] != sizes[:-1]))
    starts = starts[first]
    return starts, sizes[first], np.diff(np.append(starts, total))


def plan_large(lengths: dict[int, int], capacity: int, groups: int, usable: int) -> tuple[list, int]:
    """Intervals (from, to, first bin, slot) over the large documents in
    descending order of length, and the number of bins. A room of ``usable``
    or more counts as left to the small documents, a smaller one as lost."""
    if not lengths:
        return [], 0
    starts, sizes, counts = _grouped(lengths, groups)
    load = np.arange(capacity + 1)
    cost = np.where(capacity - load >= usable, OPEN + (1 - OPEN) * load / capacity, 1 + LOST)
    left, used = counts.copy(), np.zeros(len(starts), np.int64)
    out, bins = [], 0

    def place(configuration: np.ndarray, times: int) -> None:
        nonlocal bins
        slot = 0
        for k in np.flatnonzero(configuration):
            for _ in range(int(configuration[k])):
                begin = int(starts[k] + used[k])
                out.append((begin, begin + times, bins, slot))
                used[k] += times
                slot += 1
        left[:] -= configuration * times
        bins += times

    for configuration, times in _optimal(sizes, counts, cost):
        if int(times + 1e-6):
            place(configuration, int(times + 1e-6))
    # the rest, less than one sequence of each configuration: the largest size, with the best beside it
    while left.any():
        top = int(np.flatnonzero(left)[0])
        left[top] -= 1
        beside, _ = _configuration(sizes, sizes * (1 + GAIN) / capacity, left, cost[int(sizes[top]):])
        left[top] += 1
        beside[top] += 1
        place(beside, int((left[beside > 0] // beside[beside > 0]).min()))
    return out, bins


def rooms_left(intervals: list, lengths: dict[int, int], capacity: int) -> dict[int, int]:
    """Sequences by the room that the actual documents of a plan leave."""
    order = np.array(sorted(lengths, reverse=True), np.int64)
    ends = np.cumsum([lengths[x] for x in order.tolist()])
    runs: dict[tuple, list] = {}
    for begin, end, first, _ in intervals:
        runs.setdefault((first, end - begin), []).append(begin)
    out: dict[int, int] = {}
    for (_, times), begins in runs.items():
        cuts = {0, times}  # where the length of one of the documents changes
        for b in begins:
            lo, hi = np.searchsorted(ends, [b, b + times], "right")
            cuts.update(c for c in (ends[lo:hi] - b).tolist() if c < times)
        cuts = sorted(cuts)
        for a, b in zip(cuts, cuts[1:]):
            held = order[np.searchsorted(ends, np.array(begins) + a, "right")].sum()
            room = capacity - int(held)
            out[room] = out.get(room, 0) + b - a
    return out


def plan_small(rooms: dict[int, int], lengths: dict[int, int], capacity: int) -> tuple[list, int]:
    """Intervals (length, from, to, room of the sequence, its first rank, slot)
    for the small documents; sequences not in ``rooms`` yet have room
    ``capacity`` and ranks from 0. Also the number of those."""
    # by room left: pieces of the initial rooms (initial room, first rank, count, next slot)
    state: dict[int, list] = {}
    for room, n in rooms.items():
        state.setdefault(room, []).append((room, 0, n, 0))
    levels = sorted(state)
    out, opened = [], 0
    for length in sorted(lengths, reverse=True):
        todo, done = lengths[length], 0
        while done < todo:
            i = bisect.bisect_left(levels, length)
            if i == len(levels):
                n = -(-(todo - done) // (capacity // length))
                part, room = (capacity, opened, n, 0), capacity
                opened += n
            else:
                room = levels[i]
                part = state[room].pop()
                if not state[room]:
                    del state[room]
                    levels.pop(i)
            first, rank, n, slot = part
            take = min(n, todo - done)
            out.append((length, done, done + take, first, rank, slot))
            done += take
            for back, piece in ((room - length, (first, rank, take, slot + 1)), (room, (first, rank + take, n - take, slot))):
                if piece[2]:
                    if back not in state:
                        state[back] = []
                        bisect.insort(levels, back)
                    state[back].append(piece)
    return out, opened


def plan(lengths: dict[int, int], capacity: int, groups: int) -> tuple[int, list, int]:
    """The least large length, the large documents' intervals and the number of
    their bins, with the fewest sequences found once the small ones are in.

    Tried are lengths over an eighth, a quarter and half of the capacity as
    large, and as usable rooms the lengths that half, three and one quarter of
    the small documents do not pass, or none. A plan within ``CLOSE`` of the
    least possible number ends the search."""
    least = -(-sum(k * n for k, n in lengths.items()) // capacity)
    fewest, best = None, (1, [], 0)
    for part in SHARES:
        large = {k: n for k, n in lengths.items() if k > capacity // part}
        small = {k: n for k, n in lengths.items() if k <= capacity // part}
        usable = [capacity + 1]
        if small:
            order = sorted(small)
            shares = np.cumsum([small[x] for x in order])
            usable = [order[int(np.searchsorted(shares, share * shares[-1]))] for share in (0.5, 0.75, 0.25)] + usable
        for room in usable:
            intervals, bins = plan_large(large, capacity, groups, room)
            total = bins + plan_small(rooms_left(intervals, large, capacity), small, capacity)[1]
            if fewest is None or total < fewest:
                fewest, best = total, (capacity // part + 1, intervals, bins)
            if total <= least * (1 + CLOSE):
                return best
    return best


def _placed(intervals: list, capacity: int):
    """Rows (length, rank, ...) of small documents with their sequence's room and rank and the slot."""
    intervals = sorted(intervals)
    a = np.array(intervals, np.int64).reshape(-1, 6)
    span = int(a[:, 2].max()) + 1 if len(a) else 1
    keys = a[:, 0] * span + a[:, 1]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            i = np.searchsorted(keys, length * span + rank, "right") - 1
            room, at, slot = a[i, 3], a[i, 4] + rank - a[i, 1], a[i, 5]
            extra = [pa.array(room), pa.array(at), pa.array(slot)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "room", "seat", "slot"])
    return run


def _seated(intervals: list, base: dict[int, int]):
    """Rows (length, rank, ...) of large documents with their sequence and slot."""
    a = np.array(sorted(intervals), np.int64).reshape(-1, 4)
    longest = max(base, default=0)
    table = np.zeros(longest + 1, np.int64)
    for k, v in base.items():
        table[k] = v

    def run(batches):
        for batch in batches:
            at = table[batch.column("length").to_numpy()] + batch.column("rank").to_numpy()
            i = np.searchsorted(a[:, 0], at, "right") - 1
            extra = [pa.array(a[i, 2] + at - a[i, 0]), pa.array(a[i, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "bin", "slot"])
    return run


def pack(table: DataFrame, capacity: int = 4096, groups: int = 64) -> DataFrame:
    """Rows of ``pieces`` with sequence_id and offset."""
    names = [c for c in table.columns if c != "ids"]
    order = ["doc", "piece", "ids_crc32"]
    ranks, counts = ranked(table, "length", order, "rank")
    ranks = keep(ranks, "ranks")
    spec = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranks.schema)
    large_from, intervals, bins = plan(counts, capacity, groups)
    large = {k: v for k, v in counts.items() if k >= large_from}
    small = {k: v for k, v in counts.items() if k < large_from}
    base, at = {}, 0
    for k in sorted(large, reverse=True):
        base[k] = at
        at += large[k]
    seated = ranks.where(F.col("length") >= large_from)
    seated = keep(seated.mapInArrow(_seated(intervals, base), spec + ", bin long, slot long"), "seated")
    filled = seated.groupBy("bin").agg((capacity - F.sum("length")).alias("room"))
    roomy, rooms = ranked(filled, "room", ["bin"], "seat")
    moves, opened = plan_small(rooms, small, capacity)
    placed = ranks.where(F.col("length") < large_from).mapInArrow(
        _placed(moves, capacity), spec + ", room long, seat long, slot long")
    # room = capacity is a sequence opened for small documents: no large one leaves that much
    old = placed.where(F.col("room") < capacity).join(roomy, ["room", "seat"]).withColumn("slot", F.col("slot") + capacity)
    new = placed.where(F.col("room") == capacity).withColumn("bin", F.col("seat") + bins)
    columns = [*table.columns, "bin", "slot"]
    rows = seated.select(*columns).unionByName(old.select(*columns)).unionByName(new.select(*columns))
    ahead = F.sum("length").over(Window.partitionBy("bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("offset", F.coalesce(ahead, F.lit(0))).select(
        *table.columns, F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``."""
    table = keep(pieces(docs, vocabulary, id_col, text_col, capacity, with_ids=with_ids), "pieces")
    return pack(table, capacity).withColumnRenamed("doc", id_col)
