"""N-gram Jaccard join with set-relation skipping.

Documents become sets of word shingles; two documents link when their sets'
Jaccard similarity reaches ``percent`` per cent, and the result gives each
document the component it belongs to. Exact, in four steps:

1. Equal sets are one set from the start (``sid``, a 63-bit digest of the set;
   two different sets share one with probability 2**-63 a pair).
2. Shingles meet in buckets of the hash space, where each one's number of sets
   is counted. Shingles of a single set cannot be shared, so they only count;
   the others travel back to their sets. With shingles in the order (number of
   sets, hash), linked sets share one within their prefixes, so sets whose
   prefix is filled with unshared shingles are out without a comparison.
3. Answer level: each remaining set is compared with one root, the set of its
   lists with the fewest unshared shingles; where the two are highly similar, the
   set's differences from its root are kept. Sets linked to the same root are
   one component; their pairs are never made.
4. Index level: an index list holds a shingle's sets in blocks of one set size
   and position. Two blocks are skipped as a whole, no entry of theirs visited,
   when sizes or positions rule out all their pairs or all their sets are in one
   component already. Of the pairs in open blocks those fall whose known overlaps
   with a common root bound theirs from above, and those are links whose bound
   from below proves it.
5. What is left is answered incrementally where both sets are highly similar to
   one root: with R the root, - and + a set's missing and added shingles, the
   overlap is |R| - |a-| - |b-| + |a- & b-| + |a+ & b+|, so only differences are
   read. Pairs without such a root are verified on the sets.

Defined results: a null text is an empty one; a document without words has no
shingles, component = its own id; equal rows stay rows; a null id stays and
never names a component unless all ids in it are null; further columns of the
input are ignored; an empty table gives an empty result; a very long text is
read whole, in one task, its shingles as any others.

Disk: shingles are dealt in ``ROUNDS`` rounds of buckets, so a quarter of them is
in a shuffle at a time; no document's text is shuffled but once, in ``one_of_each``
(and once more, where rows with equal id and text are in it).

Scale: one bucket holds ``BUCKET_TOKENS`` shingles on average plus one entry
for each set that holds its most common shingle. An index list of more than
``LIST_ROWS`` sets is walked by many tasks: its sets are parted by size class
(linked ones are at most one class apart) and by digest, and every two parts
meet in one task. ``MOST_WEIGHT`` caps a shingle's count where it orders
prefixes only; ties then stand in the order of their hashes.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.components import connected_components
from rosterlens.llm.textnum import MULTIPLIERS, U, Words, blocks, mix, shingle_sets, text_buffers
from rosterlens.llm.work import carried, discard, keep, lean, lean_group, ship_code

BLOCK_BYTES = 1_000_000
FLUSH_TOKENS = 1_000_000
BUCKET_TOKENS = 3_000_000
ROUNDS = 4  # in which the buckets are dealt at most
STRETCHES = 16  # of a bucket, compared one after the other
MOST_WEIGHT = 65_535
LIST_ROWS = 4096  # sets of an index list that one task walks
BLOCK_ROWS = 512  # entries of a block at most
PAIR_ROWS = 1_000_000  # entry pairs in hand at once


def _sid(s: np.ndarray) -> int:
    total = np.array([np.add.reduce(mix(s)), len(s)], U)
    return int(mix(total[:1] + total[1:] * MULTIPLIERS[0])[0] >> U(1))


def _sets_of(column: pa.Array, size: int):
    """(row, sorted distinct shingles) of every text of an Arrow column."""
    data, bounds = text_buffers(column)
    for i, j in blocks(bounds, BLOCK_BYTES):
        words = Words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        yield from zip(range(i, j), shingle_sets(words, size))


def _measure(size: int):
    def run(batches):
        for batch in batches:
            n, sid = [], []
            for _, s in _sets_of(batch.column(1), size):
                n.append(len(s))
                sid.append(_sid(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), batch.column(2)],
                                             ["doc", "n", "sid", "hash"])
    return run


def _deal(size: int, bits: int, rounds: int = 1, number: int = 0):
    """Shingles of the distinct sets of a task, dealt to buckets by their top
    bits: in round ``number`` of ``rounds`` those whose bucket has that remainder."""
    names = ["bucket", "sids", "ns", "counts", "hashes"]

    def flush(sids, sizes, sets):
        h = np.concatenate(sets)
        n, ids = np.array(sizes), np.array(sids, np.int64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        bucket = (h >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
        order = np.argsort(bucket, kind="stable")
        h, owner, bucket = h[order], owner[order], bucket[order]
        edge = np.flatnonzero(np.diff(bucket)) + 1
        rows = []
        for a, b in zip(np.append(0, edge), np.append(edge, len(h))):
            o = owner[a:b]
            at = np.append(0, np.flatnonzero(np.diff(o)) + 1)
            who = o[at]
            rows.append((int(bucket[a]), ids[who].tobytes(), n[who].astype("<i4").tobytes(),
                         np.diff(np.append(at, b - a)).astype("<i4").tobytes(), h[a:b].astype("<u8").tobytes()))
        kinds = [pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        seen, sids, sizes, sets, held = set(), [], [], [], 0
        for batch in batches:
            for _, s in _sets_of(batch.column(0), size):
                if not len(s) or (sid := _sid(s)) in seen:
                    continue
                seen.add(sid)
                here = s[(s >> U(64 - bits)) % U(rounds) == number] if rounds > 1 else s
                if not len(here):
                    continue
                sids.append(sid)
                sizes.append(len(s))
                sets.append(here)
                held += len(here)
                if held >= FLUSH_TOKENS:
                    yield flush(sids, sizes, sets)
                    sids, sizes, sets, held = [], [], [], 0
        if sets:
            yield flush(sids, sizes, sets)
    return run


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return text_buffers(table.column(name))[0].view(kind)


def _shared(parts: int):
    """In one bucket: the shingles of two sets or more, back to groups of sets.

    Shingles are compared in ``STRETCHES`` stretches of their low bits, so that
    only one stretch at a time is unpacked and sorted."""
    schema = pa.schema([("part", pa.int64()), *((c, pa.binary()) for c in ("sids", "ns", "counts", "hashes", "weights"))])

    def run(table: pa.Table) -> pa.Table:
        sids, ns = _joined(table, "sids", "<i8"), _joined(table, "ns", "<i4")
        raw = _joined(table, "hashes", "<u8")
        first = np.zeros(len(sids), bool)  # a set met in several tasks counts once
        first[np.unique(sids, return_index=True)[1]] = True
        of = np.repeat(np.arange(len(sids), dtype=np.int32), _joined(table, "counts", "<i4"))
        stretch = np.where(first[of], (raw % U(STRETCHES)).astype(np.uint8), STRETCHES).astype(np.uint8)
        found = []
        for k in range(STRETCHES):
            at = np.flatnonzero(stretch == k)
            h = raw[at]
            order = np.argsort(h, kind="stable")
            h, at = h[order], at[order]
            edge = np.append(0, np.flatnonzero(h[1:] != h[:-1]) + 1) if len(h) else np.zeros(0, np.int64)
            size = np.diff(np.append(edge, len(h)))
            weight = np.repeat(np.minimum(size, MOST_WEIGHT).astype("<u2"), size)
            shared = weight > 1
            found.append((h[shared], of[at[shared]], weight[shared]))
        del raw, stretch
        h, of, weight = (np.concatenate(x) for x in zip(*found))
        del found
        part = sids % parts
        place = np.empty(len(sids), np.int32)  # of a set, groups one after the other
        place[np.argsort(part, kind="stable")] = np.arange(len(sids), dtype=np.int32)
        order = np.argsort(place[of], kind="stable")
        h, of, weight = h[order], of[order], weight[order]
        del order
        rows = []
        at = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1) if len(of) else np.zeros(0, np.int64)
        who = of[at]
        count = np.diff(np.append(at, len(of))).astype("<i4")
        edge = np.flatnonzero(np.diff(part[who])) + 1
        for a, b in zip(np.append(0, edge), np.append(edge, len(who))):
            if b > a:
                x, y = at[a], at[b] if b < len(at) else len(of)
                rows.append((int(part[who[a]]), sids[who[a:b]].tobytes(), ns[who[a:b]].tobytes(), count[a:b].tobytes(),
                             h[x:y].tobytes(), weight[x:y].tobytes()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, schema)], schema=schema)
    return run


def _prefixes(percent: int):
    """Of one group of sets: those whose prefix reaches shared shingles."""
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("v", pa.int64()),
                        ("prefix", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])

    def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values.view(np.int64)))

    def run(table: pa.Table) -> pa.Table:
        sids, ns = _joined(table, "sids", "<i8"), _joined(table, "ns", "<i4").astype(np.int64)
        h, w = _joined(table, "hashes", "<u8"), _joined(table, "weights", "<u2")
        ids, number = np.unique(sids, return_inverse=True)
        n = np.zeros(len(ids), np.int64)
        n[number] = ns
        of = np.repeat(number.astype(np.int32), _joined(table, "counts", "<i4"))
        v = np.bincount(of, minlength=len(ids))
        most = n - (percent * n + 99) // 100 + 1 - (n - v)  # prefix places left for shared shingles
        chosen = (most > 0)[of]
        h, w, of = h[chosen], w[chosen], of[chosen]
        order = np.lexsort((h, of))
        h, w = h[order], w[order]
        del order, of, chosen
        sets = np.flatnonzero(most > 0)
        edge = np.append(0, np.cumsum(v[sets]))
        prefix = []  # equal weights stand in the order of their hashes
        for a, b, k in zip(edge[:-1], edge[1:], most[sets]):
            prefix.append(h[a:b][np.argsort(w[a:b], kind="stable")[:k]])
        sizes = np.array([len(x) for x in prefix], np.int64)
        prefix = np.concatenate([np.zeros(0, U), *prefix])
        return pa.table([pa.array(ids[sets]), pa.array(n[sets]), pa.array(v[sets].astype(np.int64)), lists(prefix, sizes),
                         lists(h, v[sets])], schema=schema)
    return run


def _parted(percent: int):
    """The parts (g, s, t) of an index list in which an entry meets others: a
    short list is one part. In a long one the sets of size class g and digest
    part s (role 1; 0 where s = t) meet those of part t of their class (s < t)
    or the next (role 2); entries of one role 1 or 2 do not meet."""
    many = f"cast(ceil(many / {LIST_ROWS}) as int)"
    size_class = f"cast(floor(ln(n) / {math.log(100 / percent) + 1e-4!r}) as int)"

    def part(g, s, t, role):
        return f"named_struct('g', {g}, 's', {s}, 't', {t}, 'role', {role})"

    return F.expr(f"""if(many <= {LIST_ROWS}, array({part(0, 0, 0, 0)}), flatten(transform(
        array(named_struct('k', {many}, 'g', {size_class}, 'own', cast(pmod(xxhash64(sid), {many}) as int))), e -> concat(
            transform(sequence(0, e.k - 1), x -> {part('e.g', 'e.own', 'x', 'if(x = e.own, 0, 1)')}),
            transform(filter(sequence(0, e.k - 1), x -> x < e.own), x -> {part('e.g', 'x', 'e.own', 2)}),
            transform(sequence(0, e.k - 1), x -> {part('e.g - 1', 'x', 'e.own', 2)})))))""")


def _walk(percent: int):
    """Pairs of the index lists that no bound settles, and those a bound proves.

    Rows come sorted by list part, set size and position; a part is never cut."""
    key = ["h", "g", "s", "t"]
    names = [*key, "n", "pos", "role", "sid", "v", "label", "root", "o", "rv"]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_()), ("kin", pa.bool_())])

    def changes(c, columns):
        new = np.ones(len(c["h"]), bool)
        new[1:] = np.logical_or.reduce([c[x][1:] != c[x][:-1] for x in columns])
        return new

    def open_blocks(c):
        """(first rows of two blocks, their sizes, whether they are one block)."""
        lists = np.cumsum(changes(c, key))
        row = np.arange(len(lists))
        new = changes(c, [*key, "n", "pos", "role"])
        new |= (row - np.maximum.accumulate(np.where(new, row, 0))) % BLOCK_ROWS == 0
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(lists)))
        lo, hi = np.minimum.reduceat(c["label"], at), np.maximum.reduceat(c["label"], at)
        lists, n, rest, role = lists[at], c["n"][at], (c["n"] - c["pos"])[at], c["role"][at]
        i, d = np.arange(len(at)), 0
        while len(i):
            i = i[i + d < len(at)]
            j = i + d
            # sizes only grow along a list: past this block all later ones are skipped too
            near = (lists[j] == lists[i]) & (100 * n[i] >= percent * n[j])
            i, j = i[near], j[near]
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            one = (lo[i] == hi[j]) & (lo[j] == hi[i])  # lo <= hi: all labels are one
            meet = (role[i] != role[j]) | (role[i] == 0)
            go = (np.minimum(rest[i], rest[j]) >= need) & ~one & meet
            x, y = i[go], j[go]
            edge = np.searchsorted(np.cumsum(size[x] * size[y]), np.arange(0, (size[x] * size[y]).sum(), PAIR_ROWS))
            for p, q in zip(edge, np.append(edge[1:], len(x))):
                if q > p:
                    yield at[x[p:q]], at[y[p:q]], size[x[p:q]], size[y[p:q]], d == 0
            d += 1

    def pairs(c):
        n, pos, sid, v, label, root, o, rv = (c[x] for x in names[4:] if x != "role")
        for x, y, nx, ny, self_pair in open_blocks(c):
            count = nx * ny
            of = np.repeat(np.arange(len(count)), count)
            k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            i, j = x[of] + k // ny[of], y[of] + k % ny[of]
            if self_pair:
                i, j = i[i < j], j[i < j]
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            most = np.minimum(np.minimum(v[i], v[j]), np.minimum(n[i] - pos[i], n[j] - pos[j]))
            kin = root[i] == root[j]
            most = np.where(kin, np.minimum(most, np.minimum(o[i], o[j]) + np.minimum(v[i] - o[i], v[j] - o[j])), most)
            go = (label[i] != label[j]) & (most >= need)
            i, j, kin = i[go], j[go], kin[go]
            if len(i):
                sure = kin & (o[i] + o[j] - rv[i] >= need[go])
                yield np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j]), sure, kin

    def merged(found):
        a, b, sure, kin = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((~sure, b, a))
        a, b, sure, kin = a[order], b[order], sure[order], kin[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (a, b, sure, kin)], schema=schema)

    def batch_of(c):
        found, held = [], 0
        for x in pairs(c):
            found.append(x)
            held += len(x[0])
            if held >= PAIR_ROWS:
                yield merged(found)
                found, held = [], 0
        if found:
            yield merged(found)

    def run(batches):
        rest = None
        for batch in batches:
            c = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in names}
            if rest is not None:
                c = {x: np.concatenate([rest[x], c[x]]) for x in names}
            if not len(c["h"]):
                continue
            last = int(np.flatnonzero(changes(c, key))[-1])
            if last:
                yield from batch_of({x: y[:last] for x, y in c.items()})
            rest = {x: y[last:] for x, y in c.items()}
        if rest is not None:
            yield from batch_of(rest)
    return run


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with the exact overlap o and both set sizes, and both sets' shared shingles."""
    one = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(one, "a").join(two, "b").withColumn("o", F.size(F.array_intersect("ta", "tb")).cast("long"))


def _derived(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """pairs (a, b) with na, nb and their overlap o by the differences from a
    common root (``kin``); null where one of them is not highly similar to it."""
    def of(side):
        return stars.where("minus is not null").select(
            F.col("b").alias(side), F.col("nb").alias(f"n{side}"), F.col("rv").alias(f"rv{side}"),
            F.col("minus").alias(f"minus{side}"), F.col("plus").alias(f"plus{side}"))

    o = F.expr("""if(kin, rva - size(minusa) - size(minusb) + size(array_intersect(minusa, minusb))
                  + size(array_intersect(plusa, plusb)), null)""")
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", "na", "nb", o.cast("long").alias("o"))


def set_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """(doc, n, sid, hash): set size, set digest and hash of the text of every document."""
    ship_code(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("hash")).mapInArrow(lean(_measure(size)), "doc long, n long, sid long, hash long")


def linked_sets(docs: DataFrame, total: int, text_col: str, size: int, percent: int) -> DataFrame:
    """Edges (a, b) between set digests whose components are those of all links."""
    bits = max(0, math.ceil(math.log2(max(1, total / BUCKET_TOKENS))))
    parts = 2 ** bits
    # every shingle is dealt once, but only a round's share of them is on disk at a time
    rounds = min(ROUNDS, parts)
    back = []
    for number in range(rounds):
        dealt = docs.select(text_col).mapInArrow(lean(_deal(size, bits, rounds, number)),
                                                 "bucket long, sids binary, ns binary, counts binary, hashes binary")
        back.append(keep(dealt.groupBy("bucket").applyInArrow(
            lean_group(_shared(parts)), "part long, sids binary, ns binary, counts binary, hashes binary, weights binary"), "shared"))
    sets = keep(reduce(DataFrame.unionByName, back).groupBy("part").applyInArrow(
        lean_group(_prefixes(percent)), "sid long, n long, v long, prefix array<long>, tokens array<long>"), "sets")
    discard(*back)
    entries = sets.select("sid", "n", "v", F.posexplode("prefix").alias("i", "h")).withColumn("pos", F.expr("n - v + i"))
    entries = entries.withColumn("rank", F.struct(((F.col("n") - F.col("v")) * 1000 / F.col("n")).cast("long"), "sid"))
    heads = entries.groupBy("h").agg(F.min("rank").alias("best"), F.count("*").alias("many"))
    lists = keep(entries.join(heads.where("many > 1"), "h").select("h", "sid", "n", "v", "pos", "many", "best"), "lists")
    roots = lists.groupBy("sid").agg(F.min("best").alias("best")).select("sid", F.col("best.sid").alias("root"))
    first_look = _overlaps(roots.where("sid != root").select(F.col("root").alias("a"), F.col("sid").alias("b")), sets)
    alike = 4 * F.col("o") >= 3 * F.greatest(F.size("ta"), F.size("tb"))  # highly similar: differences stay short
    stars = keep(first_look.select("a", "b", "na", "nb", "o", F.size("ta").cast("long").alias("rv"),
                                   F.when(alike, F.array_except("ta", "tb")).alias("minus"),
                                   F.when(alike, F.array_except("tb", "ta")).alias("plus")), "stars")
    link = F.expr(f"{100 + percent} * o >= {percent} * (na + nb)")
    first = stars.where(link).select("a", "b")
    found = connected_components(first, "a", "b")
    info = (roots.join(stars.select(F.col("b").alias("sid"), "o"), "sid", "left")
            .join(found.select(F.col("node").alias("sid"), F.col("root").alias("label")), "sid", "left")
            .join(sets.select(F.col("sid").alias("root"), F.col("v").alias("rv")), "root", "left"))
    known = keep(lists.drop("best").join(info, "sid")
                 .select("h", "n", "pos", "sid", "v", "many", F.coalesce("label", "sid").alias("label"), "root",
                         F.coalesce("o", "v").alias("o"), F.coalesce("rv", F.lit(0)).alias("rv")), "known")
    mixed = known.join(known.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
                       .select("h"), "h")
    rows = mixed.withColumn("part", F.explode(_parted(percent))).select("*", "part.*").drop("part", "many")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    walked = keep(rows.repartition(parts, "h", "g", "s", "t").sortWithinPartitions("h", "g", "s", "t", "n", "pos", "role")
                  .mapInArrow(lean(_walk(percent)), "a long, b long, sure boolean, kin boolean")
                  .groupBy("a", "b").agg(F.max("sure").alias("sure"), F.max("kin").alias("kin")), "pairs")
    sure = walked.where("sure").select("a", "b")
    answers = keep(_derived(walked.where("not sure"), stars), "answers")
    verified = _overlaps(answers.where("o is null").select("a", "b"), sets)
    return (first.unionByName(sure).unionByName(answers.where(link).select("a", "b"))
            .unionByName(verified.where(link).select("a", "b")))


def _rooted(docs: DataFrame, table: DataFrame, text_col: str, size: int, percent: int) -> DataFrame:
    """(sid, root) of the sets in links: root names the component."""
    total = table.agg(F.sum("n")).first()[0] or 0
    found = connected_components(linked_sets(docs, total, text_col, size, percent), "a", "b")
    return found.select(F.col("node").alias("sid"), "root")


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                       percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    table = keep(set_table(docs, id_col, text_col, size), "measures")
    low = (table.where("sid is not null").groupBy("sid").agg(F.min("doc").alias("low"))
           .join(_rooted(docs, table, text_col, size, percent), "sid", "left")
           .select("sid", "low", F.coalesce("root", "sid").alias("root")))
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    named = low.join(least, "root").select("sid", "component_id")
    return table.join(named, "sid", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component: the one with the smallest id, null last, and
    of that id's texts in the component the one with the smallest hash; of rows
    equal in both, any. Ids may repeat: rows of one id in two components are two
    rows. Rows without words stay. All columns are kept."""
    table = keep(set_table(docs, id_col, text_col, size), "measures")
    many = table.where("sid is not null").groupBy("sid", "doc", "hash").agg(F.count("*").alias("many"))
    rank = F.struct(F.col("doc").isNull().alias("none"), "doc", "hash", "many")
    low = many.groupBy("sid").agg(F.min(rank).alias("low"))
    first = (low.join(_rooted(docs, table, text_col, size, percent), "sid", "left")
             .groupBy(F.coalesce("root", "sid").alias("root")).agg(F.min("low").alias("low"))
             .select(F.col("low.doc").alias("id"), F.col("low.hash").alias("hash"), (F.col("low.many") > 1).alias("repeats")))
    # a row without words is not compared with others
    stay = table.where("sid is null").select(F.col("doc").alias("id"), "hash", F.lit(False).alias("repeats")).distinct()
    picked = keep(first.unionByName(stay), "picked")
    repeated = keep(picked.where("repeats"), "repeated")
    rows = carried(docs, doc=F.col(id_col).cast("long"), text_hash=F.xxhash64(text_col))

    def found(those: DataFrame) -> DataFrame:
        return rows.join(those, rows.doc.eqNullSafe(those.id) & (rows.text_hash == those.hash))

    alone = found(picked.where("not repeats")).select("row")
    if repeated.isEmpty():
        return alone.select("row.*")
    one = Window.partitionBy("id", "hash").orderBy("hash")
    chosen = found(repeated).withColumn("rank", F.row_number().over(one)).where("rank = 1").select("row")
    return alone.unionByName(chosen).select("row.*")
