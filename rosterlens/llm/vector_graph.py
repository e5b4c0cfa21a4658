"""Embedding near-duplicates through hierarchical navigable small-world graphs.

Only vectors with one label (not null) are compared, by cosine.

1. Vectors of a label with equal components are one vector with a count.
2. A label's vectors are dealt by hash to shards of at most about ``shard_rows``;
   each shard gets a graph: levels drawn from the vector's hash, neighbours
   found by beam search in the graph so far, ``links`` a node (twice that on the
   lowest level), kept in the shared folder.
3. Every vector queries every shard of its label, in blocks. A block widens its
   beam until an audit passes: for some of its queries, more until they have
   ``AUDIT_LINKS`` links, the links are also found by brute force over the
   shard, and the beam doubles until ``RECALL`` of them are found. Beams that
   end full of links are answered by the exact product, as is a block that has
   too few links to audit or whose widest beam still fails.
4. Found pairs are verified in double precision; a block's links become edges
   to the smallest node of their local component, and a label-wide union of
   those edges gives components.

Defined results: a vector that is null, empty, all zero or holds a null or
non-finite component links with nothing, as does one without label; lengths
may differ, vectors of different lengths link with nothing; equal rows are
separate vectors; null ids stay; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.components import connected_components
from rosterlens.llm.work import keep, ship_code

SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
LINKS = 12
BEAM = 48
AUDIT_ROWS = 48  # queries of the first audit
AUDIT_LINKS = 32  # true links that an audit sees at least, or the whole block
RECALL = 0.99
WIDEST = 16 * BEAM  # beam beyond which the exact product costs less
GOLDEN = (5 ** 0.5 - 1) / 2
STEP = 512  # queries searched in step


class Graph:
    """A small-world graph over unit vectors; searched for many queries at once."""

    def __init__(self, vectors: np.ndarray, level: np.ndarray, near: list[np.ndarray], entry: int):
        self.vectors, self.level, self.near, self.entry = vectors, level, near, entry

    @classmethod
    def build(cls, vectors: np.ndarray, level: np.ndarray, links: int = LINKS, beam: int = BEAM) -> "Graph":
        n = len(vectors)
        top = int(level.max()) if n else 0
        order = np.argsort(-level, kind="stable")  # upper levels are complete before the rest comes
        near = [np.full((n, links * (2 if lv == 0 else 1)), -1, np.int32) for lv in range(top + 1)]
        graph = cls(vectors, level, near, int(order[0]) if n else -1)
        done = 1
        while done < n:
            batch = order[done:done + min(done, STEP)]
            graph._insert(batch, order[:done], beam, links)
            done += len(batch)
        return graph

    def _insert(self, batch: np.ndarray, before: np.ndarray, beam: int, links: int) -> None:
        v = self.vectors[batch]
        among = v @ v.T
        np.fill_diagonal(among, -2)
        start = np.full((len(batch), 1), self.entry, np.int64)
        for lv in range(len(self.near) - 1, -1, -1):
            found, score = self._search(v, start, lv, beam if lv <= self.level[batch].max() else 1)
            start = found
            here = np.flatnonzero(self.level[batch] >= lv)
            if not len(here):
                continue
            # neighbours: from the graph, and from the batch itself
            mates = among[np.ix_(here, here)]
            k = min(links, len(here))
            pick = np.argpartition(-mates, k - 1, axis=1)[:, :k]
            ids = np.concatenate([found[here], batch[here][pick]], 1)
            sc = np.concatenate([score[here], np.take_along_axis(mates, pick, 1)], 1)
            ids[sc < -1.5] = -1
            chosen = self._diverse(ids, sc, links)
            self.near[lv][batch[here], :links] = chosen
            a = np.repeat(batch[here], links)
            b = chosen.ravel().astype(np.int64)
            self._back(lv, b[b >= 0], a[b >= 0])

    def _diverse(self, ids: np.ndarray, score: np.ndarray, links: int) -> np.ndarray:
        """Of each row's candidates, best first, those nearer to the node than to one
        already chosen; places that stay open go to the best of the others."""
        order = np.argsort(-score, axis=1, kind="stable")[:, :3 * links]
        ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
        x = self.vectors[np.maximum(ids, 0)]
        among = np.einsum("qad,qbd->qab", x, x)
        chosen = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            twin = (chosen & (ids == ids[:, j:j + 1])).any(1)
            close = (chosen & (among[:, j, :] > score[:, j:j + 1])).any(1)
            chosen[:, j] = (ids[:, j] >= 0) & ~twin & ~close & (chosen.sum(1) < links)
        rank = np.where(chosen, 0, np.where(ids >= 0, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        take = np.argsort(rank, axis=1)[:, :links]
        out = np.full((len(ids), links), -1, np.int32)
        got = np.take_along_axis(ids, take, 1)
        out[:, :got.shape[1]] = got
        return out

    def _back(self, lv: int, node: np.ndarray, other: np.ndarray) -> None:
        """Adds ``other`` to each ``node``'s neighbours; a full node keeps the nearest ones."""
        near = self.near[lv]
        width = near.shape[1]
        order = np.lexsort((other, node))
        node, other = node[order], other[order]
        nodes, first, count = np.unique(node, return_index=True, return_counts=True)
        extra = np.full((len(nodes), min(int(count.max(initial=0)), 4 * width)), -1, np.int64)
        at = np.arange(len(node)) - np.repeat(first, count)
        fits = at < extra.shape[1]
        extra[np.repeat(np.arange(len(nodes)), count)[fits], at[fits]] = other[fits]
        ids = np.concatenate([near[nodes].astype(np.int64), extra], 1)
        score = np.einsum("qd,qkd->qk", self.vectors[nodes], self.vectors[np.maximum(ids, 0)])
        score[ids < 0] = -3
        order = np.argsort(-score, axis=1, kind="stable")
        ids = np.take_along_axis(ids, order, 1)
        twin = np.zeros(ids.shape, bool)
        twin[:, 1:] = ids[:, 1:] == ids[:, :-1]
        ids[twin] = -1
        take = np.argsort(ids < 0, axis=1, kind="stable")[:, :width]
        near[nodes] = np.take_along_axis(ids, take, 1)

    def _search(self, q: np.ndarray, start: np.ndarray, lv: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on one level for all queries in step: (nodes, cosines), best first."""
        ids = np.full((len(q), beam), -1, np.int64)
        score = np.full((len(q), beam), -2.0, np.float32)
        open_ = np.zeros((len(q), beam), bool)
        s = start[:, :beam]
        ids[:, :s.shape[1]] = s
        score[:, :s.shape[1]] = np.where(s >= 0, np.einsum("qd,qkd->qk", q, self.vectors[np.maximum(s, 0)]), -2)
        open_[:, :s.shape[1]] = s >= 0
        live = np.arange(len(q))
        while len(live):
            # the best unexpanded nodes of each query, a few at a time
            width = min(4, beam)
            pick = np.argsort(np.where(open_[live], -score[live], 9), axis=1)[:, :width]
            some = np.take_along_axis(open_[live], pick, 1)
            live, pick, some = live[some[:, 0]], pick[some[:, 0]], some[some[:, 0]]
            if not len(live):
                break
            nodes = np.where(some, np.take_along_axis(ids[live], pick, 1), -1)
            o = open_[live]
            np.put_along_axis(o, pick, False, 1)
            open_[live] = o
            new = np.where(nodes[:, :, None] >= 0, self.near[lv][np.maximum(nodes, 0)], -1).reshape(len(live), -1).astype(np.int64)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            known = (new[:, :, None] == ids[live][:, None, :]).any(2)
            new[known] = -1
            sc = np.einsum("qd,qkd->qk", q[live], self.vectors[np.maximum(new, 0)]).astype(np.float32)
            sc[new < 0] = -2
            all_ids = np.concatenate([ids[live], new], 1)
            all_sc = np.concatenate([score[live], sc], 1)
            all_open = np.concatenate([open_[live], new >= 0], 1)
            best = np.argsort(-all_sc, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            score[live] = np.take_along_axis(all_sc, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1)
        return ids, score

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(q), 1), self.entry, np.int64)
        for lv in range(len(self.near) - 1, 0, -1):
            start = self._search(q, start, lv, 4)[0]
        return self._search(q, start, 0, beam)

    def pack(self) -> bytes:
        head = np.array([*self.vectors.shape, len(self.near), self.entry, *(x.shape[1] for x in self.near)], np.int64)
        return b"".join([np.int64(len(head)).tobytes(), head.tobytes(), self.vectors.tobytes(),
                         *(x.tobytes() for x in self.near)])

    @classmethod
    def unpack(cls, raw: bytes) -> "Graph":
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        head = np.frombuffer(raw, np.int64, n, 8)
        rows, dim, levels, entry = (int(x) for x in head[:4])
        at = 8 + 8 * n
        vectors = np.frombuffer(raw, np.float32, rows * dim, at).reshape(rows, dim)
        at += 4 * rows * dim
        near = []
        for w in head[4:]:
            near.append(np.frombuffer(raw, np.int32, rows * int(w), at).reshape(rows, int(w)))
            at += 4 * rows * int(w)
        return cls(vectors, np.zeros(rows, np.int64), near, entry)


def _units(table: pa.Table) -> np.ndarray:
    """Unit vectors, in double precision."""
    column = table.column("vec").combine_chunks()
    flat = column.flatten().to_numpy().astype(np.float64)
    x = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    # a scale first: squares of very small or large numbers would leave the range
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _build(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("rep").to_numpy())
    table = table.take(pa.array(order))
    rep = table.column("rep").to_numpy()
    h = table.column("h").to_numpy().view(np.uint64)
    u = ((h >> np.uint64(11)).astype(np.float64) + 1) / 2.0 ** 53
    level = np.minimum((-np.log(u) / np.log(LINKS)).astype(np.int64), 6)
    graph = Graph.build(_units(table).astype(np.float32), level)
    return pa.table({"label": table.column("label")[:1], "dim": table.column("dim")[:1], "shard": table.column("shard")[:1],
                     "graph": pa.array([graph.pack()], pa.binary()), "reps": pa.array([rep.astype("<i8").tobytes()], pa.binary()),
                     "counts": pa.array([table.column("n").to_numpy().astype("<i8").tobytes()], pa.binary()),
                     "exact": pa.array([_units(table).tobytes()], pa.binary())})


def _local_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge per node of the graph of the pairs, to the smallest node of its component."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = number[:len(a)], number[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _audited_beam(graph: Graph, q: np.ndarray, audit: np.ndarray, a: np.ndarray, b: np.ndarray, percent: float, n: int) -> int | None:
    """The first beam that finds ``RECALL`` of the audit's true links (a, b), or none."""
    beam = min(BEAM, n)
    while True:
        ids, score = graph.search(q[audit], beam)
        full = score[:, -1] >= percent - 1e-3  # answered by the exact product
        open_ = ~np.isin(a, audit[full])
        got = np.isin(a[open_] * n + b[open_], np.where(ids >= 0, audit[:, None] * n + ids, -1))
        if got.sum() >= RECALL * len(got):
            return beam
        if beam >= min(WIDEST, n):
            return None
        beam = min(2 * beam, n)


def _searched(graph: Graph, q: np.ndarray, units: np.ndarray, exact: np.ndarray, beam: int, percent: float):
    """Links (query, node) found by the graph, verified; queries whose beam is full of links go by the exact product."""
    pairs_a, pairs_b = [], []
    for s in range(0, len(q), STEP):
        ids, score = graph.search(q[s:s + STEP], beam)
        full = np.flatnonzero(score[:, -1] >= percent - 1e-3)
        ids[full] = -1
        i, j = np.nonzero((ids >= 0) & (score >= percent - 1e-3))
        a, b = s + i, ids[i, j]
        true = np.einsum("pd,pd->p", units[a], exact[b]) >= percent
        pairs_a.append(a[true])
        pairs_b.append(b[true])
        for f in range(0, len(full), 64):
            rows = s + full[f:f + 64]
            i, j = np.nonzero(units[rows] @ exact.T >= percent)
            pairs_a.append(rows[i])
            pairs_b.append(j)
    return np.concatenate(pairs_a), np.concatenate(pairs_b)


def _query(percent: float):
    schema = pa.schema([("rep", pa.int64()), ("found", pa.int64()), ("root", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        graph = Graph.unpack(right.column("graph")[0].as_py())
        reps = np.frombuffer(right.column("reps")[0].as_py(), "<i8")
        counts = np.frombuffer(right.column("counts")[0].as_py(), "<i8")
        exact = np.frombuffer(right.column("exact")[0].as_py(), np.float64).reshape(len(reps), -1)
        left = left.take(pa.array(np.argsort(left.column("rep").to_numpy())))
        rep, units = left.column("rep").to_numpy(), _units(left)
        q = units.astype(np.float32)

        def linked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """All links of some queries, by the exact product."""
            a, b = [], []
            for s in range(0, len(rows), 64):
                part = rows[s:s + 64]
                i, j = np.nonzero(units[part] @ exact.T >= percent)
                other = rep[part[i]] != reps[j]
                a.append(part[i][other])
                b.append(j[other])
            return np.concatenate(a), np.concatenate(b)

        # the audit's queries, spread over the block and the same on every run, until they have links enough
        order = np.argsort(np.arange(len(q)) * GOLDEN % 1.0, kind="stable")
        n, a, b = AUDIT_ROWS, *linked(order[:AUDIT_ROWS])
        while len(a) < AUDIT_LINKS and n < len(q):
            more = linked(order[n:4 * n])
            a, b, n = np.append(a, more[0]), np.append(b, more[1]), 4 * n
        if n < len(q):
            beam = _audited_beam(graph, q, order[:n], a, b, percent, len(reps))
            a, b = linked(np.arange(len(q))) if beam is None else _searched(graph, q, units, exact, beam, percent)
            other = rep[a] != reps[b]
            a, b = a[other], b[other]
        found = np.bincount(a, counts[b], len(rep)).astype(np.int64)
        nodes, roots = _local_edges(rep[a], reps[b])
        mine = np.searchsorted(nodes, rep)
        known = (mine < len(nodes))
        known[known] = nodes[mine[known]] == rep[known]
        out_rep = [rep, nodes]
        out_found = [found, np.zeros(len(nodes), np.int64)]
        out_root = [rep, roots]
        return pa.table([pa.array(np.concatenate(x)) for x in (out_rep, out_found, out_root)], schema=schema)
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = 0.98, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    spark = vectors.sparkSession
    ship_code(spark)
    x = F.col("vec")
    usable = (F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(x, lambda c: c != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # equal components: both zeros are one
    same = F.transform(x, lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c))
    key = F.when(F.col("usable"), F.sha2(F.to_json(F.struct("label", same.alias("vec"))), 256))
    rows = keep(rows.withColumn("key", key), "vectors")
    reps = rows.where("usable").groupBy("key").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    reps = reps.withColumn("h", F.xxhash64("key")).withColumn("dim", F.size("vec"))
    # ids may repeat or be null: the node is the key's hash where the id does not name one vector
    one = reps.groupBy("rep").agg(F.count("*").alias("keys"))
    reps = reps.join(one, reps.rep.eqNullSafe(one.rep), "left").drop(one.rep).withColumn("low", F.col("rep")).withColumn(
        "rep", F.when(F.col("rep").isNotNull() & (F.col("keys") == 1), F.col("rep")).otherwise(F.col("h"))).drop("keys")
    reps = keep(reps, "reps")
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("rows")).select(
        "label", "dim", F.ceil(F.col("rows") / shard_rows).alias("shards"), F.ceil(F.col("rows") / block_rows).alias("blocks"))
    dealt = reps.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("h", F.lit(1)), "shards"))
    graphs = keep(dealt.select("label", "dim", "shard", "rep", "h", "n", "vec").groupBy("label", "dim", "shard").applyInArrow(
        _build, f"label {dict(reps.dtypes)['label']}, dim int, shard long, graph binary, reps binary, counts binary, exact binary"),
        "graphs")
    queries = dealt.withColumn("block", F.pmod(F.xxhash64("h", F.lit(2)), "blocks")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).select("label", "dim", "shard", "block", "rep", "vec")
    targets = graphs.join(sizes, ["label", "dim"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("shards", "blocks")
    by = ["label", "dim", "shard", "block"]
    answers = keep(queries.groupBy(*by).cogroup(targets.groupBy(*by)).applyInArrow(
        _query(least), "rep long, found long, root long"), "answers")
    links = answers.groupBy("rep").agg(F.sum("found").alias("found"))
    roots = connected_components(answers.where("rep != root"), "rep", "root")
    named = (reps.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("root", F.coalesce("root", "rep")))
    least_id = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(least_id, "root").select("key", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    return rows.join(named, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
