"""Index lists of the n-gram join: blocks, parts of long lists and derived answers, by brute force."""

import random

import pyarrow as pa
import pytest

from rosterlens.llm import ngram_join


def variants(seed):
    """Texts around a few bases with changes of all sizes, so that similarities lie on both sides of the bound."""
    rnd = random.Random(seed)
    rows = []
    for base in range(4):
        words = [f"b{base}w{i}" for i in range(60)]
        for k in range(45):
            w = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(6)}"
            lo, hi = rnd.choice([(0, 60), (0, 60), (0, 52), (5, 60), (0, 70)])
            rows.append((len(rows), " ".join((w + [f"y{rnd.randrange(4)}" for _ in range(10)])[lo:hi])))
    return rows


def shingles(text, size=5):
    w = text.split(" ")
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def brute_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    return {i: rows[min(k for k, r in enumerate(root) if r == root[n])][0] for n, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("list_rows,percent", [(4096, 75), (5, 75), (5, 90), (5, 100)])
def test_components_by_brute_force(spark, monkeypatch, list_rows, percent):
    monkeypatch.setattr(ngram_join, "LIST_ROWS", list_rows)
    rows = variants(list_rows + percent)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.shingle_components(docs, percent=percent).collect()}
    want = brute_components(rows, percent)
    assert got == want and 4 < len(set(want.values())) <= len(rows)


def list_entries(rnd, rows):
    """One index list of sets without roots of their own: (h, n, pos, sid, v, many, label, root, o, rv)."""
    out = []
    for sid in range(rows):
        n = rnd.randrange(20, 80)
        v = rnd.randrange(n // 2, n + 1)
        pos = n - v + rnd.randrange(0, max(1, v // 2))
        out.append((7, n, pos, sid, v, rows, sid // 3, sid, v, v))
    return out


@pytest.mark.parametrize("list_rows", [4096, 20, 7])
def test_long_lists_lose_no_pair(spark, monkeypatch, list_rows):
    """Pairs of a parted list are those that no bound settles, each part's blocks aside."""
    monkeypatch.setattr(ngram_join, "LIST_ROWS", list_rows)
    entries = list_entries(random.Random(list_rows), 90)
    want = set()
    for x in entries:
        for y in entries:
            if x[3] < y[3] and x[6] != y[6]:
                small, large = sorted((x[1], y[1]))
                need = -(-75 * (x[1] + y[1]) // 175)
                if 100 * small >= 75 * large and min(x[4], y[4], x[1] - x[2], y[1] - y[2]) >= need:
                    want.add((x[3], y[3]))
    names = "h long, n long, pos long, sid long, v long, many long, label long, root long, o long, rv long"
    rows = spark.createDataFrame(entries, names).withColumn("part", ngram_join.F.explode(ngram_join._parted(75)))
    rows = rows.select("*", "part.*").drop("part", "many").repartition(4, "h", "g", "s", "t")
    rows = rows.sortWithinPartitions("h", "g", "s", "t", "n", "pos", "role")
    got = rows.mapInArrow(ngram_join._walk(75), "a long, b long, sure boolean, kin boolean").collect()
    assert sorted((r["a"], r["b"]) for r in got) == sorted(want) and want
    assert not any(r["sure"] or r["kin"] for r in got)
    assert rows.count() > 90 or list_rows == 4096


def test_blocks_are_skipped_whole(monkeypatch):
    """Blocks of one label, or out of reach by size or position, are never opened."""
    n = 400
    cols = {"h": [1] * n, "g": [0] * n, "s": [0] * n, "t": [0] * n, "n": [50] * 200 + [90] * 200, "pos": [0] * n, "role": [0] * n,
            "sid": list(range(n)), "v": [50] * 200 + [90] * 200, "label": [1] * 200 + [2] * 200, "root": list(range(n)),
            "o": [0] * n, "rv": [0] * n}
    opened = []
    repeat = ngram_join.np.repeat
    monkeypatch.setattr(ngram_join.np, "repeat", lambda *a, **k: opened.append(a) or repeat(*a, **k))
    assert list(ngram_join._walk(75)([pa.RecordBatch.from_pydict(cols)])) == [] and not opened
    cols["label"][0] = 3
    out = list(ngram_join._walk(75)([pa.RecordBatch.from_pydict(cols)]))
    assert sum(b.num_rows for b in out) == 199 and opened


def test_derived_overlaps(spark):
    rnd = random.Random(3)
    root = set(range(100, 180))
    sets = []
    for sid in range(1, 13):
        mine = (root - set(rnd.sample(sorted(root), 6))) | set(rnd.sample(range(300), 5))
        sets.append((sid, mine))
    stars = [(0, sid, len(root), len(x), len(x & root), len(root), sorted(root - x) if sid % 4 else None, sorted(x - root) if sid % 4 else None)
             for sid, x in sets]
    stars = spark.createDataFrame(stars, "a long, b long, na long, nb long, o long, rv long, minus array<long>, plus array<long>")
    pairs = [(i, j, True) for i in range(1, 13) for j in range(i + 1, 13)]
    got = ngram_join._derived(spark.createDataFrame(pairs, "a long, b long, kin boolean"), stars).collect()
    by = dict(sets)
    assert len(got) == len(pairs)
    for r in got:
        if r["a"] % 4 and r["b"] % 4:
            assert (r["o"], r["na"], r["nb"]) == (len(by[r["a"]] & by[r["b"]]), len(by[r["a"]]), len(by[r["b"]]))
        else:
            assert r["o"] is None
