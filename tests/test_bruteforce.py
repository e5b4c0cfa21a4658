"""Generic operators against brute force on random small fixtures."""

import math
import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rosterlens.operators import aggregates as agg
from rosterlens.operators.correlation import corr_matrix
from rosterlens.operators.dedupe import keep_version

SEEDS = [1, 2, 3]


@pytest.mark.parametrize("seed", SEEDS)
def test_keep_version_latest(spark, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.choice("abcdef"), rnd.choice([None, 1, 2, 3])) for i in range(300)]
    got = {r["k"]: r["ord"] for r in keep_version(
        spark.createDataFrame(data, "ord int, k string, d int"), "k", ["d", "ord"]).collect()}
    want = {}
    for k in {k for _, k, _ in data}:
        rows = [(d is None, d if d is not None else 0, o) for o, kk, d in data if kk == k]
        want[k] = max(rows)[2]                       # nulls last in ascending order -> they win
    assert got == want


@pytest.mark.parametrize("seed", SEEDS)
def test_membership_rate(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.randint(1, 40), rnd.choice(["A", "B", "C", "D"])) for _ in range(150)]
    got = {r[0]: tuple(r[1:]) for r in agg.membership_rate(
        spark.createDataFrame(data, "e int, g string"), "e", "g").collect()}
    groups = defaultdict(set)
    for e, g in data:
        groups[e].add(g)
    want = {}
    for g in {g for _, g in data}:
        members = [e for e in groups if g in groups[e]]
        multi = sum(1 for e in members if len(groups[e]) > 1)
        rate = math.floor(100 * multi / len(members) * 100 + 0.5 + 1e-9) / 100
        want[g] = (len(members), multi, rate)
    assert got == want


@pytest.mark.parametrize("seed", SEEDS)
def test_top_per_group(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice("xyz"), rnd.choice(["p", "q", "r", "s"])) for _ in range(120)]
    got = {r[0]: (r[1], r[2]) for r in agg.top_per_group(
        spark.createDataFrame(data, "g string, i string"), "g", "i").collect()}
    want = {}
    for g in {g for g, _ in data}:
        c = Counter(i for gg, i in data if gg == g)
        best = min(c.items(), key=lambda kv: (-kv[1], kv[0]))
        want[g] = best
    assert got == want


@pytest.mark.parametrize("seed", SEEDS)
def test_corr_matrix_matches_pandas_pairwise(spark, seed):
    rnd = random.Random(seed)
    cols = ["a", "b", "c", "k"]
    rows = [tuple(None if rnd.random() < 0.2 else rnd.randint(1, 9) for _ in range(3)) + (5,) for _ in range(80)]
    got = {(x, y): v for x, y, v in corr_matrix(spark.createDataFrame(rows, "a int, b int, c int, k int"),
                                                 cols).collect()}
    pdf = pd.DataFrame(rows, columns=cols, dtype="float64")
    want = pdf.corr()
    for x in cols:
        for y in cols:
            w = want.loc[x, y]
            if "k" in (x, y):                        # constant column: null here, NaN in pandas
                assert got[(x, y)] is None
            else:
                assert got[(x, y)] == pytest.approx(round(w, 2), abs=0.0100001)


def test_argmin_counts_brute_force(spark):
    rnd = random.Random(7)
    cols = ["s1", "s2", "s3"]
    rows = [tuple(None if rnd.random() < 0.15 else rnd.randint(1, 4) for _ in cols) for _ in range(200)]
    got = {r[0]: r[1] for r in agg.argmin_counts(spark.createDataFrame(rows, "s1 int, s2 int, s3 int"),
                                                 cols, "n").collect()}
    want = Counter()
    for r in rows:
        vals = [v for v in r if v is not None]
        if vals:
            for c, v in zip(cols, r):
                if v == min(vals):
                    want[c] += 1
    assert got == dict(want)


@pytest.mark.parametrize("seed", SEEDS)
def test_group_summary_mean_and_exact_median(spark, seed):
    import statistics

    rnd = random.Random(seed)
    data = [(rnd.choice("gh"), rnd.randint(1, 30), None if rnd.random() < 0.1 else rnd.randint(0, 500))
            for _ in range(200)]
    got = {r[0]: tuple(r[1:]) for r in agg.group_summary(
        spark.createDataFrame(data, "g string, e int, v int"), "g", "e", "v").collect()}
    for g in {g for g, _, _ in data}:
        vals = [v for gg, _, v in data if gg == g and v is not None]
        ents = {e for gg, e, v in data if gg == g and v is not None}
        n, mean, median = got[g]
        assert n == len(ents)
        assert mean == pytest.approx(statistics.fmean(vals))
        assert median == statistics.median(vals)


@pytest.mark.parametrize("seed", SEEDS)
def test_popularity_distinct_and_rows(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice("abc"), rnd.randint(1, 15)) for _ in range(100)]
    df = spark.createDataFrame(data, "g string, e int")
    distinct = {r[0]: r[1] for r in agg.popularity(df, "g", "e").collect()}
    rows_ = {r[0]: r[1] for r in agg.popularity(df, "g").collect()}
    for g in {g for g, _ in data}:
        assert distinct[g] == len({e for gg, e in data if gg == g})
        assert rows_[g] == sum(1 for gg, _ in data if gg == g)


def test_page_matches_python_slicing(spark):
    from rosterlens.operators.paging import page

    rnd = random.Random(5)
    data = [(rnd.randint(0, 9), f"k{i:03d}") for i in range(57)]
    df = spark.createDataFrame(data, "c int, k string")
    want = sorted(data, key=lambda t: (-t[0], t[1]))
    for p in range(4):
        got = [tuple(r) for r in page(df, [F.desc("c"), "k"], p, 20).collect()]
        assert got == want[p * 20:(p + 1) * 20]


def test_unpivot_measures_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 5, None), (2, None, 7)], "id int, a int, b int")
    got = sorted(tuple(r) for r in agg.unpivot_measures(df, ["id"], ["a", "b"], "m", "v").collect())
    assert got == [(1, "a", 5), (1, "b", None), (2, "a", None), (2, "b", 7)]
