"""What the operators of the pipeline leave on disk and exchange: shuffles freed, texts exchanged once."""

import time

import pyarrow as pa
import pytest

from rosterlens.llm import mixing, ngram_join, repeat_index
from rosterlens.llm.work import CLEANUP, discard, keep
from test_index_lists import brute_components, variants


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if "/shuffle_" in n}


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_keep_frees_its_shuffle_and_leaves_the_setting(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    kept = keep(spark.range(1000).selectExpr("id % 7 k").groupBy("k").count(), "freed")
    end = time.time() + 10
    while time.time() < end and shuffle_files(spark) - before:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before  # before any other job, whose shuffle files would stay
    assert kept.count() == 7 and spark.conf.get(CLEANUP, None) == setting
    path = spark._jvm.org.apache.hadoop.fs.Path(kept.kept_path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(path)
    discard(kept)
    assert not files.exists(path)


def test_rounds_deal_every_shingle_once_with_whole_sizes():
    texts = [f"a{i} b{i % 3} c d e{i % 5} f g h{i} i j k{i}" for i in range(40)] + ["", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])

    def dealt(*rounds):
        out = {}
        for b in ngram_join._deal(5, 4, *rounds)([batch]):
            for bucket, sids, ns, counts, hashes in zip(*(c.to_pylist() for c in b.columns)):
                assert bucket not in out
                out[bucket] = (sids, ns, counts, hashes)
        return out

    whole = dealt()
    parts = [dealt(4, number) for number in range(4)]
    assert [{k % 4 for k in p} for p in parts] == [{0}, {1}, {2}, {3}]
    assert {k: v for p in parts for k, v in p.items()} == whole


def test_components_of_many_rounds_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_TOKENS", 100)
    kept = []
    monkeypatch.setattr(ngram_join, "keep", lambda df, name: kept.append(name) or keep(df, name))
    rows = variants(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.shingle_components(docs).collect()}
    assert got == brute_components(rows, 75)
    assert kept.count("shared") == ngram_join.ROUNDS


def test_one_of_each_compares_rows_only_where_some_are_equal(spark, no_broadcast):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words, 10), (2, words + " x", 20), (3, "other text of few words here", 30), (None, "", 40), (None, "", 50)]
    schema = "doc_id long, text string, n int"
    found, plan = plan_of(ngram_join.one_of_each(spark.createDataFrame(rows, schema)))
    assert sorted(r["n"] for r in found) == [10, 30, 40, 50]
    assert "Window" not in plan
    twice = spark.createDataFrame(rows + [(1, words, 11), (None, words + " x", 60)], schema)
    found = ngram_join.one_of_each(twice).collect()
    n = sorted(r["n"] for r in found)
    assert n in ([10, 30, 40, 50], [11, 30, 40, 50])


def test_repeats_exchange_the_rows_once(spark, no_broadcast):
    passage = "".join(chr(97 + i * i % 23) for i in range(260))
    rows = [(i, f"{i} begins {passage} ends {i}" if i < 3 else f"row {i}", i) for i in range(8)] + [(9, None, 9)]
    found, plan = plan_of(repeat_index.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string, n int")))
    text = {r["n"]: r["text"] for r in found}
    assert len(found) == 9 and text[9] is None and text[5] == "row 5"
    assert all(len(text[i]) < 40 for i in range(3))
    assert "ReusedExchange" in plan


def test_mix_numbers_rows_only_where_passes_are_uneven(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(mixing, "keep", lambda df, name: kept.append(name) or keep(df, name))
    rows = [(i, f"a b c {i} " * (5 + i), "xyz"[i % 3]) for i in range(30)]
    schema = "doc_id long, text string, source string"
    out = mixing.mixed_documents(spark.createDataFrame(rows, schema)).collect()
    assert out and "odd" not in kept
    tripled = [r for r in rows for _ in range(3)]
    passes = {}
    for r in mixing.mixed_documents(spark.createDataFrame(tripled, schema)).collect():
        passes[r["doc_id"]] = passes.get(r["doc_id"], 0) + 1
    assert set(passes) <= {r[0] for r in rows} and ("odd" in kept) == any(n % 3 for n in passes.values())
