"""Input columns with names that the operators use inside, equal rows in a mix, audits and tables at their bounds."""

import collections

import numpy as np
from pyspark.sql import functions as F

from rosterlens.llm import mixing, ngram_join, repeat_index, toxic_segments, vector_graph

NAMES = ["_rid", "_spans", "_bucket", "_had", "_id", "_hash", "_each", "_pass", "_copies", "_label", "row", "rid", "spans", "at",
         "passes", "times", "copies", "id", "hash", "all", "rank", "label", "doc", "turn", "size", "a.b"]
LONG = " ".join(f"w{i}" for i in range(120))


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *(F.concat(F.lit(n + "/"), F.coalesce(F.col("text"), F.lit("-"))).alias(n) for n in NAMES))


def test_columns_come_back_as_they_were(spark):
    rows = [(1, "alone " + "x y z " * 20, "a"), (2, LONG, "a"), (3, LONG + " tail", "b"), (4, None, "b"), (5, "", None), (6, "six six", "a")]
    docs = clashing(spark, rows)
    text = {i: t for i, t, _ in rows}
    for out in (ngram_join.one_of_each(docs), repeat_index.cut_repeats(docs), mixing.mixed_documents(docs)):
        assert out.columns == docs.columns
        got = out.collect()
        shown = {i: "-" if t is None else t for i, t in text.items()}
        assert got and all(r[n] == n + "/" + shown[r["doc_id"]] for r in got for n in NAMES)
    labels = docs.select("*", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    assert toxic_segments.toxicity(docs, labels).count() == len(rows)
    assert toxic_segments.without_toxic(docs, labels).columns == docs.columns


def test_the_pipeline_stage_keeps_clashing_columns(spark):
    import corpus_pipeline

    docs = clashing(spark, [(1, LONG, "a"), (2, "b " + LONG, "a"), (3, None, "a"), (4, "c d", "a")]).withColumn("n_chars", F.length("text"))
    out = corpus_pipeline.repeats(spark, docs, "")
    assert out.columns == docs.columns
    # nothing is left of the first, which the second holds whole
    assert {r["doc_id"]: r["_had"].split("/")[0] for r in out.collect()} == {i: "_had" for i in (2, 3, 4)}


def test_op8_equal_rows_take_their_passes_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)  # several buckets for one rid
    rows = [(7, "e " * 50, "a")] * 7 + [(100 + i, f"f{i} " * 40, "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = sum(r["taken"] for r in mixing.mix(docs).where("doc_id = 7").collect())
    copies = collections.Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert abs(50 * copies[7] - taken) <= 25 * 7 and copies[7] <= 3 * 7
    numbered = docs.withColumn("at", F.monotonically_increasing_id())  # the rows differ in another column
    each = collections.Counter(r["at"] for r in mixing.mixed_documents(numbered).where("doc_id = 7").collect())
    assert sum(each.values()) == copies[7]
    assert max(each.values()) - min([*each.values(), *([0] if len(each) < 7 else [])]) <= 1


def test_op4_links_are_whole_where_they_are_rare_and_where_beams_fail(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8))
    x[7] = x[311] + 1e-3
    x[20:60] = x[20] + 1e-4 * rng.normal(size=(40, 8))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist(), "l") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")

    def links(rows):
        return {r["vec_id"]: r["n_links"] for r in vector_graph.near_duplicates(rows).collect()}
    assert links(df) == dict(enumerate(want.tolist()))
    rare = df.where("vec_id < 20 or vec_id >= 60")
    near = (unit @ unit.T >= 0.98)
    some = [i for i in range(400) if not 20 <= i < 60]
    assert links(rare) == {i: int(near[i, some].sum()) - 1 for i in some}


def test_op4_an_audit_that_no_beam_passes_ends_without_one():
    class Blind:
        def search(self, q, beam):
            return np.full((len(q), beam), -1), np.full((len(q), beam), -2.0)

    q = np.zeros((60, 2), np.float32)
    assert vector_graph._audited_beam(Blind(), q, np.arange(50), np.arange(40), np.arange(40), 0.98, 5000) is None


def test_op10_table_keeps_the_largest_odds(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("bad worse common", 1)] * 20 + [("bad common", 1)] * 20 + [("fine common", 0)] * 60, "text string, label long")
    keys, odds = toxic_segments._fit_table(rows, 40, 60)
    monkeypatch.setattr(toxic_segments, "TABLE_ROWS", 1)
    few, best = toxic_segments._fit_table(rows, 40, 60)
    assert len(few) == 1 and best[0] == odds.max() and few[0] in keys and len(keys) > 1
