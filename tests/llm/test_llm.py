"""The training-data operators against SQL, brute force and exact round trips, on odd rows and on the supplied tables."""

import collections
import gzip
import hashlib
import os
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF_SMALL  # noqa: E402
from rosterlens.llm import chat, mixing, ngram_join, packing, prefix_counts, quality_votes, queries, repeat_index  # noqa: E402
from rosterlens.llm import toxic_segments, vector_graph, warc  # noqa: E402
from tools.compare_oracle import digest, duck_connect  # noqa: E402

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(120))
DOCS = [
    (1, BASE, "a"), (2, BASE + " tail", "a"), (3, BASE.upper(), "b"), (4, None, None), (5, "", "b"), (6, " \n\t", "a"),
    (7, "one two", "a"), (8, "one two", None), (9, "#$% x", "c"), (9, "#$% x", "c"), (None, "no id " * 60, "c"),
    (10, "é ñ 日本 <|endoftext|> 'll " * 200, "a"), (11, "x" * 70_000, "b"), (12, "ab\n\ncd\nab\n" * 40, "b"),
    (13, " ".join(f"v{i}" for i in range(9000)), "a"),
]


def documents(spark, rows=DOCS):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # columns that clash with names the operators use inside
    return df.selectExpr("*", "1 as n", "'x' as rid", "2 as size", "3 as length", "'en' as lang", "length(text) as n_chars")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


@pytest.mark.parametrize("name", [n for n in queries.ORACLE])
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    rel = duck_connect(SF_SMALL).sql(queries.ORACLE[name])
    s, d, order = [tuple(r) for r in df.collect()], rel.fetchall(), sorted(df.columns)
    assert order == sorted(rel.columns) and len(s) == len(d)
    assert digest(s, df.columns, order)[0] == digest(d, rel.columns, order)[0]


def test_op1_odd_rows(spark, docs, empty):
    got = sorted(((r[0] if r[0] is not None else 99), r[1], r[2]) for r in ngram_join.shingle_components(docs).collect())
    component = {(i, n): c for i, n, c in got}
    assert component[1, 116] == component[2, 117] == component[3, 116] == 1
    assert component[4, 0] == 4 and component[5, 0] == 5 and component[6, 0] == 6
    assert component[7, 1] == component[8, 1] == 7 and len(got) == len(DOCS)
    kept = [r["doc_id"] for r in ngram_join.one_of_each(docs).collect()]
    assert sorted(x for x in kept if x is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13]
    assert ngram_join.shingle_components(empty).count() == 0


def brute_one_of_each(rows):
    """(id, text) of the rows that stay; of a component's rows with the smallest id, any text."""
    sets = []
    for _, text in rows:
        w = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    stay = [r for r, s in zip(rows, sets) if not s]
    groups = collections.defaultdict(list)
    for r, s, k in zip(rows, sets, root):
        if s:
            groups[k].append(r)
    low = [min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()]
    return stay, [{r for r in g if r[0] == i} for g, i in zip(groups.values(), low)]


def test_op1_one_of_each_brute_force(spark):
    other = " ".join(f"z{i}" for i in range(90))
    rows = [(1, BASE), (1, other), (2, BASE + " tail"), (2, "two alone"), (3, other + " end"), (4, ""), (4, "four alone"), (4, None),
            (5, ""), (5, ""), (5, BASE.upper()), (6, "six six"), (6, "six six"), (None, "null copies"), (None, "null copies"),
            (None, BASE), (None, "null alone"), (None, None), (None, ""), (7, "null alone too"), (8, "null alone too"), (8, BASE + " x")]
    small = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    for rows in (rows, [(i // 2, t) for i, t in small[:400]]):
        got = [(r["doc_id"], r["text"]) for r in ngram_join.one_of_each(documents(spark, [(*r, "a") for r in rows])).collect()]
        stay, groups = brute_one_of_each(rows)
        left = collections.Counter(got) - collections.Counter(stay)
        assert len(got) == len(stay) + len(groups)
        assert all(sum(left[r] for r in g) == 1 for g in groups)


def brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k:k + length] for b in raws for k in range(len(b) - length + 1))
    for b in raws:
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                cover[k] += 1
                cover[k + length] -= 1
        yield b, np.cumsum(cover)[:len(b)] > 0


def test_op2_brute_force(spark, docs, empty):
    want = []
    for (doc, text, _), (b, gone) in zip(DOCS, brute_repeats([t for _, t, _ in DOCS], 200)):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        want.append((str(doc), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [(str(r[0]), *r[1:]) for r in repeat_index.repeat_digests(docs).collect()]
    assert sorted(got) == sorted(want)
    assert repeat_index.repeat_digests(empty).count() == 0
    assert repeat_index.cut_repeats(docs).columns == docs.columns


def test_op2_matching_statistics():
    contents = [b"abracadabra", b"cadabrac", b"zzzzzz", b"abra"]
    places = [(c, i) for c in contents for i in range(len(c))]

    def common(x, y):
        return len(os.path.commonprefix([x[0][x[1]:], y[0][y[1]:]]))

    want = [max(common(x, y) for k, y in enumerate(places) if k != i) for i, x in enumerate(places)]
    assert repeat_index.matching_statistics(contents).tolist() == want


def test_op3_round_trip(spark):
    texts = ["plain", None, "</s>[INST] ok [/INST]", "\\b \\e <s>", "<<SYS>>\nx\n<</SYS>>", "a\nb", "", "[/INST]</s><s>user\nhi"]
    rows = [(1, i, ("system", "user", "assistant")[i % 3], t) for i, t in enumerate(texts)]
    rows += [(2, None, None, "x"), (2, 0, "assi\nstant</s>", "y"), (2, 0, "assistant", "z</s>"), (None, 1, "assistant", "n")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    assert all(r["round_trip"] for r in out.values())
    assert [(t["role"], t["text"]) for t in out[1]["turns"]] == [(r, t or "") for _, _, r, t in rows[:8]]
    for r in out.values():
        loss = [t["text"] for t in r["turns"] if t["role"] == "assistant"]
        cut = [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]]
        marks = [("\\" + letter, s) for s, letter in [*chat.CONTROL, *chat.FULL, chat.LINE, chat.BACKSLASH]]
        for a, b in marks:
            cut = [c.replace(a, b) for c in cut]
        assert cut == loss
    assert chat.chat_digests(turns.limit(0)).count() == 0


def test_op3_falls_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "_round_trip", lambda role, text, level: chat.F.lit(True))  # a turn's own check that misses all
    rows = [(1, 0, "system", "</s> x"), (1, 1, "assistant", "a</s>[b"), (1, 2, "user", "<s>"), (1, 3, "assistant", "</s>"), (2, 0, "user", "ok")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    assert all(r["round_trip"] for r in out.values())
    assert [(t["role"], t["text"]) for t in out[1]["turns"]] == [(r, t) for _, _, r, t in rows[:4]]
    cut = [out[1]["formatted"][s["start"]:s["start"] + s["length"]] for s in out[1]["loss_spans"]]
    assert [c.replace("\\l", "<").replace("\\k", "[") for c in cut] == ["a</s>[b", "</s>"]
    assert out[2]["formatted"] == "<s>user\n[INST] ok [/INST]</s>" and chat.chat_digests(turns).count() == 2


def test_op4_links(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    near = np.concatenate([base, base + rng.normal(scale=0.03, size=base.shape), base[:5]])
    rows = [(i, x.tolist(), i % 2 if i % 7 else 0) for i, x in enumerate(near)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, near[0].tolist(), None), (904, [], 0),
             (905, [None] + [1.0] * 15, 1), (906, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    usable = [(i, np.array(x) / np.linalg.norm(x), c) for i, x, c in rows[:len(near)]]
    links = {i: {j for j, y, d in usable if j != i and c == d and x @ y >= 0.98} for i, x, c in usable}
    for got in (vector_graph.near_duplicates(df), vector_graph.near_duplicates(df, shard_rows=10, block_rows=8)):
        out = {r["vec_id"]: r for r in got.collect()}
        assert len(out) == len(rows)
        for i, r in out.items():
            reach, todo = {i}, [i]
            while todo:
                todo = [j for k in todo for j in links.get(k, ()) if j not in reach and not reach.add(j)]
            assert (r["n_links"], r["component_id"], r["kept"]) == (len(links.get(i, ())), min(reach), min(reach) == i)
    assert vector_graph.near_duplicates(df.limit(0)).count() == 0


def test_op5_pieces_and_sequences(spark, docs, empty):
    path = public_tokenizers.path(queries.WORD_VOCABULARY)
    library = Tokenizer.from_file(path)
    want = collections.Counter()
    for doc, text, _ in DOCS:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want[doc, k // 4096, k, len(part), packing.zlib.crc32(part.tobytes())] += 1
    rows = packing.pack_documents(docs, path).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= -(-sum(r["length"] for r in rows) // 4096) + 2
    assert packing.pack_documents(empty, path).count() == 0


def test_op6_every_prefix(spark, docs, empty):
    path = public_tokenizers.path(queries.BYTE_VOCABULARY)
    library = Tokenizer.from_file(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    want = sorted((str(d), len((t or "").encode()), count(t or ""), count(t or "") > 512) for d, t, _ in DOCS)
    assert sorted((str(r[0]), *r[1:4]) for r in prefix_counts.prefix_token_counts(docs, path).collect()) == want
    texts = ["  a  b\t\tc \n\n", "it's we'll 'r", "a\xa0  b\x1cc", "日本 <|endoftext|> x", BASE[:80], "1234 é!!"]
    small = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    for r in prefix_counts.prefix_token_counts(small, path, limit=5, full=True).collect():
        text = texts[r["doc_id"]]
        for k in range(len(text) + 1):
            assert prefix_counts.stored_tokens(r["prefix_counts"], len(text[:k].encode())) == count(text[:k])
    assert prefix_counts.prefix_token_counts(empty, path).count() == 0


def test_op7_salvage(spark):
    pages = [(1, "u v", "same"), (2, None, "same"), (3, "x", None), (4, "y", ""), (None, "z", "same"), (5, "w", "é\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: tuple(r)[3:] for r in warc.archived_pages(df).collect()}
    assert got == {1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), None: ("revisit", 2),
                   5: ("response", None)}
    plan = warc.with_revisits(df)
    rows = [r[0].encode() + b"\r\n\r\n" for r in plan.select(warc.record(plan)).collect()]
    broken = bytearray(rows[1])
    broken[-6] ^= 1
    data = rows[0] + bytes(broken) + b"noise" + gzip.compress(rows[2]) + gzip.compress(rows[3])[:-9] + gzip.compress(rows[4]) + rows[5]
    found = list(warc.salvage(data))
    assert found[0][1] == 0 and found[-1][2] == len(data)
    assert all(a[2] == b[1] for a, b in zip(found, found[1:]))
    assert sum(k == "record" for k, *_ in found) >= 4 and sum(k == "gap" for k, *_ in found) >= 1
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_op8_targets(spark, docs, empty):
    for rows in (docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        source = collections.Counter()
        for text, s in ((r["text"], r["source"]) for r in rows.select("text", "source").collect()):
            source[s] += len(WORDS.findall(text or ""))
        names = sorted(source, key=lambda s: (s is None, s or ""))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        full: set = set()
        while True:
            left = sum(source.values()) - sum(3 * source[s] for s in full)
            level = left / max(1, sum(weight[s] for s in names if s not in full))
            over = {s for s in names if s not in full and level * weight[s] > 3 * source[s]}
            if not over:
                break
            full |= over
        target = {s: 3 * source[s] if s in full else level * weight[s] for s in names}
        out = mixing.mix(rows).collect()
        assert len(out) == rows.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
        by_target = {round(t, 4) for t in target.values()}
        assert {round(r["target"], 4) for r in out} <= by_target
        assert abs(sum(r["taken"] for r in out) - sum(source.values())) <= 100 * len(names)
        assert sorted(map(str, out)) == sorted(map(str, mixing.mix(rows).collect()))
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


@pytest.mark.parametrize("slots", [mixing.SLOTS, 100])
def test_op8_tiny_sources(spark, monkeypatch, slots):
    monkeypatch.setattr(mixing, "SLOTS", slots)  # 100: blocks as long as in a large corpus
    sizes = {"a": [5, 7, 1], "b": [2000] * 100, "c": [400], "d": [1], "e": [1300, 13], "f": [37] * 4}
    rows = [(100 * k + i, f"w{i} " * n, s) for k, (s, ns) in enumerate(sizes.items()) for i, n in enumerate(ns)]
    df = documents(spark, rows)
    source = {i: s for i, _, s in rows}
    taken, target = collections.Counter(), {}
    for r in mixing.mix(df).collect():
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert set(target) == set(sizes) and target["b"] > sum(v for s, v in target.items() if s != "b")
    for s, want in target.items():
        assert abs(taken[s] - want) <= max(1, 0.02 * want), (s, taken[s], want)
    copies = collections.Counter(r["source"] for r in mixing.mixed_documents(df).collect())
    assert {s: copies[s] for s in "acdef"} == {s: 3 * len(sizes[s]) for s in "acdef"}


def test_op9_counts_and_verdict(spark, docs, empty):
    def brute(text):
        text = text or ""
        words = WORDS.findall(text)
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        grams = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        repeat = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))

    out = quality_votes.quality(docs).collect()
    assert sorted((str(r[0]), *r[1:6]) for r in out) == sorted((str(d), *brute(t)) for d, t, _ in DOCS)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in out)
    assert quality_votes.quality(empty).count() == 0
    rows = quality_votes.quality(spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/documents.parquet"))
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/labels.parquet")
    n = {(r[0], r[1]): r[2] for r in rows.where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert n[1, True] > 0.98 * (n[1, True] + n.get((1, False), 0)) and n[0, False] > 0.95 * (n[0, False] + n.get((0, True), 0))


def test_op10_held_out_accuracy(spark, docs, empty):
    folder = SF_SMALL.replace("0.001", "0.1")
    rows = toxic_segments.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    seen = rows.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("toxic", "predicted").count()
    n = {(r[0], r[1]): r[2] for r in seen.collect()}
    assert n[1, 1] > 0.85 * (n[1, 1] + n[1, 0]) and n.get((0, 1), 0) < 0.01 * n[0, 0]
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (77, 1), (None, 1)], "doc_id long, toxic int")
    assert toxic_segments.toxicity(docs, labels).count() == len(DOCS)
    assert toxic_segments.toxicity(docs, labels.limit(0)).where("score > 0").count() == 0
    assert toxic_segments.toxicity(empty, labels).count() == 0
    assert toxic_segments.maximal_segments([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]) == [(0, 1, 4), (2, 3, 3), (4, 11, 7)]


def test_op10_every_occurrence():
    words = [f"vile{c}word" for c in "abcdefgh"]
    passage = " ".join(words)

    def buffers(text):
        raw = text.encode()
        return np.frombuffer(raw, np.uint8), np.array([0, len(raw)])

    keys = np.sort(toxic_segments._levels(toxic_segments.Words(*buffers(passage), toxic_segments.NOT_ALNUM))[0])
    scorer = toxic_segments.Scorer(keys, np.full(len(keys), 2.0), 1.0, 0.01)
    calm = " ".join(["calm"] * 1000)
    twice = f"{calm} {passage} {calm} {passage} {calm}"
    late = " ".join(f"{calm} {w}" for w in words) + f" {calm} {passage}"
    for text, want in ((twice, 2), (late, 1)):
        surplus, (spans,) = scorer.documents(*buffers(text))
        assert [text[a:b] for a, b, _ in spans] == [passage] * want
        assert abs(surplus[0] - sum(x for *_, x in spans)) < 1e-9 and surplus[0] > 5


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    at = documents(spark, [(i, f"{BASE} {i} " + " ".join(f"d{i}_{k}" for k in range(150)), "ab"[i % 2]) for i in range(40)]
                   + [(50, BASE, "a"), (51, BASE, "a")])
    for name, stage in corpus_pipeline.STAGES:
        before, at = at, stage(spark, at, SF_SMALL)
        if name != "packing":
            assert at.columns == before.columns
    assert at.count() > 0 and len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
