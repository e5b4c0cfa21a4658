"""Conversation repair, token alignment and ring shards against brute force, on odd rows and the supplied tables."""

import collections
import hashlib
import itertools
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF_SMALL  # noqa: E402
from rosterlens.llm import dialogue_repair, hash_ring, queries, token_alignment  # noqa: E402
from rosterlens.llm.tokens import byte_alphabet  # noqa: E402
from tools.compare_oracle import digest, duck_connect  # noqa: E402

sys.setrecursionlimit(20_000)
TURNS = "conv_id long, turn long, role string, text string"
#: Columns that clash with names the operators use inside.
CLASH = ["1 as live", "'x' as fault", "true as is_head", "2 as position", "'s' as sign", "3 as copy", "4 as n", "'a' as audit"]


def cheapest(signs):
    """(cost, audit) of the cheapest edits of a list of (initial, must go, truncated), by trying all."""
    best = {}

    def go(i, state, inserted):
        if (i, state, inserted) in best:
            return best[i, state, inserted]
        options = [(0, "")] if i == len(signs) and state in "-a" else []
        wanted = "a" if state == "u" else "u"
        if inserted < 3:
            c, a = go(i, wanted, inserted + 1)
            options.append((c + 5, "I" + a))
        if i < len(signs):
            initial, gone, cut = signs[i]
            c, a = go(i + 1, state, 0)
            options.append((c + 2, "D" + a))
            if not gone:
                for role in {wanted, "s"} if state == "-" and initial == "s" else {wanted}:
                    c, a = go(i + 1, role, 0)
                    options.append((c + 5 * cut + (role != initial), ("K" if role == initial else "R") + a))
        best[i, state, inserted] = min(options) if options else (10 ** 9, "Z")
        return best[i, state, inserted]

    return go(0, "-", 0)


def test_op11_every_short_signature():
    letters = "xsuaoSUAO"
    signatures = ["".join(p) for n in range(5) for p in itertools.product(letters, repeat=n)]
    automaton = dialogue_repair.Automaton()
    for reverse in sorted(s[::-1] for s in signatures):
        signs = [(c.lower(), c == "x", c.isupper()) for c in reverse[::-1]]
        assert automaton.best(reverse) == cheapest(signs), reverse
    assert automaton.made == len(signatures) - 1  # each suffix once


def test_op11_long_signatures():
    rnd = random.Random(5)
    tails = ["".join(rnd.choice("suaoxUA") for _ in range(40)) for _ in range(5)]
    signatures = {rnd.choice(tails)[rnd.randint(0, 30):] for _ in range(60)} | {"ua" * 300, "u" * 300, "x" * 300}
    automaton = dialogue_repair.Automaton()
    for reverse in sorted(s[::-1] for s in signatures):
        assert automaton.best(reverse) == cheapest([(c.lower(), c == "x", c.isupper()) for c in reverse[::-1]])


def brute_repair(rows):
    """One conversation's rows (turn, role, text) -> the query's columns."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, signs, faults = set(), [], collections.Counter()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        signs.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
    cost, audit = cheapest(signs)
    out, k = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[k][1:]
        k += edit != "I"
        if edit in "IR":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit != "D":
            out.append((role, text))
    whole = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def brute_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += []
        if kind:
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


ODD_TURNS = [
    (1, 0, "system", "Be good."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes"), (1, 9, "assistant", "Yes."), (1, 9, "assistant", "Yes."),
    (2, None, None, None), (2, None, "user", ""), (2, 3, "tool", "x!\n\t "), (3, None, "assistant", " \x0b"), (None, 1, "user", "a."),
    (None, None, "assistant", "b"), (None, 2, "", "c."), (4, -5, "system", "s."), (5, 0, "assistant", "a."), (5, 1, "user", "\xa0"),
    (6, 0, "user", "long " * 300_000 + "."), (6, 1, "assistant", "."), *((7, i, "ua"[i % 2], f"t{i}.") for i in range(3000)),
    *((8, 5, "user", "same.") for _ in range(700))]


def test_op11_brute_force(spark):
    some = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = ODD_TURNS + [(100 + (c or 0), t, r, x) for c, t, r, x in some]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", *CLASH[1:])
    for turns, groups in ((dialogue_repair.damaged(df), brute_damage(rows)),):
        got = {r[0]: tuple(r)[1:] for r in dialogue_repair.repair_digests(turns).collect()}
        want = {c: brute_repair(g) for c, g in groups.items() if len(g) < 2000}
        assert set(got) == set(groups)
        assert {c: got[c] for c in want} == want
    empty = dialogue_repair.repair_digests(dialogue_repair.damaged(df.limit(0)))
    assert empty.count() == 0
    clean = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Ok."), (2, 0, "user", "Hi.")], TURNS)
    plans = dialogue_repair.repair_plans(clean)
    turns = [tuple(r) for r in dialogue_repair.repaired_turns(clean, plans).where("position is not null").collect()]
    assert sorted(turns) == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ok.")]


def test_op11_matches_sql_at_a_larger_size(spark):
    folder = SF_SMALL.replace("0.001", "0.1")
    df = queries.op11_dialogue_repair(spark, folder)
    rel = duck_connect(folder).sql(queries.ORACLE["op11_dialogue_repair"])
    rows, order = [tuple(r) for r in df.collect()], sorted(df.columns)
    assert digest(rows, df.columns, order)[0] == digest(rel.fetchall(), rel.columns, order)[0] and len(rows) == 1000


ODD_TEXTS = [
    None, "", " ", "  ", "a  b\t c \n\n d ", " lead", "trail   ", "</s> <|endoftext|> <0x41> ▁x", "日本語 日　本 é", "x  y   z　 w",
    " \u0085 a", "\x1c b \x1d", "🙂 🙂🙂  ok", "it's we'll  'r", "a" * 5000, "word " * 30000, "é ﬁ ½ " * 50, "﻿ bom ​ z",
    "same same", "same same", "1234 5678,9", "日本語" * 300, "nul \x00 x"]


def brute_alignment(rows):
    a_library = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_VOCABULARY))
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_VOCABULARY))
    byte_of = {c: i for i, c in enumerate(byte_alphabet())}

    def a_bytes(i):
        return bytes(byte_of[c] for c in a_library.id_to_token(i))

    def b_bytes(i):
        piece = b_library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode()

    found, count = [], collections.Counter()
    for doc, text in rows:
        a = a_library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_library.encode(text) if text else []
        whole = f" {text}".encode()
        a_ends = np.cumsum([len(a_bytes(i)) for i in a]).tolist()
        b_ends = np.cumsum([len(b_bytes(i)) for i in b]).tolist()
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            found.append((doc, [], [], [], []))
            continue
        groups, last = [], 0
        for end in sorted(set(a_ends) & set(b_ends)):
            groups.append(([i for i, e in zip(a, a_ends) if last < e <= end], [i for i, e in zip(b, b_ends) if last < e <= end])
                          if len(a) < 3000 else None)
            last = end
        if len(a) >= 3000:
            groups, i, j = [], 0, 0
            for end in sorted(set(a_ends) & set(b_ends)):
                x = i + sum(e <= end for e in a_ends[i:i + 200])
                y = j + sum(e <= end for e in b_ends[j:j + 200])
                groups.append((a[i:x], b[j:y]))
                i, j = x, y
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        count.update(set(links))
        found.append((doc, a, b, groups, links))
    top = collections.Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    for doc, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (doc, len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
               hashlib.sha256(text.encode()).hexdigest() if a else "")


@pytest.mark.parametrize("sizes", [{}, {"stretch_bytes": 200, "block_pairs": 500}])
def test_op12_brute_force(spark, sizes):
    rnd = random.Random(3)
    texts = ODD_TEXTS + ["".join(rnd.choice(" \n\t　 abcé日.'1🙂\u0085\x1c") for _ in range(rnd.randint(1, 80))) for _ in range(100)]
    some = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows = [(1000 + i, t) for i, t in enumerate(texts)] + some + some[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr(
        "*", "1 as block", "2 as at", "'x' as pair", "3 as n", "true as is_pair", "4 as counts")
    paths = public_tokenizers.path(queries.BYTE_VOCABULARY), public_tokenizers.path(queries.PIECE_VOCABULARY)
    got = sorted(tuple(r) for r in token_alignment.alignment_digests(df, *paths, **sizes).collect())
    assert got == sorted(brute_alignment(rows))
    assert token_alignment.alignment_digests(df.limit(0), *paths).count() == 0
    null_id = spark.createDataFrame([(None, "no id"), (1, "no id")], "doc_id long, text string")
    assert len({tuple(r)[1:] for r in token_alignment.alignment_digests(null_id, *paths).collect()}) == 1


def test_op12_wide_groups():
    rnd = np.random.default_rng(1)
    ga, gb = np.sort(rnd.integers(0, 3, 900)), np.sort(rnd.integers(0, 3, 700))
    a, b = rnd.integers(0, 9, 900), rnd.integers(0, 9, 700)
    got = token_alignment._pairs(np.array([0, 0, 1]), ga, a, gb, b, 3)
    want = collections.Counter((int(g == 2), (int(x) << 32) | int(y)) for g, x in zip(ga, a) for h, y in zip(gb, b) if g == h)
    assert {(d, p): n for d, p, n in zip(*(c.to_pylist() for c in got.columns))} == want


def brute_ring(keys, ring, limits):
    loads, out = [0] * len(limits), collections.Counter()
    for r in sorted(keys, key=lambda r: (r["by_text"], r["by_id"], r["by_row"])):
        s = next(int(x) for x in ring.orders[r["stretch"]] if loads[x] < limits[x])
        loads[s] += r["weight"]
        out[r["doc_id"], r["size"], r["text_crc32"], s] += 1
    return out


def test_op13_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet").selectExpr(
        "doc_id", "case when doc_id % 3 = 0 then 'hot' else text end as text", "1 as size", "2 as shard", "3 as stretch", "4 as weight")
    odd = spark.createDataFrame([(None, None), (None, ""), (1, "é"), (1, "é"), (1, None)], "doc_id long, text string").selectExpr(
        "*", "1 as size", "2 as shard", "3 as stretch", "4 as weight")
    same = spark.range(700).selectExpr("cast(1 as long) as doc_id", "'x' as text", "1 as size", "2 as shard", "3 as stretch", "4 as weight")
    caught, made = [], hash_ring._Filling.__init__
    monkeypatch.setattr(hash_ring, "FEW", 40)
    monkeypatch.setattr(hash_ring._Filling, "__init__", lambda self, *a: (caught.append(a), made(self, *a))[1])
    for df in (docs.union(odd), same):
        for more in ({}, {"bound": "bytes", "slack": 0.01}, {"shards": 3, "virtual": 5}):
            out = hash_ring.ring_shards(df, **more).collect()
            keys, ring, limits = caught[-1]
            assert collections.Counter(tuple(r)[:4] for r in out) == brute_ring(keys.collect(), ring, limits)
            slots = collections.defaultdict(list)
            for r in out:
                slots[r["shard"]].append(r["slot"])
            assert all(sorted(v) == list(range(len(v))) for v in slots.values())
            if "bound" not in more:
                assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert hash_ring.ring_shards(docs.limit(0)).count() == 0
    assert {r["size"] for r in hash_ring.ring_shards(odd).collect()} == {1, 3}


def test_op13_balance_and_movement(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/documents.parquet")
    rows = queries.op13_hash_ring(spark, SF_SMALL.replace("0.001", "0.1")).collect()
    n = collections.Counter(r["shard"] for r in rows)
    assert max(n.values()) - min(n.values()) <= 1 and set(n) == set(range(8)) and {r["law"] for r in rows} == {"rows"}
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows)
    of_text = collections.defaultdict(set)
    for r in rows:
        of_text[text[r["doc_id"]]].add(r["shard"])
    assert sum(len(v) > 1 for v in of_text.values()) <= 8  # a text is split where a shard fills within it
    old = {r["doc_id"]: r["shard"] for r in rows}
    new = {r["doc_id"]: r["shard"] for r in hash_ring.ring_shards(docs, shards=9).collect()}
    assert sum(old[d] != new[d] for d in old) < 2 * len(old) / 9
