"""Archives of many members, large pages and damage; the loss mask itself."""

import gzip
import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterlens.llm import chat, warc  # noqa: E402


def test_op7_many_members_are_read_in_linear_time(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " + "x" * 50) for i in range(200)], "page_id long, url string, html string")
    rows = warc.with_revisits(pages)
    members = [gzip.compress(r[0].encode() + b"\r\n\r\n") for r in rows.select(warc.record(rows)).collect()]
    filler = gzip.compress(os.urandom(20_000))  # no record: a gap
    data = b"".join(m + (filler if k % 2 else b"") for k, m in enumerate(members * 10))
    t = time.process_time()
    found = list(warc.salvage(data))
    assert time.process_time() - t < 5
    assert sum(k == "record" for k, *_ in found) == 2000 and sum(k == "gap" for k, *_ in found) == 1000
    assert found[0][1] == 0 and found[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(found, found[1:]))


def test_op7_large_pages_have_small_files(spark, tmp_path):
    sizes = [10, 100_000, 1_500_000, 40_000, 2_000_000, 0]
    pages = spark.createDataFrame([(i, None, "é" * (n // 2)) for i, n in enumerate(sizes)], "page_id long, url string, html string")
    got = {r["page_id"]: r["payload_bytes"] for r in warc.archived_pages(pages.withColumn("size", warc.F.lit(9))).collect()}
    assert got == dict(enumerate(sizes))
    warc.write_archives(pages, str(tmp_path / "w"))
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "w") for f in fs if f.endswith(".txt") and os.path.getsize(os.path.join(d, f))]
    assert sum(os.path.getsize(f) > 1_400_000 for f in files) == 2 and max(map(os.path.getsize, files)) < 2_100_000


def test_op7_gaps_are_logged_and_fail_a_round_trip(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"p{i}") for i in range(9)], "page_id long, url string, html string").coalesce(1)
    write = warc.write_archives

    def damaged(pages, path, least=0):
        write(pages, path, least)
        path = path.removeprefix("file:")
        name = next(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".txt") and os.path.getsize(os.path.join(d, f)))
        data = open(name, "rb").read()
        with open(os.path.join(path, "more.warc"), "wb") as f:
            f.write(data[:3] + b"?" + data[4:])

    damaged(pages, str(tmp_path / "w"))
    log = warc.gaps(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert [r["start"] for r in log] == [0] and log[0]["stop"] > 50 and log[0]["reason"]
    monkeypatch.setattr(warc, "write_archives", damaged)
    with pytest.raises(Exception, match="gap in"):
        warc.archived_pages(pages).collect()


def test_op3_loss_is_cut_by_the_mask(spark, monkeypatch):
    rows = [(1, 0, "user", "<s>q"), (1, 1, "assistant", "a</s>b[INST]"), (1, 2, "assistant", "é🙂"), (2, 0, "assistant", ""), (3, 0, "user", "x"),
            (4, 0, "assistant", "long " * 200_000), (4, 1, "assistant", "\\b<s>")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as level", "2 as at", "'p' as piece", "3 as skip", "4 as size", "5 as formatted", "6 as same")
    import hashlib

    want = {c: "".join(t for k, _, r, t in rows if k == c and r == "assistant") for c in (1, 2, 3, 4)}
    got = {r["conv_id"]: r for r in chat.chat_digests(turns).collect()}
    assert {c: (r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == {
        c: (len(t), hashlib.sha256(t.encode()).hexdigest()) for c, t in want.items()}
    made = chat.format_chats
    monkeypatch.setattr(chat, "format_chats", lambda t: made(t).withColumn("loss_spans", chat.F.slice("loss_spans", 1, 1)))
    wrong = {r["conv_id"]: r["loss_chars"] for r in chat.chat_digests(turns).collect()}
    assert wrong[1] == len("a</s>b[INST]") and wrong[4] == 1_000_000


def test_op6_special_strings_in_long_runs():
    import random

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from rosterlens.llm.tokens import PrefixCounts

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), PrefixCounts.of(path)
    mark, rnd = "<|endoftext|>", random.Random(4)
    texts = [mark, mark * 3, f"a{mark}b", f"   {mark}  x", f"日本{mark}語 {mark[:-1]}", f"\n {mark}\n\n", f"{mark} it's{mark}'ll"]
    texts += ["".join(rnd.choice([mark, mark[:5], " ", "日", "é", "ab", "'s", "\n", "1"]) for _ in range(12)) for _ in range(60)]
    for text in texts:
        raw = text.encode()
        table = counter.tables(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        for k in range(len(text) + 1):
            assert table.tokens(len(text[:k].encode())) == len(library.encode(text[:k], add_special_tokens=False).ids), (text, k)
    run = "".join(chr(rnd.randint(0x4E00, 0x9FA0)) for _ in range(330_000))
    raw = (run + mark + run[:1000]).encode()  # 1 MB without a space
    t = time.process_time()
    table = counter.tables(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
    assert time.process_time() - t < 20
    assert table.n_tokens == len(library.encode(raw.decode(), add_special_tokens=False).ids)
    print("seconds", time.process_time() - t)
