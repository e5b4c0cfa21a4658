"""What a task leaves in a worker process: nothing of another operator, and no freed memory."""

import os
import pickle
import random
import subprocess
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from tokenizers import Tokenizer

from rosterlens.llm import ngram_join, packing, queries, repeat_index, tokens, toxic_segments, work
from rosterlens.llm.tokens import WordIds

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
HELD = """
import re
import numpy as np
from rosterlens.llm import work

def held():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

def run(batches):
    for n in batches:
        lists = [bytearray(1000) for _ in range(n)]
        end.append(bytearray(1000))  # a small object behind them keeps the heap from shrinking
        yield len(lists)
        del lists

end, before = [], held()
assert list(work.lean(run)([150_000, 150_000])) == [150_000, 150_000]
print(held() - before)
"""

PACKS = """
import re
import pyarrow as pa
import public_tokenizers
from rosterlens.llm import packing, queries, work

def held():
    work.release()
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

path = public_tokenizers.path(queries.WORD_VOCABULARY)
packing.WordIds.of(path)
run, before = work.lean(packing._tokenise(path, 4096, 1, False), keeps=True), held()
word = lambda n: "".join(chr(97 + n // 26**k % 26) for k in range(5))
batches = (pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join(map(word, range(a, a + 10_000)))])], ["doc", "text"])
           for a in range(0, 400_000, 10_000))
for _ in run(batches):
    pass
print(held() - before)
"""


def test_a_task_drops_what_other_operators_keep():
    path = public_tokenizers.path(queries.WORD_VOCABULARY)
    work.KEPT.clear()
    words = WordIds.of(path)
    assert list(work.lean(lambda b: iter(b), keeps=True)([1, 2])) == [1, 2]
    assert WordIds.of(path) is words
    shipped = pickle.loads(cloudpickle.dumps(work.lean(lambda b: iter(b))))  # as a worker gets it
    assert list(shipped([1, 2])) == [1, 2]
    assert not work.KEPT
    work.KEPT["x"] = words
    assert work.lean_group(lambda t: t)("t") == "t" and not work.KEPT


def test_memory_is_released_when_a_task_fails(monkeypatch):
    calls = []
    monkeypatch.setattr(work, "release", lambda: calls.append(1))

    def fails(batches):
        yield from batches
        raise ValueError

    with pytest.raises(ValueError):
        list(work.lean(fails)([1]))
    with pytest.raises(ZeroDivisionError):
        work.lean_group(lambda t: 1 / 0)(None)
    assert len(calls) == 2


def test_a_worker_gives_freed_memory_back():
    done = subprocess.run([sys.executable, "-c", HELD], cwd=ROOT, capture_output=True, text=True, timeout=60, check=True)
    assert int(done.stdout) < 60


def test_a_worker_keeps_the_ids_of_many_words_in_little_memory():
    done = subprocess.run([sys.executable, "-c", PACKS], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    assert int(done.stdout) < 70


def test_an_index_of_repeats_takes_bounded_memory():
    rng = random.Random(5)
    syllables = ["the", "er", "in", "ing", "and", "th", " ", ". "]
    rows = [(k, k, 0, 501, "".join(rng.choices(syllables, k=400))[:700].encode()) for k in range(2_500)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "rid", "start", "count", "content"])
    tracemalloc.start()
    try:
        for _ in repeat_index._index(200)([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < 90 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("most", [4, 50, 400_000])
def test_ids_do_not_depend_on_what_is_kept(most):
    path = public_tokenizers.path(queries.WORD_VOCABULARY)
    plain, words = Tokenizer.from_file(path), WordIds(path)
    words.table, words.parts.most, words.parts.longest = tokens._WordTable(most), max(1, most // 4), 6
    rng = random.Random(most)
    known = ["the", "The.", "don't", "caf\u00e9", "\u4e16\u754c", "a" * 700, "x9y-z", "<|endoftext|>", "\u2167", "\u200b", "#$", *(f"w{k}" for k in range(80))]
    for _ in range(12):
        texts = [" ".join(rng.choices(known, k=rng.randrange(60))) for _ in range(6)]
        raws = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raws), np.uint8)
        ids, ends = words(data, np.append(0, np.cumsum([len(r) for r in raws])))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        t = words.table
        assert len(t.keys) <= most and len(t.pool) <= most * tokens.WORD_IDS and (t.keys[1:] > t.keys[:-1]).all()


def test_stages_of_the_pipeline_are_lean(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    kept = {}
    real = work.lean

    def seen(run, keeps=False):
        kept[run.__module__] = keeps
        return real(run, keeps)

    for module in (ngram_join, packing, repeat_index, toxic_segments):
        module.lean = seen
    try:
        ngram_join.set_table(docs), packing.pieces(docs, public_tokenizers.path(queries.WORD_VOCABULARY))
        repeat_index.repeat_spans(docs)
        toxic_segments.without_toxic(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    finally:
        for module in (ngram_join, packing, repeat_index, toxic_segments):
            module.lean = real
    assert kept == {m.__name__: m is packing for m in (ngram_join, packing, repeat_index, toxic_segments)}
