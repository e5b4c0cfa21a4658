"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow pipeline.

Tokenizer A (byte-level pairs) reads a space and the text, tokenizer B (pieces,
which puts the space there itself) the text; strings of special tokens in a text
are plain text. Both then spell the same bytes. Where both end a token at one
byte, a group ends; each token of A is linked to all tokens of B in its group.

In each task, for stretches of texts:

1. Texts are cut before a space that follows no white space: neither vocabulary
   has a token across that. Distinct cuts are encoded by the two libraries once
   (a bounded cache), and lists taken for all cuts are flattened to ids.
2. Parent indices name each id's document, cumulative sums over a document
   its byte end. A hash join on (document, end) gives the common ends.
3. Ids of a group are paired; ``group_by`` (document, pair) gives each document's
   pairs with their number, ``group_by`` (pair) the documents that hold it in
   this block of documents. Spark adds the blocks' counts, finds the highest of
   each id of A, and brings each block the counts of its own pairs, against
   which its documents' pairs are summed.

Defined results: a text that is null or empty, or whose bytes one of the two
does not give back, has no tokens: zeros and an empty digest. Equal rows are
separate documents; null ids stay; other columns are ignored; an empty table
gives an empty result. A very long text is worked off in stretches between two
cuts, its digest as a running one; what is held of it are its distinct pairs. A
group of many tokens on both sides is merged to its distinct ids first.
"""

from __future__ import annotations

import hashlib
import os
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.textnum import text_buffers
from rosterlens.llm.tokens import BYTE_PATTERN, _made, byte_alphabet, spelled
from rosterlens.llm.work import keep, ship_code

STRETCH_BYTES = 1_000_000
BLOCK_PAIRS = 1_000_000  # (document, pair) rows of a block of documents, about
CACHED_CUTS = 200_000  # of each of two generations, none longer than
CACHED_BYTES = 48
PAIRS_AT_ONCE = 2_000_000
WIDE_GROUP = 4_096  # pairs of a group whose equal ids are merged first
SHIFT = 32  # a pair is id of A << SHIFT | id of B
_NO_STOP = {ord(c): None for c in ".,!?;:"}
_NONE, _BAD = 65_535, 65_534  # between the ids of A and B of a cut; a cut that is not given back

# ---------------------------------------------------------------- fixed values
# Last bytes of white space characters in UTF-8, by the bytes before them (and
# characters that some tables count as such).
_AFTER = {(0xC2,): [0x85, 0xA0], (0xE1, 0x9A): [0x80], (0xE1, 0xA0): [0x8E], (0xE2, 0x80): [*range(0x80, 0x90), 0xA8, 0xA9, 0xAF],
          (0xE2, 0x81): [0x9F], (0xE3, 0x80): [0x80], (0xEF, 0xBB): [0xBF]}
_ASCII_WHITE = [*range(0x09, 0x0E), *range(0x1C, 0x21)]
# ------------------------------------------------------------ end fixed values


class Both:
    """The two tokenizers, the bytes of their tokens, and a cache of cuts."""

    def __init__(self, paths: tuple[str, str]):
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        back = {ord(c): i for i, c in enumerate(byte_alphabet())}
        self.a_bytes = [self.a.id_to_token(i).translate(back).encode("latin-1", "replace") for i in range(self.a.get_vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size = pa.array([len(x) for x in self.a_bytes], pa.int64())
        self.b_size = pa.array([len(x) for x in self.b_bytes], pa.int64())
        self.names = pa.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))])
        self.space = self.b.piece_to_id("▁")
        self.plain = regex.compile(r"[\t\n\r -~¡-¬®-ɏ]*")
        self.words = regex.compile(BYTE_PATTERN)
        self.lead = spelled(b" ")
        self.new, self.old = {}, {}  # cuts in use, and those of the generation before

    @classmethod
    def of(cls, paths: tuple[str, str]) -> "Both":
        return _made(cls, paths)

    def _a_ids(self, text: str) -> list[int]:
        """Ids of A. Plain Latin text is split into words here, by the
        vocabulary's own pattern; the library does so for any other."""
        if text.isascii():
            letters = text.translate(_NO_STOP)
            if letters[1:].isalpha() and text[0] == " ":  # a word, with a mark behind it or without
                if len(letters) == len(text):
                    return [t.id for t in self.a.model.tokenize(self.lead + letters[1:])]
                if len(letters) == len(text) - 1 and text.startswith(letters):
                    return [t.id for w in (self.lead + letters[1:], text[-1]) for t in self.a.model.tokenize(w)]
        if self.plain.fullmatch(text):
            return [t.id for w in self.words.findall(text) for t in self.a.model.tokenize(spelled(w.encode()))]
        return self.a.encode(text, add_special_tokens=False).ids

    def cuts(self, raws: list[bytes]) -> list[bytes]:
        """For each cut its ids of A, a mark, its ids of B, as 16-bit numbers."""
        new, old = self.new, self.old
        got = list(map(new.get, raws))
        todo = []
        for k, value in enumerate(got):
            if value is None:
                value = old.get(raws[k])
                if value is None:
                    todo.append(k)
                else:
                    got[k] = new[raws[k]] = value
        texts = [raws[k].decode() for k in todo]
        a_bytes, b_bytes, join = self.a_bytes, self.b_bytes, b"".join
        for k, text, b in zip(todo, texts, self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []):
            raw, a = raws[k], self._a_ids(text)
            if len(raw) == 1:
                b = [self.space]
            same = join([a_bytes[i] for i in a]) == raw and join([b_bytes[i] for i in b]) == raw
            got[k] = array("H", [*a, _NONE, *b] if same else [_BAD, _NONE]).tobytes()
            if len(raw) <= CACHED_BYTES:
                new[raw] = got[k]
        if len(new) >= CACHED_CUTS:
            self.new, self.old = {}, new
        return got


_WHITE_BYTE = np.zeros(256, bool)
_WHITE_BYTE[_ASCII_WHITE] = True


def cut_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where documents begin, and every space that follows no white space."""
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    p1 = data[at - 1]
    white = _WHITE_BYTE[p1]
    wide = np.flatnonzero(p1 >= 0x80)
    p1, p2, p3 = p1[wide], data[np.maximum(at[wide] - 2, 0)], data[np.maximum(at[wide] - 3, 0)]
    for before, last in _AFTER.items():
        hit = np.isin(p1, last) & (p2 == before[-1])
        white[wide] |= hit if len(before) == 1 else hit & (p3 == before[0])
    begins = np.zeros(len(data) + 1, bool)
    begins[at[~white]] = True
    begins[bounds[:-1]] = True
    return np.flatnonzero(begins[:-1])


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values)


def _ends(ids: pa.Array, offsets: np.ndarray, sizes: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(document, byte end in it) of each id: parent indices, and cumulative
    sums over each document."""
    parent = pc.list_parent_indices(_lists(offsets, ids))
    total = pc.cumulative_sum(pc.take(sizes, ids))
    before = np.append(0, total.to_numpy(zero_copy_only=False))[offsets[:-1]]
    return parent, pc.subtract(total, pc.take(pa.array(before), parent))


def _spread(x: np.ndarray, each: np.ndarray) -> np.ndarray:
    """x[i], x[i] + 1, ... (each[i] of them), one after the other."""
    ends = np.cumsum(each)
    return np.repeat(x - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)


def _merged(group: np.ndarray, ids: np.ndarray, wide: np.ndarray):
    """(group, id, times) by group: equal ids of the ``wide`` groups are one."""
    big = wide[group]
    if not big.any():
        return group, ids, np.ones(len(ids), np.int64)
    t = pa.table({"g": group[big], "i": ids[big]}).group_by(["g", "i"], use_threads=False).aggregate([([], "count_all")])
    g = np.concatenate([group[~big], t["g"].to_numpy()])
    i = np.concatenate([ids[~big], t["i"].to_numpy()])
    n = np.concatenate([np.ones(int((~big).sum()), np.int64), t["count_all"].to_numpy()])
    order = np.argsort(g, kind="stable")
    return g[order], i[order], n[order]


def _summed(t: pa.Table, keys: list[str], values: list[str]) -> pa.Table:
    out = t.group_by(keys, use_threads=False).aggregate([(v, "sum") for v in values])
    return out.rename_columns([c.removesuffix("_sum") for c in out.column_names]).select([*keys, *values])


def _pairs(doc_of_group, ga, a, gb, b, n_groups) -> pa.Table:
    """(doc, pair, times): the linked ids of each document."""
    wide = np.bincount(ga, minlength=n_groups) * np.bincount(gb, minlength=n_groups) > WIDE_GROUP
    ga, a, ma = _merged(ga, a, wide)
    gb, b, mb = _merged(gb, b, wide)
    first, n = np.searchsorted(gb, np.arange(n_groups)), np.bincount(gb, minlength=n_groups)
    each = n[ga]
    ends, parts, i = np.cumsum(each), [], 0
    while i < len(ga):
        done = ends[i] - each[i]
        j = max(i + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        k = _spread(first[ga[i:j]], each[i:j])
        rows = np.repeat(np.arange(i, j), each[i:j])
        parts.append(_summed(pa.table({"doc": doc_of_group[ga[rows]], "pair": (a[rows].astype(np.int64) << SHIFT) | b[k],
                                       "times": ma[rows] * mb[k]}), ["doc", "pair"], ["times"]))
        i = j
    if not parts:
        return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})
    return parts[0] if len(parts) == 1 else _summed(pa.concat_tables(parts), ["doc", "pair"], ["times"])


def align(both: Both, data: np.ndarray, bounds: np.ndarray):
    """Of texts (each beginning with the space) in one buffer: whether each is
    given back, (n_a, n_b, n_groups, n_links), the groups as text, and the table
    (doc, pair, times) of linked ids. Texts not given back have no tokens."""
    n_docs = len(bounds) - 1
    starts = cut_starts(data, bounds)
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.append(starts, bounds[-1]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = pc.dictionary_encode(raw)
    values = both.cuts(coded.dictionary.to_pylist())
    pool = np.frombuffer(b"".join(values), np.uint16)
    ends = np.cumsum([len(v) // 2 for v in values])
    begins, mid = np.append(0, ends[:-1]), np.flatnonzero(pool == _NONE)
    bad = pool[begins] == _BAD
    number = coded.indices.to_numpy(zero_copy_only=False)
    doc = np.searchsorted(bounds, starts, "right") - 1
    given = np.ones(n_docs, bool)
    given[doc[bad[number]]] = False
    use = given[doc]
    number, doc = number[use], doc[use]

    def flat(first, last):
        """Ids of all cuts in their order, and each document's bounds among them."""
        lists = _lists(np.append(0, np.cumsum(last - first)), pa.array(pool[_spread(first, last - first)].astype(np.int32)))
        ids = pc.list_flatten(pc.take(lists, pa.array(number)))
        per = np.bincount(doc, weights=(last - first)[number], minlength=n_docs).astype(np.int64)
        return ids, np.append(0, np.cumsum(per))

    a, a_at = flat(begins, mid)
    b, b_at = flat(mid + 1, ends)
    a_doc, a_end = _ends(a, a_at, both.a_size)
    b_doc, b_end = _ends(b, b_at, both.b_size)
    left = pa.table({"doc": a_doc, "end": a_end, "i": pa.array(np.arange(len(a)))})
    right = pa.table({"doc": b_doc, "end": b_end, "j": pa.array(np.arange(len(b)))})
    common = left.join(right, ["doc", "end"], join_type="inner", use_threads=False)
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[common["i"].to_numpy()] = 1
    b_last[common["j"].to_numpy()] = 1
    ga, gb = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    n_groups = int(a_last.sum())
    doc_of_group = a_doc.to_numpy(zero_copy_only=False)[a_last == 1].astype(np.int64)
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    links = np.bincount(doc_of_group, weights=na * nb, minlength=n_docs).astype(np.int64)
    counts = np.stack([np.diff(a_at), np.diff(b_at), np.bincount(doc_of_group, minlength=n_docs), links], 1)

    def named(ids, n):
        return pc.binary_join(_lists(np.append(0, np.cumsum(n)), pc.take(both.names, ids)), ",")

    written = pc.binary_join_element_wise(named(a, na), named(b, nb), "|")
    texts = pc.binary_join(_lists(np.append(0, np.cumsum(counts[:, 2])), written), ";").to_pylist()
    table = _pairs(doc_of_group, ga, a.to_numpy(zero_copy_only=False), gb, b.to_numpy(zero_copy_only=False), n_groups)
    return given, counts, texts, table


OUT = pa.schema([("is_pair", pa.bool_()), ("block", pa.int64()), ("at", pa.int64()), ("pair", pa.int64()), ("n", pa.int64()),
                 ("doc_id", pa.int64()), ("counts", pa.list_(pa.int64())), ("groups_sha256", pa.string()),
                 ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])
OUT_SQL = ("is_pair boolean, block long, at long, pair long, n long, doc_id long, counts array<long>, groups_sha256 string, "
           "pairs array<int>, times array<long>")
PAIR_ROWS = 50_000


class _Block:
    """Documents aligned so far, until their pairs make a block."""

    def __init__(self, number: int):
        self.number, self.docs, self.parts, self.rows, self.split = number, [], [], 0, False

    def add(self, table: pa.Table) -> None:
        self.parts.append(table)
        self.rows += len(table)
        if self.split and self.rows > 2 * BLOCK_PAIRS:
            self.merge()

    def merge(self) -> None:
        self.parts = [_summed(pa.concat_tables(self.parts), ["doc", "pair"], ["times"])]
        self.rows = len(self.parts[0])

    def batches(self):
        """The block's distinct pairs with the documents that hold each, then its
        documents, their pairs by place among those."""
        if self.split and self.parts:
            self.merge()
        empty = pa.array([], pa.int64())
        table = pa.concat_tables(self.parts) if self.parts else pa.table({"doc": empty, "pair": empty, "times": empty})
        good = np.array([d[2] is not None for d in self.docs], bool)
        table = table.filter(pa.array(good[table["doc"].to_numpy()])) if len(table) else table
        held = table.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        pairs, n = held["pair"].to_numpy(), held["count_all"].to_numpy()
        for i in range(0, len(pairs), PAIR_ROWS):
            m = len(pairs[i:i + PAIR_ROWS])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ones(m, bool)), pa.array(np.full(m, self.number)), pa.array(np.arange(i, i + m)), pa.array(pairs[i:i + m]),
                pa.array(n[i:i + m]), *(pa.nulls(m, f.type) for f in list(OUT)[5:])], schema=OUT)
        place = np.searchsorted(pairs, table["pair"].to_numpy()).astype(np.int32)
        doc = table["doc"].to_numpy()
        order = np.lexsort((place, doc))
        at = np.searchsorted(doc[order], np.arange(len(self.docs) + 1))
        place, times = place[order], table["times"].to_numpy()[order]
        i = 0
        while i < len(self.docs):
            j = max(i + 1, int(np.searchsorted(at, at[i] + 4 * PAIR_ROWS, "right")) - 1)
            part, m = self.docs[i:j], j - i
            offsets = pa.array((at[i:j + 1] - at[i]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(m, bool)), pa.array(np.full(m, self.number)), pa.array(np.arange(i, j)), *(pa.nulls(m, pa.int64()),) * 2,
                pa.array([d[0] for d in part], pa.int64()), pa.array([d[1].tolist() if d[2] else [0] * 4 for d in part], pa.list_(pa.int64())),
                pa.array([d[2].hexdigest() if d[2] else "" for d in part], pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(place[at[i]:at[j]])),
                pa.ListArray.from_arrays(offsets, pa.array(times[at[i]:at[j]], pa.int64()))], schema=OUT)
            i = j


def _aligner(paths: tuple[str, str], most: int, block_pairs: int):
    """``most`` bytes of texts are aligned at once; a block ends at ``block_pairs``."""
    def run(batches):
        both = Both.of(paths)
        base, seq = TaskContext.get().partitionId() << 32, 0
        block = _Block(base)

        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            ids = batch.column(0).to_pylist()
            i = 0
            while i < len(ids):
                if bounds[i + 1] - bounds[i] > most:
                    _long(both, most, block, ids[i], data[bounds[i]:bounds[i + 1]])
                    j = i + 1
                else:
                    j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, "right")) - 1)
                    j = min(j, len(ids))
                    given, counts, texts, table = align(both, data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
                    # a text of the space alone is null or empty: no tokens
                    some = given & (np.diff(bounds[i:j + 1]) > 1)
                    first = len(block.docs)
                    for k in range(j - i):
                        block.docs.append((ids[i + k], counts[k], hashlib.sha256(texts[k].encode()) if some[k] else None))
                    block.add(table.set_column(0, "doc", pc.add(table["doc"], first)))
                i = j
                if block.rows >= block_pairs:
                    yield from block.batches()
                    seq += 1
                    block = _Block(base + seq)
        yield from block.batches()

    return run


def _long(both: Both, most: int, block: _Block, doc_id, data: np.ndarray) -> None:
    """One text in stretches between cuts, its numbers added up."""
    starts = cut_starts(data, np.array([0, len(data)]))
    number, counts, digest, i = len(block.docs), np.zeros(4, np.int64), hashlib.sha256(), 0
    block.split = True
    block.docs.append((doc_id, counts, digest))
    while i < len(data):
        k = int(np.searchsorted(starts, i + most, "right")) - 1
        j = int(starts[k]) if k >= 0 and starts[k] > i else int(starts[k + 1]) if k + 1 < len(starts) else len(data)
        j = len(data) if len(data) - i <= most else j
        given, n, texts, table = align(both, data[i:j], np.array([0, j - i]))
        if not given[0]:
            block.docs[number] = (doc_id, counts, None)
            return
        digest.update(((";" if i else "") + texts[0]).encode())
        counts += n[0]
        block.add(table.set_column(0, "doc", pc.add(table["doc"], number)))
        i = j


def _scored(batches):
    """Rows by block, the counts of its pairs before its documents -> the
    documents with their links' counts added up."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    now, parts = None, []
    for batch in batches:
        blocks, is_pair = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        cut = np.flatnonzero(np.append(True, (blocks[1:] != blocks[:-1]) | (is_pair[1:] != is_pair[:-1])))
        for i, j in zip(cut, np.append(cut[1:], len(blocks))):
            part = batch.slice(i, j - i)
            if blocks[i] != now:
                now, parts = blocks[i], []
            if is_pair[i]:
                parts.append((part.column(2).to_numpy(), part.column(3).to_numpy(zero_copy_only=False)))
                continue
            if len(parts) > 1:
                parts = [tuple(map(np.concatenate, zip(*parts)))]
            count, best = parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, bool))
            pairs, times = part.column("pairs"), part.column("times")
            flat, parent = pairs.flatten().to_numpy(), pc.list_parent_indices(pairs).to_numpy()
            t = times.flatten().to_numpy()
            sums = np.zeros((2, j - i), np.int64)
            np.add.at(sums[0], parent, t * best[flat])
            np.add.at(sums[1], parent, t * count[flat])
            four = part.column("counts").flatten().to_numpy().reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(four[:, k]) for k in range(4)),
                                              pa.array(sums[0]), pa.array(sums[1]), part.column("groups_sha256")], names)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                   stretch_bytes: int = STRETCH_BYTES, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Blocks of documents, kept in the shared folder: rows of a block's distinct
    pairs (``is_pair``: block, at, pair, n documents) and its documents."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.concat(F.lit(" "), F.coalesce(text_col, F.lit(""))).alias("text"))
    return keep(rows.mapInArrow(_aligner((a_path, b_path), stretch_bytes, block_pairs), OUT_SQL), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold a pair of ids linked, and whether
    no pair of its id of A is held by more."""
    total = blocks.where("is_pair").groupBy("pair").agg(F.sum("n").alias("count"))
    a = F.shiftright("pair", SHIFT)
    # one row an id of A: its vocabulary bounds it
    top = total.groupBy(a.alias("a")).agg(F.max("count").alias("top"))
    return total.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def alignment_digests(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                      stretch_bytes: int = STRETCH_BYTES, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document."""
    blocks = aligned_blocks(docs, a_path, b_path, id_col, text_col, stretch_bytes, block_pairs)
    counts = keep(pair_counts(blocks), "pairs")
    lists = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("counts", "array<long>"), ("groups_sha256", "string"),
                                                       ("pairs", "array<int>"), ("times", "array<long>"))]
    named = blocks.where("is_pair").select("block", "at", "pair").join(counts, "pair").select(
        "block", F.lit(True).alias("is_pair"), "at", "count", "best", *lists)
    rows = blocks.where("not is_pair").select(
        "block", "is_pair", "at", F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("best"),
        "doc_id", "counts", "groups_sha256", "pairs", "times")
    stream = named.unionByName(rows).repartition("block").sortWithinPartitions("block", F.desc("is_pair"), "at").drop("at")
    return stream.mapInArrow(_scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                      "groups_sha256 string")
