"""Exact ids and prefix counts of public byte-pair vocabularies, word by word.

Both vocabularies never merge across a change from text to white space, so a
text is the sequence of its chunks and each distinct chunk is worked out once
in a worker (a bounded cache of two generations).
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

import numpy as np

from rosterlens.llm.textnum import Words
from rosterlens.llm.work import KEPT

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

GENERATION = 250_000  # cached chunks of each of two generations
CACHED_LENGTH = 512  # longer ones are worked out each time, so a cache is bounded in bytes
WORDS = 400_000  # words kept in arrays
WORD_IDS = 8  # ids kept a word, on average at most
PARTS, PART_LENGTH = 50_000, 128  # words without marks: a generation, and the longest kept (of whole words, in ids)
NO_TOKEN = 65_535  # stands for "no token before"; ids are smaller

# ---------------------------------------------------------------- fixed values
# Word patterns of the two vocabularies, as their files state them.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Unicode white space.
SPACE_CODES = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
# ------------------------------------------------------------ end fixed values

#: Characters that the word vocabulary's normaliser only lower-cases, one by one.
_PLAIN = re.compile("[!-~¡-¬®-ɏ]+")
SPACE = "".join(map(chr, SPACE_CODES))
_WIDE_SPACE = re.compile("[" + SPACE[6:] + "]")
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else free))
        free += b not in shown
    return out


_ALPHABET = {i: c for i, c in enumerate(byte_alphabet())}


def spelled(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_ALPHABET)


class _Generations(dict):
    """A cache of at most two generations: entries in use move to the new one."""

    def __init__(self, make, most: int = GENERATION):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Short(_Generations):
    """The same for strings, of which it keeps those of a bounded length."""

    def __init__(self, make, most: int = GENERATION, longest: int = CACHED_LENGTH):
        super().__init__(make, most)
        self.longest = longest

    def __missing__(self, key):
        return super().__missing__(key) if len(key) <= self.longest else self.make(key)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[list, np.ndarray]:
    """Distinct strings data[start:end] by their hashes, and each one's number."""
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())], number


def _made(kind, path: str):
    """One object of a kind and file per worker process."""
    if (kind, path) not in KEPT:
        KEPT[kind, path] = kind(path)
    return KEPT[kind, path]


def _packed(ids: list) -> bytes:
    """Ids as the bytes of an array: a fraction of what a tuple of numbers holds."""
    return array("I", ids).tobytes()


def _gathered(pool: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """pool[begin:begin + sizes] of all, one after the other, and their ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(begin - (ends - sizes), sizes) + np.arange(total)], ends


class _WordTable:
    """Ids of words by their hashes, in sorted arrays: a tenth of what a dict
    of them takes. Once it is full, the half used most stays, without the long ones."""

    def __init__(self, most: int = WORDS):
        self.most = most
        self.keys, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begin, self.size, self.hits = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def ids(self, h: np.ndarray, make) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where in it those of each of the distinct, sorted
        hashes begin and how many they are. ``make`` gives the packed ids of the
        words by a number in ``h`` that are not here."""
        at = np.searchsorted(self.keys, h)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == h[known]
        fresh = np.flatnonzero(~known)
        values = [make(i) for i in fresh.tolist()]
        begin, size = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        begin[known], size[known] = self.begin[at[known]], self.size[at[known]]
        size[fresh] = np.fromiter(map(len, values), np.int64, len(values)) // 4
        begin[fresh] = len(self.pool) + np.cumsum(size[fresh]) - size[fresh]
        pool = np.concatenate([self.pool, np.frombuffer(b"".join(values), np.uint32)])
        self.hits[at[known]] += 1
        self.keys, self.pool = np.insert(self.keys, at[fresh], h[fresh]), pool
        self.begin = np.insert(self.begin, at[fresh], begin[fresh])
        self.size = np.insert(self.size, at[fresh], size[fresh])
        self.hits = np.insert(self.hits, at[fresh], 0)
        if len(self.keys) > self.most or len(pool) > self.most * WORD_IDS:
            self._halve()
        return pool, begin, size

    def _halve(self) -> None:
        order = np.argsort(-self.hits, kind="stable")
        order = order[self.size[order] <= PART_LENGTH][:self.most // 2]
        order = np.sort(order[np.cumsum(self.size[order]) <= self.most * WORD_IDS // 2])
        self.keys, self.size, self.hits = self.keys[order], self.size[order], self.hits[order] // 2
        self.pool, ends = _gathered(self.pool, self.begin[order], self.size)
        self.begin = ends - self.size


class WordIds:
    """Ids of the lower-casing word vocabulary (white space dropped)."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = regex.compile(WORD_PATTERN)
        self.table = _WordTable()
        self.parts = _Short(self._part, PARTS, PART_LENGTH)  # words without their marks, in lower case

    @classmethod
    def of(cls, path: str) -> "WordIds":
        return _made(cls, path)

    def _part(self, word: str) -> bytes:
        shown = word if word.isascii() else spelled(word.encode())  # ASCII characters spell themselves
        return _packed([t.id for t in self.model.tokenize(shown)])

    def _ids(self, raw: bytes) -> bytes:
        text = raw.decode()
        if not _PLAIN.fullmatch(text) or "<|" in text:
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        text = text.lower()
        if text.isalpha():
            return self.parts[text]
        if text[:-1].isalpha() and text[-1] in ".,!?;:":
            return self.parts[text[:-1]] + self.parts[text[-1]]
        return b"".join(map(self.parts.__getitem__, self.words.findall(text)))

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a buffer, one after the other, and their bounds."""
        words = Words(data, bounds)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        h, first, number = np.unique(words.hashes(lower=False), return_index=True, return_inverse=True)
        start, end = words.start[first], words.end[first]
        pool, begin, size = self.table.ids(h, lambda i: self._ids(data[start[i]:end[i]].tobytes()))
        ids, ends = _gathered(pool, begin[number], size[number])
        return ids, np.append(0, ends)[words.first]


class PrefixCounts:
    """Token counts of every prefix under the byte-level vocabulary.

    The last token of a prefix is the one token that ends there and stays
    unmerged next to the last token of what it leaves; the count is that
    prefix's count plus one. So one pass over a word gives all its prefixes.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        back = {c: b for b, c in _ALPHABET.items()}
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.vocabulary = {bytes(back[c] for c in s): i for s, i in vocabulary.items() if s not in self.special}
        self.spelling = {i: spelled(b) for b, i in self.vocabulary.items()}
        self.endings: dict = {}  # a tree of the tokens read from their last byte; a node's own token at -1
        for raw, i in self.vocabulary.items():
            node = self.endings
            for b in reversed(raw):
                node = node.setdefault(b, {})
            node[-1] = i
        self.state = b"", [NO_TOKEN], [0]  # the word worked on last
        self.words = regex.compile(BYTE_PATTERN)
        self.pairs = _Generations(self._stays, 2 * GENERATION)
        self.word_counts = _Short(self._word, 20_000)
        self.cache = _Short(self._chunk)

    @classmethod
    def of(cls, path: str) -> "PrefixCounts":
        return _made(cls, path)

    def _stays(self, pair: int) -> bool:
        """Whether the tokens of a pair (the first may be none) remain as they are side by side."""
        one, two = divmod(pair, NO_TOKEN + 1)
        ids = [two] if one == NO_TOKEN else [one, two]
        return [t.id for t in self.model.tokenize("".join(self.spelling[i] for i in ids))] == ids

    def _word(self, raw: bytes):
        """Counts of the prefixes of 1, 2, ... bytes of one word of the pattern."""
        before, last, count = self.state
        n, most = 0, min(len(raw), len(before))
        while n < most and raw[n] == before[n]:
            n += 1
        # words come sorted: the prefix shared with the one before is already counted
        last, count, pairs, top = last[:n + 1], count[:n + 1], self.pairs, self.endings
        for i in range(n, len(raw)):
            node, at, found = top, i, []
            while at >= 0:
                node = node.get(raw[at])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None:
                    found.append((at, token))
                at -= 1
            for at, token in reversed(found):
                if pairs[last[at] * (NO_TOKEN + 1) + token]:
                    last.append(token)
                    count.append(count[at] + 1)
                    break
        self.state = raw, last, count
        return bytes(count[1:]) if len(count) < 200 else count[1:]

    def _chunk(self, text: str) -> tuple:
        """(bytes, tokens, count after each byte) of white space and the word after it.
        Inside a character, the count is that before it."""
        counts, base, at = [], 0, 0
        for mark in self.marks.finditer(text):
            # up to its last character a special string is plain text, then it is one token, and what follows begins anew
            before, own = text[at:mark.start()], mark[0]
            counts += [base + c for c in self._plain(before + own[:-1])[2]]
            counts += [counts[-1] if counts else 0] * (len(own[-1].encode()) - 1)
            base += self._plain(before)[1] + 1
            counts.append(base)
            at = mark.end()
        if not at:
            return self._plain(text)
        _, more, rest = self._plain(text[at:])
        counts += [base + c for c in rest]
        return len(counts), base + more, counts

    def _plain(self, text: str) -> tuple:
        """The same of a text without special strings."""
        counts, total = [], 0
        for word in self.words.findall(text):
            raw = word.encode()
            own = self.word_counts[raw]
            if word[-1] in SPACE:
                run = self.word_counts[text[:len(text) - len(text.lstrip(SPACE))].encode()]
                counts += list(run[len(counts):len(counts) + len(raw)])  # as if the text ended in this white space
            elif word[0] == "'" and len(word) > 1 and word[1].isalpha():
                rest = self.word_counts[raw[1:]]
                counts += [total + self.word_counts[raw[:1]][0] + c for c in [0, *rest[:-1]]] + [total + own[-1]]
            elif raw[:1] == b" " and counts:
                run = self.word_counts[text[:len(text) - len(text.lstrip(SPACE))].encode()]
                counts += [run[-1], *(total + c for c in own[1:])]
            else:
                counts += [total + c for c in own]
            total += own[-1]
        if not text.isascii():
            raw, before = text.encode(), 0
            for i in range(len(raw)):
                if i + 1 < len(raw) and raw[i + 1] & 0xC0 == 0x80:
                    counts[i] = before
                else:
                    before = counts[i]
        return len(counts), total, bytes(counts) if total < 200 and len(counts) < 200 else counts

    def table(self, text: str) -> "PrefixTable":
        return PrefixTable([self.cache[c] for c in _CHUNK.findall(text)])

    def tables(self, data: np.ndarray, bounds: np.ndarray) -> list:
        """A table for each document of a buffer."""
        words = Words(data, bounds)
        at = np.zeros(len(data) + 1, bool)
        at[words.end] = at[bounds] = True
        cut = np.flatnonzero(at)  # chunks end after words and documents
        start, end = cut[:-1], cut[1:]
        first = np.searchsorted(start, bounds)
        if not len(start):
            return [PrefixTable([])] * (len(bounds) - 1)
        pieces = Words.__new__(Words)
        pieces.data, pieces.start, pieces.end = data, start, end
        raws, number = distinct(data, start, end, pieces.hashes(lower=False))
        odd = np.fromiter((not r.isascii() and _WIDE_SPACE.search(r.decode()) is not None for r in raws), bool, len(raws))
        keys = [None if o else r.decode() for r, o in zip(raws, odd)]
        cache = self.cache
        made = {k: cache[k] for k in sorted(k for k in keys if k is not None and k not in cache and k not in cache.old)}
        values = [None if k is None else made[k] if k in made else cache[k] for k in keys]
        strange = odd[number]
        sizes = end - start
        tokens = np.fromiter((0 if v is None else v[1] for v in values), np.int64, len(values))[number]
        raw, out = data.tobytes(), []
        for d in range(len(bounds) - 1):
            a, b = first[d], first[d + 1]
            if strange[a:b].any():  # white space beyond ASCII: cut into chunks by character
                out.append(self.table(raw[bounds[d]:bounds[d + 1]].decode()))
            else:
                out.append(PrefixTable(None, np.cumsum(sizes[a:b]), np.cumsum(tokens[a:b]), values, number[a:b]))
        return out


class PrefixTable:
    """Counts of all prefixes of one text: sums at chunk ends, and the chunks' own counts."""

    def __init__(self, chunks, ends=None, sums=None, values=None, number=None):
        if chunks is not None:
            n = len(chunks)
            ends = np.cumsum(np.fromiter((c[0] for c in chunks), np.int64, n))
            sums = np.cumsum(np.fromiter((c[1] for c in chunks), np.int64, n))
            values, number = chunks, range(n)
        self.ends, self.sums, self.values, self.number = ends, sums, values, number

    @property
    def n_bytes(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    @property
    def n_tokens(self) -> int:
        return int(self.sums[-1]) if len(self.sums) else 0

    def _before(self, i: int) -> tuple[int, int]:
        return (int(self.ends[i - 1]), int(self.sums[i - 1])) if i else (0, 0)

    def tokens(self, prefix: int) -> int:
        """Tokens of the first ``prefix`` bytes."""
        if prefix <= 0 or not len(self.ends):
            return 0
        i = min(int(np.searchsorted(self.ends, prefix)), len(self.ends) - 1)
        size, _, counts = self.values[self.number[i]]
        before, base = self._before(i)
        return base + counts[min(prefix - before, size) - 1]

    def bytes_within(self, budget: int) -> int:
        """Bytes of the prefix after which the count first goes over ``budget``."""
        i = int(np.searchsorted(self.sums, budget, "right"))
        # a prefix may take more tokens than a longer one, so the chunk before counts too
        for k in range(max(0, i - 1), min(i + 1, len(self.sums))):
            before, base = self._before(k)
            for j, c in enumerate(self.values[self.number[k]][2]):
                if base + c > budget:
                    return before + j
        return self.n_bytes

    def counts(self) -> np.ndarray:
        """Count after each byte, as one array."""
        base = np.append(0, self.sums[:-1]) if len(self.sums) else self.sums
        own = np.fromiter(chain.from_iterable(self.values[k][2] for k in self.number), np.int64)
        return own + np.repeat(base, np.diff(np.append(0, self.ends)))
