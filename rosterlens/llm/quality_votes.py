"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-
maximisation over the counts of vote patterns estimates how often each rule
votes, and votes rightly, on good and on bad documents; the posterior
probability of good replaces "all rules must pass". There are at most
3**rules patterns whatever the corpus holds, so the driver sees only their
counts, taken over all documents.

Base failures (fewer than 50 words, or over half of the words inside repeated
three-word windows) are never kept.

Defined results: null text is empty, so it fails; equal rows are scored alike;
null ids stay; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.textnum import Words, blocks, gram_hashes, text_buffers
from rosterlens.llm.work import keep, ship_code

BLOCK_BYTES = 2_000_000
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_marked",
          "n_lines", "n_distinct"]
RULES = ["symbols", "marked_words", "repeats", "capitals", "word_length", "lines", "variety"]


def document_counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every document of a buffer."""
    words = Words(data, bounds)
    n_docs = len(bounds) - 1
    h = words.hashes(lower=False)
    doc = words.doc

    def per_document(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags))
        return sums[at[1:]] - sums[at[:-1]]

    def equal_earlier(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether an entry equals an earlier, or any other, entry of its document."""
        order = np.lexsort((hashes, owner))
        a, b = hashes[order], owner[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        later, any_ = np.zeros(len(order), bool), np.zeros(len(order), bool)
        later[order[1:][same]] = True
        any_[order[1:][same]] = True
        any_[order[:-1][same]] = True
        return later, any_

    out = {"n_words": words.count}
    # code points of words: bytes that do not continue a character, outside separators
    lead = (data & 0xC0) != 0x80
    white = np.zeros(256, bool)
    white[[0x20, *range(9, 14)]] = True
    out["word_chars"] = per_document(lead & ~white[data], bounds)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    symbols = symbol[data]
    out["n_symbols"] = per_document(symbols, bounds)
    upper = (data >= 65) & (data <= 90)
    out["n_upper"] = per_document(upper, bounds)
    out["n_letters"] = out["n_upper"] + per_document((data >= 97) & (data <= 122), bounds)
    sums = np.append(0, np.cumsum(symbols | (data == ord("!"))))
    out["n_marked"] = per_document(sums[words.end] > sums[words.start], words.first)
    # three-word windows: hashes of neighbours, within one document
    covered = np.zeros(len(words) + 2, np.int64)
    g = gram_hashes(h, 3)
    inside = np.flatnonzero(doc[:len(g)] == doc[2:]) if len(g) else np.zeros(0, np.int64)
    if len(inside):
        _, twice = equal_earlier(g[inside], doc[inside])
        at = inside[twice]
        for j in range(3):
            covered[at + j] = 1
    out["n_repeat_words"] = per_document(covered[:len(words)], words.first)
    later, _ = equal_earlier(h, doc)
    out["n_distinct"] = words.count - per_document(later, words.first)
    # lines, by the hash of their bytes
    end = np.zeros(len(data) + 1, bool)
    end[:len(data)] = data == 10
    end[bounds] = True
    lines = Words.__new__(Words)
    stop = np.flatnonzero(end)
    at_break = np.zeros(len(data) + 1, bool)
    at_break[:len(data)] = data == 10
    start = np.append(0, stop[:-1] + at_break[stop[:-1]]) if len(stop) else stop
    keep_ = start < stop
    lines.data, lines.start, lines.end = data, start[keep_], stop[keep_]
    has_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    lines.start, lines.end = lines.start[has_word], lines.end[has_word]
    owner = np.searchsorted(bounds, lines.start, "right") - 1
    first = np.searchsorted(owner, np.arange(n_docs + 1))
    later, _ = equal_earlier(lines.hashes(lower=False) if len(lines.start) else np.zeros(0, np.uint64), owner)
    out["n_dup_lines"] = per_document(later, first)
    out["n_lines"] = np.diff(first)
    return {k: np.asarray(v, np.int64) for k, v in out.items()}


def _measure(batches):
    for batch in batches:
        data, bounds = text_buffers(batch.column(1))
        parts = [document_counts(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]) for i, j in blocks(bounds, BLOCK_BYTES)]
        cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64)) for c in COUNTS]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc", *COUNTS])


def votes() -> dict:
    """Rule name -> column of 1 (good), -1 (bad) or 0 (abstains)."""
    n = F.col("n_words")

    def rate(part, whole):
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    def vote(good, bad):
        return F.when(n < 5, 0).when(bad, -1).when(good, 1).otherwise(0)

    symbols, marked, repeats = rate("n_symbols", "word_chars"), rate("n_marked", "n_words"), rate("n_repeat_words", "n_words")
    capitals, length, variety = rate("n_upper", "n_letters"), rate("word_chars", "n_words"), rate("n_distinct", "n_words")
    lines = rate("n_dup_lines", "n_lines")
    return {
        "symbols": vote(symbols < 0.02, symbols > 0.1),
        "marked_words": vote(marked < 0.1, marked > 0.4),
        "repeats": vote(repeats < 0.1, repeats > 0.3),
        "capitals": vote(capitals < 0.1, capitals > 0.4),
        "word_length": vote((length > 3) & (length < 10), (length < 2) | (length > 14)),
        "lines": vote(lines < 0.1, lines > 0.5),
        "variety": F.when(n < 20, 0).otherwise(vote(variety > 0.3, variety < 0.1)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, dict]:
    """Posterior of good for each vote pattern, by expectation-maximisation.

    ``patterns``: rows of votes. Given the class, rules vote independently. The
    start takes a document that some rule calls bad for a likely bad one; that
    fixes which class is the good one, and the rounds then decide how much each
    rule's vote is worth."""
    weight = counts / max(1, counts.sum())
    good = np.where((patterns < 0).any(1), 0.2, np.where((patterns > 0).any(1), 0.95, 0.5))
    options = np.array([-1, 0, 1])
    hit = patterns[:, :, None] == options  # pattern, rule, vote
    prior = {1: np.array([0.05, 0.3, 0.65]), 0: np.array([0.3, 0.3, 0.4])}
    strength = 1e-3
    for _ in range(rounds):
        share = float((weight * good).sum())
        share = min(max(share, 1e-3), 1 - 1e-3)
        chance = {}
        for c, belongs in ((1, good), (0, 1 - good)):
            mass = (weight * belongs)[:, None, None]
            chance[c] = ((mass * hit).sum(0) + strength * prior[c]) / ((weight * belongs).sum() + strength)
        logs = {c: np.where(hit, np.log(chance[c]), 0).sum((1, 2)) for c in (0, 1)}
        odds = np.log(share / (1 - share)) + logs[1] - logs[0]
        new = 1 / (1 + np.exp(-odds.clip(-50, 50)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return good, {"share": share, "chance": chance}


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, counts, base_failed, posterior, kept) per document."""
    spark = docs.sparkSession
    ship_code(spark)
    spec = "doc long, " + ", ".join(f"{c} long" for c in COUNTS)
    counts = keep(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(_measure, spec),
                  "quality")
    pattern = F.lit(0)
    for rule in votes().values():
        pattern = pattern * 3 + rule + 1
    voted = counts.withColumn("pattern", pattern.cast("int"))
    rows = voted.groupBy("pattern").count().collect()  # 3**rules at most
    ids = [r[0] for r in rows]
    digits = np.array([[i // 3 ** k % 3 - 1 for k in reversed(range(len(RULES)))] for i in ids]).reshape(-1, len(RULES))
    good, _ = estimate(digits, np.array([r[1] for r in rows], float)) if ids else (np.zeros(0), {})
    table = spark.createDataFrame([(int(i), float(g)) for i, g in zip(ids, good)], "pattern int, posterior double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (voted.join(F.broadcast(table), "pattern").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))
            .select(F.col("doc").alias(id_col), *COUNTS, "base_failed", "posterior", "kept"))
