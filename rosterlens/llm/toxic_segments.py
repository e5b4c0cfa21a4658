"""Toxicity by maximum-scoring segments.

A token's score is its log-odds between toxic and clean labelled documents
under a Dirichlet prior at the corpus rate, less its standard error; a token
the table lacks scores by its beginning (first 6, 5 or 4 bytes), so new forms
of a known stem score too. Every occurrence of a token counts. A drift makes
ordinary text score below zero. A linear scan (Ruzzo and Tompa) finds all
maximal segments of positive total in a document. Clean labelled
documents that the table has not seen give the extreme-value law of segment
totals (decay rate and frequency a token); by it a segment total becomes its
surplus over what a clean document of that length shows by chance, and the
surpluses of the significant segments add up. A logistic curve fitted on the
same unseen rows turns the sum into a probability.

Training uses at most ``train_rows`` labelled documents (by hash order of the
id) whose crc32(id) mod 3 is not 1, and keeps at most ``TABLE_ROWS`` forms;
surpluses over ``MOST`` count as that in the curve. Label, language, source and id are inputs
of no score. Scoring covers every whole text.

Defined results: null and empty texts score as a text without findings; rows
without, with null or with contradicting labels train nothing (a document
labelled twice counts as toxic if one label says so); equal rows score alike;
null ids stay, not held out; very long texts are scanned whole, and chance
grows with their length; other columns may have any names; an empty table gives
an empty result; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.textnum import MULTIPLIERS, NOT_ALNUM, U, Words, blocks, mix, text_buffers
from rosterlens.llm.work import keep, lean, ship_code

BLOCK_BYTES = 1_000_000
TRAIN_ROWS = 30_000
BEGINNINGS = (6, 5, 4)  # bytes of a token that stand for it where it is not known
DRIFT = 0.3
STRENGTH = 2.0  # documents' worth of the Dirichlet prior
LEAST = 1.0  # log-odds of a table entry
MOST = 30.0  # surplus beyond which the curve is flat
TABLE_ROWS = 1_000_000  # forms in the table at most, the largest log-odds first (ties by hash)
UNIT = "decimal(38,9)"  # segment totals are added up exactly, in any order


def _levels(words: Words) -> list[np.ndarray]:
    """Hashes of each token, then of its beginnings (0 where it is no longer than that)."""
    whole, *begun = words.hash_lists([None, *BEGINNINGS])
    out = [whole]
    size = words.end - words.start
    for n, h in zip(BEGINNINGS, begun):
        out.append(np.where(size > n, mix(h ^ (MULTIPLIERS[2] >> U(n))), U(0)))
    return out


def _count(batches):
    """(hash, toxic documents, clean documents) of the tokens and beginnings of a batch."""
    for batch in batches:
        data, bounds = text_buffers(batch.column(0))
        toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)
        parts = []
        for i, j in blocks(bounds, BLOCK_BYTES):
            words = Words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], NOT_ALNUM)
            for k, h in enumerate(_levels(words)):
                doc = words.doc[h != 0]
                h = h[h != 0]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                parts.append((h[new], toxic[i + doc[new]]))
        if not parts:
            continue
        h = np.concatenate([p[0] for p in parts])
        t = np.concatenate([p[1] for p in parts])
        keys, number = np.unique(h, return_inverse=True)
        yes = np.bincount(number, t, len(keys)).astype(np.int64)
        all_ = np.bincount(number, minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(yes), pa.array(all_ - yes)], ["h", "yes", "no"])


def maximal_segments(scores) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, total) in linear time."""
    found: list[list] = []  # first, end, sum before it, sum up to its end
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        part = [i, i + 1, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= part[2]:
                j -= 1
            if j < 0 or found[j][3] >= part[3]:
                found.append(part)
                break
            part = [found[j][0], part[1], found[j][2], part[3]]
            del found[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in found]


class Scorer:
    """Tables of a fitted model, as sorted arrays, and the law of chance segments."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray, rate: float = 1.0, frequency: float = 0.0):
        self.keys, self.scores, self.rate, self.frequency = keys, scores, rate, frequency

    def tokens(self, words: Words) -> np.ndarray:
        """Score of each token: the first of its forms that the table has, less the drift."""
        out = np.full(len(words), -DRIFT)
        if not len(self.keys):
            return out
        open_ = np.ones(len(words), bool)
        for h in _levels(words):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = open_ & (self.keys[at] == h)
            out[hit] = self.scores[at[hit]] - DRIFT
            open_ &= ~hit
        return out

    def segments(self, data: np.ndarray, bounds: np.ndarray):
        """(document, its tokens, [(first byte, end byte, total)]) where there are any."""
        words = Words(data, bounds, NOT_ALNUM)
        scores = self.tokens(words)
        up = np.flatnonzero(scores > 0)
        sums = np.append(0, np.cumsum(scores))
        for d in np.unique(words.doc[up]).tolist():
            a, b = int(words.first[d]), int(words.first[d + 1])
            at = up[np.searchsorted(up, a):np.searchsorted(up, b)]
            # between positive tokens, one negative total stands for the run of others
            steps = np.empty(2 * len(at))
            steps[1::2] = scores[at]
            steps[0::2] = sums[at] - sums[np.append(a, at[:-1] + 1)]
            yield d, b - a, [(int(words.start[at[i // 2]] - bounds[d]), int(words.end[at[(j - 1) // 2]] - bounds[d]), total)
                             for i, j, total in maximal_segments(steps.tolist())]

    def documents(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        """Surplus of each document, and its significant segments (start, stop, surplus)."""
        surplus = np.zeros(len(bounds) - 1)
        spans: list = [[] for _ in surplus]
        for d, n, found in self.segments(data, bounds):
            chance = math.log(1 + self.frequency * n)
            for start, stop, total in found:
                gain = self.rate * total - chance
                if gain > 0:
                    surplus[d] += gain
                    spans[d].append((start, stop, gain))
        return surplus, spans


def _fit_table(rows: DataFrame, yes: int, no: int) -> tuple[np.ndarray, np.ndarray]:
    """Forms of at least two toxic documents with log-odds, less the standard error, of ``LEAST`` or more."""
    p = yes / (yes + no)
    counted = rows.mapInArrow(lean(_count), "h long, yes long, no long").groupBy("h").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    a, b = F.col("yes") + STRENGTH * p, F.col("no") + STRENGTH * (1 - p)
    odds = F.log(a / (yes + STRENGTH)) - F.log(b / (no + STRENGTH)) - F.sqrt(1 / a + 1 / b)
    table = counted.where("yes > 1").withColumn("odds", odds).where(F.col("odds") >= LEAST).select("h", "odds")
    found = table.orderBy(F.desc("odds"), "h").limit(TABLE_ROWS).toPandas()
    keys = found["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found["odds"].to_numpy(float)[order]


def _observe(model: tuple):
    """Per calibration document: label, tokens, totals of its segments."""
    kind = pa.schema([("label", pa.int64()), ("n", pa.int64()), ("totals", pa.list_(pa.float64()))])

    def run(batches):
        scorer = Scorer(*model)
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            label = batch.column(1).to_pylist()
            n, totals = [0] * len(label), [[] for _ in label]
            for i, j in blocks(bounds, BLOCK_BYTES):
                part = data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
                n[i:j] = Words(*part, NOT_ALNUM).count.tolist()
                for d, _, found in scorer.segments(*part):
                    totals[i + d] = [x[2] for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((label, n, totals), kind)], schema=kind)
    return run


def _chance_law(seen: DataFrame) -> tuple[float, float]:
    """Decay rate and frequency a token of segment totals in clean documents:
    beyond the smallest total they fall off exponentially."""
    clean = seen.where("label = 0")
    tokens = int(clean.agg(F.sum("n")).first()[0] or 0)
    total = clean.select(F.explode("totals").alias("t")).select(F.col("t").cast(UNIT).alias("t"))
    n, mean, least = total.agg(F.count("t"), F.sum("t") / F.count("t"), F.min("t")).first()
    if n < 10:
        return 1.0, (n + 1) / max(1, tokens)
    rate = min(max(1 / max(1e-9, float(mean) - float(least)), 0.5), 2.0)
    return rate, n * math.exp(rate * float(least)) / max(1, tokens)


def _scored(model: tuple, curve: tuple | None, spans: bool):
    names = ["doc", "score"] + ["spans"] * spans

    def run(batches):
        scorer = Scorer(*model)
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            surplus, found = [np.zeros(0)], []
            for i, j in blocks(bounds, BLOCK_BYTES):
                s, f = scorer.documents(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
                surplus.append(s)
                found += f
            x = np.concatenate(surplus)
            score = np.zeros(len(x)) if curve is None else 1 / (1 + np.exp(-(curve[0] + curve[1] * np.minimum(x, MOST))))
            out = [batch.column(0), pa.array(score)]
            if spans:
                out.append(pa.array([[dict(zip(("start", "stop", "surplus"), x)) for x in f] for f in found],
                                    pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("surplus", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(out, names)
    return run


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression in one variable, by Newton's steps with a weak prior."""
    w = np.zeros(2)
    design = np.stack([np.ones(len(x)), np.minimum(x, MOST)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(design @ w).clip(-30, 30)))
        grad = design.T @ (y - p) - 1e-2 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(0.0, w[1]))


def held_out(column) -> F.Column:
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train_rows: int = TRAIN_ROWS) -> tuple[tuple, tuple | None]:
    """Token table, decay rate and curve from at most ``train_rows`` labelled documents."""
    ship_code(docs.sparkSession)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).where(~held_out(F.col(id_col)))
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    known = known.select(F.col(id_col).alias("doc"), "label")
    sample = known.orderBy(F.xxhash64("doc"), "doc").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = keep(texts.join(F.broadcast(sample), "doc").select(
        "text", F.col("label").cast("long").alias("label"),
        (F.pmod(F.xxhash64("doc", F.lit(5)), F.lit(3)) == 0).alias("calibrate")), "train")
    n = {(r[0], r[1]): r[2] for r in rows.groupBy("calibrate", "label").count().collect()}
    empty = np.zeros(0, np.uint64), np.zeros(0)
    if not n.get((False, 1)) or not n.get((False, 0)):
        return empty, None
    table = _fit_table(rows.where("not calibrate").select("text", "label"), n[False, 1], n[False, 0])
    seen = keep(rows.where("calibrate").select("text", "label").mapInArrow(
        lean(_observe(table)), "label long, n long, totals array<double>"), "observed")
    rate, frequency = _chance_law(seen)
    chance = F.log(1 + frequency * F.col("n"))
    surplus = F.aggregate("totals", F.lit(0.0), lambda a, t: a + F.greatest(F.lit(0.0), rate * t - chance))
    # two numbers for each of at most train_rows documents
    points = sorted(tuple(r) for r in seen.select(surplus, F.col("label").cast("double")).collect())
    x, y = np.array(points, float).reshape(-1, 2).T
    if y.min(initial=1) == y.max(initial=0):  # too few rows to calibrate on
        return (*table, rate, frequency), (-2.0, 1.0)
    return (*table, rate, frequency), _curve(x, y)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             train_rows: int = TRAIN_ROWS, spans: bool = False, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted[, spans]) for every row of ``docs``."""
    model, curve = fit(docs, labels, id_col, text_col, label_col, train_rows)
    spec = "doc long, score double" + ", spans array<struct<start:long,stop:long,surplus:double>>" * spans
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        lean(_scored(model, curve, spans)), spec)
    return rows.select(F.col("doc").alias(id_col), held_out(F.col("doc")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"), *["spans"] * spans)


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  train_rows: int = TRAIN_ROWS, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept. A
    row is scored where it stands, so no text is shuffled."""
    model, curve = fit(docs, labels, id_col, text_col, label_col, train_rows)

    place = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(*model)
        for batch in batches:
            data, bounds = text_buffers(batch.column(place))
            surplus = [scorer.documents(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])[0]
                       for i, j in blocks(bounds, BLOCK_BYTES)]
            x = np.concatenate([np.zeros(0), *surplus])
            score = np.zeros(len(x)) if curve is None else 1 / (1 + np.exp(-(curve[0] + curve[1] * np.minimum(x, MOST))))
            yield batch.filter(pa.array(score < threshold))
    # by place: names with dots would be taken for fields
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return rows.mapInArrow(lean(run), rows.schema).toDF(*docs.columns)
