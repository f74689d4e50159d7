"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>) over the terms of a document. The factors v learn pairs, such as an
insult next to a group's name, which additive weights miss. Terms are the words of the whole text after lower-casing
A-Z and blanking ASCII punctuation, and their beginnings of ``STEMS`` bytes (marked as such), hashed by CRC-32.

The fit uses at most ``FIT_ROWS`` labelled rows, the first by a hash of doc_id (a documented bound), and all their terms,
each in one of ``BUCKETS`` buckets. One task reads the rows' distinct buckets, four bytes each, and fits; what reaches the
driver is the fitted machine. No term is chosen beforehand: an L1 penalty draws weights that few rows support to 0. The
weights are fitted first, the factors then on what the weights leave. The penalty of a weight grows with the root of the rows, that of a factor with
the root of their terms, as the noise of their sums does. Scoring reads every text in Arrow batches. Defined results: null or empty text gets the
score of the bias alone, very long texts are scored whole; rows that repeat are scored each; of labels that repeat a doc_id the
largest counts; without both labels in the fit every score is the observed rate (0 without rows); terms that share a bucket
are one term; columns of other names pass unread. Labels, lang, source and doc_id are no inputs.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm import common
from cohortkit.llm.common import pieces

FIT_ROWS = 16_000
BUCKETS, FACTORS = 1 << 20, 6
BATCH, SEED = 64, 7
STEPS, RATE, FACTOR_RATE, START = 800, 0.1, 0.05, 0.05  # steps of each part at least, whole passes; factors start at START x normal
L1, FACTOR_L1, SHRINK = 0.09, 0.02, 8  # times the root of the rows, for factors also of their terms; applied every SHRINK steps
L2 = 1e-4
TOXIC_WEIGHT = 4.0  # a missed toxic row costs as much as so many clean rows that are taken for toxic
STEMS = (4, 5, 6)
MEMO = 200_000
SLICE = 1 << 16
CLEAN = bytes.maketrans((string.ascii_uppercase + string.punctuation).encode(), (string.ascii_lowercase + " " * len(string.punctuation)).encode())


def words(text: bytes) -> set[bytes]:
    return set(text.translate(CLEAN).split())


def word_hashes(word: bytes) -> list[int]:
    """Buckets of a word and its stems; a stem ends in a blank, so that it differs from the word of its letters."""
    return [h % BUCKETS for h in (zlib.crc32(word), *[zlib.crc32(word[:n] + b" ") for n in STEMS if len(word) >= n])]


def hashed(text: bytes) -> np.ndarray:
    """Distinct buckets of the terms."""
    return np.array(sorted({h for w in words(text) for h in word_hashes(w)}), np.uint32)


class Machine:
    """Bias, weights and factors of the buckets ``ids`` (sorted)."""

    def __init__(self, ids: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.ids, self.bias, self.w, self.v = ids, bias, w, v

    def row(self) -> dict:
        return {"ids": self.ids.tobytes(), "bias": float(self.bias), "w": self.w.tobytes(), "v": self.v.tobytes()}

    @classmethod
    def of(cls, row: dict) -> Machine:
        return cls(np.frombuffer(row["ids"], np.uint32), row["bias"], np.frombuffer(row["w"]), np.frombuffer(row["v"]).reshape(-1, FACTORS))

    def scorer(self) -> Callable[[bytes], float]:
        at = {int(x): i for i, x in enumerate(self.ids)}
        vv = (self.v ** 2).sum(1)
        memo: dict[bytes, list[int]] = {}

        def score(text: bytes) -> float:
            if len(memo) > MEMO:
                memo.clear()
            hit = set()
            for word in words(text):
                known = memo.get(word)
                if known is None:
                    known = memo[word] = [at[h] for h in word_hashes(word) if h in at]
                if known:
                    hit.update(known)
            z = self.bias
            if hit:
                i = np.fromiter(sorted(hit), np.int64, len(hit))
                s = self.v[i].sum(0)
                z += self.w[i].sum() + 0.5 * (s @ s - vv[i].sum())
            return float(1 / (1 + np.exp(-min(max(z, -35.0), 35.0))))

        return score


def batches_of(docs: list[np.ndarray], labels: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """The buckets that the sets hold, and the batches: labels, terms (places in the buckets), the row of each, and the
    same rows by term with the distinct terms and where each begins."""
    seen = np.zeros(BUCKETS, bool)
    for d in docs:
        seen[d] = True
    ids = np.flatnonzero(seen).astype(np.uint32)
    place = np.cumsum(seen, dtype=np.int32) - 1
    out = []
    for lo in range(0, len(order), BATCH):
        b = order[lo: lo + BATCH]
        at = place[np.concatenate([docs[i] for i in b])]
        own = np.repeat(np.arange(len(b), dtype=np.uint8), [len(docs[i]) for i in b])
        by = np.argsort(at, kind="stable")
        terms, first = np.unique(at[by], return_index=True)
        out.append((labels[b], at, own, own[by], terms, first.astype(np.int32)))
    return ids, out


def loss_slope(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The slope of the weighted mean logistic loss at ``z``."""
    return (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) * np.where(y > 0, TOXIC_WEIGHT, 1) / len(y)


def margins(batch: tuple[np.ndarray, ...], bias: float, w: np.ndarray, v: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The machine's value of each row before the sigmoid, and the rows' sums of factors (None without factors)."""
    y, at, own = batch[:3]
    z = bias + np.bincount(own, w[at], len(y))
    if v is None:
        return z, None
    va = v[at]
    s = np.stack([np.bincount(own, va[:, k], len(y)) for k in range(v.shape[1])], 1)
    return z + 0.5 * ((s ** 2).sum(1) - np.bincount(own, (va ** 2).sum(1), len(y))), s


def slopes(batch: tuple[np.ndarray, ...], g: np.ndarray, s: np.ndarray | None, v: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The loss's slopes by the weights and the factors of the batch's terms, given its slopes ``g`` by the rows' values."""
    rows, terms, first = batch[3:]
    if not len(terms):
        return np.zeros(0), None if v is None else np.zeros((0, v.shape[1]))
    dw = np.add.reduceat(g[rows], first)
    return dw, None if v is None else np.add.reduceat((g[:, None] * s)[rows], first) - dw[:, None] * v[terms]


def shrunk(x: np.ndarray, by: np.float64, g: np.ndarray) -> np.ndarray:
    """``x`` drawn to 0 by ``by / sqrt(g)``, in place once it has doubles, ``SLICE`` rows at a time: the arrays on the way are small."""
    x = x.astype(float, copy=False)
    for lo in range(0, len(x), SLICE):
        a = x[lo: lo + SLICE]
        a[:] = np.sign(a) * np.maximum(np.abs(a) - by / np.sqrt(g[lo: lo + SLICE]), 0)
    return x


def fit(docs: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Trains on sets of buckets; buckets that no set holds are not in the machine, nor are those that end without weight and factors."""
    n, n1 = len(labels), int(labels.sum())
    if not n or n1 in (0, n):
        rate = n1 / n if n else 0.0
        return Machine(np.zeros(0, np.uint32), 35.0 * np.sign(rate - 0.5), np.zeros(0), np.zeros((0, FACTORS)))
    r = np.random.default_rng(SEED)
    ids, batches = batches_of(docs, labels, r.permutation(n))
    bias, w, gb, gw = float(np.log(n1 / (n - n1))), np.zeros(len(ids)), 1.0, np.ones(len(ids))
    v, gv = r.normal(0, START, (len(ids), FACTORS)).astype(np.float32), np.ones((len(ids), FACTORS), np.float32)
    l1, factor_l1 = L1 / np.sqrt(n), FACTOR_L1 * np.sqrt(np.mean([len(d) for d in docs]) / n)
    passes, step = -(-STEPS // len(batches)), 0
    for p in range(2 * passes):
        factors = p >= passes
        for i in r.permutation(len(batches)):
            batch, terms, step = batches[i], batches[i][4], step + 1
            z, s = margins(batch, bias, w, v if factors else None)
            g = loss_slope(z, batch[0])
            dw, dv = slopes(batch, g, s, v if factors else None)
            dw += L2 * w[terms]
            gw[terms] += dw ** 2
            w[terms] -= RATE * dw / np.sqrt(gw[terms])
            gb += g.sum() ** 2
            bias -= 0.2 * RATE * g.sum() / np.sqrt(gb)
            if factors:
                dv += L2 * v[terms]
                gv[terms] += dv ** 2
                v[terms] -= FACTOR_RATE * dv / np.sqrt(gv[terms])
            if step % SHRINK == 0:
                w = shrunk(w, SHRINK * RATE * l1, gw)
                if factors:
                    v = shrunk(v, SHRINK * FACTOR_RATE * factor_l1, gv)
    w, v = shrunk(w, SHRINK * RATE * l1, gw), shrunk(v, SHRINK * FACTOR_RATE * factor_l1, gv)
    kept = (w != 0) | (v != 0).any(1)
    return Machine(ids[kept], bias, w[kept], v[kept].astype(float))


def fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row, the machine fitted on the rows (y, ids) of a single task: the sets stay away from the driver."""
    docs, labels = [], []
    for b in batches:
        labels += b.column(0).to_pylist()
        docs += [np.frombuffer(t, np.uint32) for t in b.column(1).to_pylist()]
    if docs:
        yield pa.RecordBatch.from_pylist([fit(docs, np.array(labels, dtype=float)).row()])


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; false for a null doc_id, which no label can name."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Machine:
    """Fits on at most ``rows`` labelled, not held-out documents."""
    x = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    x = x.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("l_id"), (F.col("toxic") > 0).cast("long").alias("y"))
    sample = docs.select("doc_id", "text").join(F.broadcast(x), F.col("doc_id") == F.col("l_id"))  # at most ``rows`` ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            ids = [hashed(t).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], ["doc_id", "y", "ids"])

    sets = sample.select(F.col("doc_id").cast("long"), "y", common.utf8(F.col("text")).alias("t")) \
        .mapInArrow(run, "doc_id long, y long, ids binary").dropDuplicates(["doc_id", "ids"])
    fitted = sets.orderBy(F.xxhash64("doc_id"), "doc_id", "ids").limit(rows).select("y", "ids") \
        .mapInArrow(fit_task, "ids binary, bias double, w binary, v binary").toArrow().to_pylist()
    return Machine.of(fitted[0]) if fitted else fit([], np.zeros(0))


def with_score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    return common.add_column(docs, name, T.DoubleType(), "text", machine.scorer)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    name = common.fresh(docs, "toxicity__")
    return with_score(docs, train(docs, labels), name).filter(F.col(name) < 0.5).drop(name)
