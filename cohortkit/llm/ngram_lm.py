"""LM scoring: a bigram trie in Elias-Fano form with quantised smoothed probabilities.

Tokens are the words of a text (A-Z lower-cased) and one end; a word is known by 64 bits of its XXH64, the end by the
hash of nothing. A text is read as a ring, so the end precedes its first word and c(w) also counts w as a context. The
model is Dirichlet smoothing of pairs by single tokens,

    p(w | u) = (c(u w) + eps (c(w) + 1)) / (c(u) + eps K),   K = N + V + 1,   eps = BETA / N,

which sums to 1 over the V known words and one unknown. Its logarithm is a part that needs only w's counts and a part
that needs only u's, so the trie is cut by words into shards and nothing about a pair must travel twice.

A shard has two levels: its words, and under each word the words before it, held by the top ``ID_BITS`` bits of their
hash. The ids of both levels, the pointers from words to their ranges and the running sums of c(w) are monotone, hence
Elias-Fano sequences (high parts in unary, low parts packed); the numerators of the pairs are 8-bit codes. A query finds
the word, takes its range by the pointers and searches the successor of the context's id inside that range. The byte strings
of a shard are copied out of Arrow once a task; the low parts stay packed, the high parts are unpacked while a task queries.

Texts are cut in batches of about ``BATCH_TOKENS`` tokens. A batch sends each shard one row: its words there with their
counted pairs (training), or with their pairs and documents (scoring). Only sums for each document come back. A shard that
holds the pairs of many more tokens than others, such as that of a very common pair, is scored by several tasks. N is a count over all training texts.

A word cannot be split over shards, so a shard that would gather many entries, such as that of a very common word, is cut
into parts by equal ranges of the context's hash (``cuts``, shard to parts). Part r of shard s has the number s + r * shards
and holds every word of the shard with its whole count, and the pairs whose context falls in the range; a pair is counted and
looked up in that part alone. Which shards to cut is estimated on a random sixteenth of the texts; it changes where pairs lie, not
what they count.

Defined results: null text is empty (one token, the end); a null doc_id is not held out and counts as training text;
repeated rows are counted and scored each; without training tokens every word is unknown; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import common
from cohortkit.llm.common import pieces

ID_BITS, BATCH_TOKENS, SHARD_TOKENS, MAX_DOCS = 40, 1_250_000, 2_000_000, 1 << 16
BETA = 300.0
SPREAD = 20  # a small corpus has shards of this part of ``SHARD_TOKENS`` at least, up to the session's shuffle partitions
SAMPLE = 16  # one in so many texts tells which shards to cut
CODES = 255
END = b""


# ---- Elias-Fano sequences ----------------------------------------------------------------------------------------

class EliasFano:
    """A monotone sequence of numbers below ``universe``: packed low parts, unary high parts."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low = n, low_bits, low
        ones = np.flatnonzero(np.unpackbits(high)) if n else np.zeros(0, np.int64)
        self.high = (ones - np.arange(len(ones))).astype(np.uint64)  # bucket of each element
        buckets = int(self.high[-1]) + 2 if n else 1
        self.start = np.searchsorted(self.high, np.arange(buckets, dtype=np.uint64))  # first element of each bucket

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        n = len(values)
        bits = min(60, max(0, (universe // n).bit_length() - 1)) if n else 0
        values = values.astype(np.uint64)
        high = np.zeros(0, np.uint8)
        if n:
            top = (values >> np.uint64(bits)).astype(np.int64)
            unary = np.zeros(int(top[-1]) + n + 1, np.uint8)
            unary[top + np.arange(n)] = 1
            high = np.packbits(unary)
        parts = []
        for lo in range(0, n, 1 << 16):  # a multiple of 8 values at a time, so that pieces meet on a byte
            b = values[lo: lo + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
            parts.append(np.packbits(np.unpackbits(b, axis=1)[:, 64 - bits:]).tobytes() if bits else b"")
        low = b"".join(parts) + bytes(9)
        return b"".join((n.to_bytes(8, "little"), bits.to_bytes(8, "little"), len(low).to_bytes(8, "little"), low, high.tobytes()))

    @classmethod
    def at(cls, raw: bytes) -> EliasFano:
        n, bits, size = (int.from_bytes(raw[i: i + 8], "little") for i in (0, 8, 16))
        return cls(n, bits, np.frombuffer(raw, np.uint8, size, 24), np.frombuffer(raw, np.uint8, -1, 24 + size))

    def lows(self, i: np.ndarray) -> np.ndarray:
        """Low parts of elements ``i`` out of the packed bytes."""
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        byte, skip, out = bit >> 3, (bit & 7).astype(np.uint64), np.zeros(len(i), np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | self.low[byte + k]
        out = (out << skip) | (self.low[byte + 8] >> (np.uint64(8) - skip))  # the 64 bits from the element's first bit on
        return out >> np.uint64(64 - self.low_bits)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.high[i] << np.uint64(self.low_bits)) | self.lows(i)

    def find(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Index of the element equal to each ``x`` within [lo, hi), by search of its successor; -1 if there is none."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        x = x.astype(np.uint64)
        top = np.minimum(x >> np.uint64(self.low_bits), np.uint64(len(self.start) - 1)).astype(np.int64)
        a, b = self.start[top], self.start[np.minimum(top + 1, len(self.start) - 1)]
        inside = (x >> np.uint64(self.low_bits)) < np.uint64(len(self.start) - 1)
        a, b = (a, b) if lo is None else (np.maximum(a, lo), np.minimum(b, hi))
        b = np.maximum(a, b)
        end, want = b.copy(), x & np.uint64((1 << self.low_bits) - 1)
        todo = np.flatnonzero(a < b)
        while len(todo):  # all queries halve their range together
            mid = (a[todo] + b[todo]) >> 1
            less = self.lows(mid) < want[todo]
            a[todo[less]] = mid[less] + 1
            b[todo[~less]] = mid[~less]
            todo = todo[a[todo] < b[todo]]
        ok = inside & (a < end)
        i = np.flatnonzero(ok)
        ok[i] = self.lows(a[i]) == want[i]
        return np.where(ok, a, -1)


# ---- batches of tokens -------------------------------------------------------------------------------------------

def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are equal ranges of the hash, so a sorted list of words is cut in slices."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def short(ids: np.ndarray) -> bytes:
    """Top ``ID_BITS`` bits of each hash, as whole bytes."""
    return np.ascontiguousarray(ids.astype(">u8").view(np.uint8).reshape(-1, 8)[:, : ID_BITS // 8]).tobytes()


def long_ids(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).reshape(-1, ID_BITS // 8)
    out = np.zeros(len(b), np.uint64)
    for k in range(ID_BITS // 8):
        out = (out << np.uint64(8)) | b[:, k]
    return out


class Tokens:
    """Texts of a batch as word numbers; the numbers follow the words' hashes once ``close`` has run."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.number[END]
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.lower().split()
        ids = np.zeros(len(words) + 1, np.int32)  # the last is the end
        ids[:-1] = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.ids.append(ids)
        self.size += len(words) + 1

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted word hashes; then of each token the word, the word before it (the end before the first) and the document; tokens of each document."""
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(w) for w in self.number), np.uint64, len(self.number))
        self.number.clear()
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        lens = np.array([len(x) for x in self.ids])
        word = rank[np.concatenate(self.ids)]
        self.ids.clear()
        before = np.concatenate((word[-1:], word[:-1]))  # each text ends with the end, which so precedes the next one's first word
        return hashes[order], word, before, np.repeat(np.arange(len(lens)), lens), lens


def _batches(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple[int, Tokens, list]]:
    """(batch number, tokens, rows without the text) of the task's texts, which come last in the input columns."""
    part, seq = TaskContext.get().partitionId(), 0
    held, rows = Tokens(), []
    for b in pieces(batches):
        for *row, text in zip(*(c.to_pylist() for c in b.columns)):
            if rows and len(text) > 2 * tokens:  # a text that may hold more tokens than a batch is a batch of its own
                yield part << 24 | seq, held, rows
                held, rows, seq = Tokens(), [], seq + 1
            held.add(text)
            rows.append(row)
            if held.size >= tokens or len(rows) == MAX_DOCS:
                yield part << 24 | seq, held, rows
                held, rows, seq = Tokens(), [], seq + 1
    if rows:
        yield part << 24 | seq, held, rows


def _slices(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, first word, end) of the sorted words."""
    of = shard_of(hashes, shards)
    cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1], [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(of[a]), int(a), int(b)


def _parts(ids: np.ndarray, first: np.ndarray, words: int, shard: int, shards: int, cuts: dict[int, int]) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray]]:
    """(part number, its pairs, pairs of each word) of the pairs of a shard's ``words``, given by context hash and word number."""
    k = cuts.get(shard, 1)
    if k == 1:
        yield shard, slice(None), np.bincount(first, minlength=words)
        return
    of = shard_of(ids, k)
    for r in range(k):
        mine = np.flatnonzero(of == r)
        yield shard + r * shards, mine, np.bincount(first[mine], minlength=words)


# ---- training ----------------------------------------------------------------------------------------------------

SENT = "shard int, words binary, pairs binary, ids binary, counts binary, totals binary"
TRIE = "shard int, words binary, starts binary, sums binary, ids binary, codes binary, low double, step double, n_words long, n_tokens long, entries long, load long"


def count_pairs(batches: Iterator[pa.RecordBatch], shards: int, tokens: int, cuts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """One row for each batch and shard or part: its words, how many pairs each has, the pairs' contexts and counts; of a part also the counts of the words."""
    names = ["shard", "words", "pairs", "ids", "counts", "totals"]
    for _, held, _ in _batches(batches, tokens):
        hashes, word, before, _, _ = held.close()
        pair, n = np.unique(word * len(hashes) + before, return_counts=True)
        del word, before
        first, second = pair // len(hashes), pair % len(hashes)
        ends = np.searchsorted(first, np.arange(len(hashes) + 1))
        rows: list[list] = [[] for _ in names]
        for shard, a, b in _slices(hashes, shards):
            lo, hi = ends[a], ends[b]
            ids, counts, of = hashes[second[lo:hi]], n[lo:hi], first[lo:hi] - a
            totals = np.bincount(of, counts, b - a).astype(np.int64).tobytes() if shard in cuts else b""
            for part, mine, pairs in _parts(ids, of, b - a, shard, shards, cuts):
                for c, v in zip(rows, (part, hashes[a:b].tobytes(), pairs.astype(np.uint32).tobytes(), short(ids[mine]), counts[mine].astype(np.uint32).tobytes(), totals)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *[pa.array(c, pa.binary()) for c in rows[1:]]], names)


def build_shard(rows: pa.Table, eps: float, shards: int) -> pa.Table:
    """The trie shard, or part of one, that the batches' counts add up to."""
    shard = rows["shard"][0].as_py()
    words = [np.frombuffer(x, np.uint64) for x in rows["words"].to_pylist()]
    every = np.unique(np.concatenate(words))
    at = np.concatenate([np.repeat(np.searchsorted(every, w), np.frombuffer(p, np.uint32)) for w, p in zip(words, rows["pairs"].to_pylist())])
    key = (at.astype(np.uint64) << np.uint64(ID_BITS)) | np.concatenate([long_ids(x) for x in rows["ids"].to_pylist()])
    n = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["counts"].to_pylist()])
    del at
    order = np.argsort(key)
    entries, key, n = len(key), key[order], n[order].astype(np.int64)
    del order
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if entries else np.zeros(0, np.int64)
    key, n = key[new], np.add.reduceat(n, new) if entries else n
    of = (key >> np.uint64(ID_BITS)).astype(np.int64)
    single = np.bincount(of, n, len(every)).astype(np.int64)
    totals = rows["totals"].to_pylist()
    if any(totals):  # a part holds some pairs of its words only
        single = np.zeros(len(every), np.int64)
        for w, t in zip(words, totals):
            single[np.searchsorted(every, w)] += np.frombuffer(t, np.int64)
    value = np.log10(n + eps * (single[of] + 1))
    low, high = (float(value.min()), float(value.max())) if entries else (0.0, 0.0)
    step = max((high - low) / CODES, 1e-9)
    starts, sums = np.searchsorted(of, np.arange(len(every) + 1)), np.concatenate(([0], np.cumsum(single)))
    return pa.table({
        "shard": pa.array([shard], pa.int32()), "words": [EliasFano.encode(every, 1 << 64)],
        "starts": [EliasFano.encode(starts, len(key) + 1)], "sums": [EliasFano.encode(sums, int(sums[-1]) + 1)],
        "ids": [EliasFano.encode(key, len(every) << ID_BITS)], "codes": [np.rint((value - low) / step).astype(np.uint8).tobytes()],
        "low": [low], "step": [step], "n_words": [len(every) if shard < shards else 0], "n_tokens": [int(sums[-1]) if shard < shards else 0], "entries": [entries], "load": [int(n.sum())]})


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 7 is 2; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


class Model:
    """A stored trie with its totals."""

    def __init__(self, trie: DataFrame, shards: int, n: int, eps: float, cuts: dict[int, int]):
        self.trie, self.shards, self.n, self.eps, self.cuts = trie, shards, n, eps, cuts
        self.v = trie.agg(F.sum("n_words").alias("v")).first()["v"] or 0
        # tasks of the shards (or parts) that are asked for many more tokens than the usual one, such as those of very common pairs
        k = F.when(F.col("load") > 2 * SHARD_TOKENS, F.ceil(F.col("load") / SHARD_TOKENS)).otherwise(1).cast("int")
        self.salts = {r["shard"]: r["k"] for r in trie.select("shard", k.alias("k")).filter("k > 1").collect()}


def plan_cuts(texts: DataFrame, shards: int, shard_tokens: int, batch_tokens: int) -> dict[int, int]:
    """Parts of the shards that would gather more than 2 * ``shard_tokens`` entries, as a random part of the texts (column t) suggests."""
    sent = texts.filter(F.rand(7) < 1 / SAMPLE).mapInArrow(lambda b: count_pairs(b, shards, batch_tokens, {}), SENT)
    size = sent.select("shard", (F.octet_length("counts") / 4).alias("n")).groupBy("shard").agg((F.sum("n") * SAMPLE).alias("n"))
    return {r["shard"]: r["k"] for r in size.select("shard", F.ceil(F.col("n") / (2 * shard_tokens)).cast("int").alias("k")).filter("k > 1").collect()}


def train(texts: DataFrame, shard_tokens: int = SHARD_TOKENS, batch_tokens: int = BATCH_TOKENS, beta: float = BETA, cuts: dict[int, int] | None = None) -> Model:
    """The model of the texts (column text), as a table in the shared folder with one row per shard, or part of a cut shard."""
    n = texts.agg(F.sum(common.word_count(F.col("text")) + 1)).first()[0] or 0
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards, eps = max(1, -(-n // shard_tokens), min(partitions, -(-n * SPREAD // shard_tokens))), beta / max(n, 1)
    texts = texts.select(common.utf8(F.col("text")).alias("t"))
    if cuts is None:  # no shard gathers more entries than there are tokens
        cuts = plan_cuts(texts, shards, shard_tokens, batch_tokens) if n > 2 * shard_tokens else {}
    sent = texts.mapInArrow(lambda b: count_pairs(b, shards, batch_tokens, cuts), SENT)
    trie = common.stored(sent.groupBy("shard").applyInArrow(lambda t: build_shard(t, eps, shards), TRIE), "trie")
    return Model(trie, shards, n, eps, cuts)


# ---- scoring -----------------------------------------------------------------------------------------------------

ASK = "shard int, salt int, batch long, words binary, pairs binary, ids binary, docs_of binary, docs binary, counts binary"
BACK = "batch long, docs binary, known binary, base binary, score binary, ids binary"


def ask(batches: Iterator[pa.RecordBatch], shards: int, cuts: dict[int, int], salts: dict[int, int], tokens: int) -> Iterator[pa.RecordBatch]:
    """One row for each batch and shard (words, their contexts, the documents of each pair), and one with the batch's documents.

    The latter goes to a shard number below 0, which has no trie, and so to the sums as it is.
    """
    schema = pa.schema([("shard", pa.int32()), ("salt", pa.int32()), ("batch", pa.int64()), *[(c, pa.binary()) for c in ("words", "pairs", "ids", "docs_of", "docs", "counts")]])
    for batch, held, rows in _batches(batches, tokens):
        hashes, word, before, doc, lens = held.close()
        docs = len(lens)
        key, n = np.unique((word * len(hashes) + before) * docs + doc, return_counts=True)
        del word, before, doc
        pair, of_doc = key // docs, (key % docs).astype(np.uint16)
        new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        docs_of, pair = np.diff(np.concatenate((new, [len(key)]))), pair[new]
        first, second = pair // len(hashes), pair % len(hashes)
        ends, edge = np.searchsorted(first, np.arange(len(hashes) + 1)), np.concatenate((new, [len(key)]))
        out = [(-1 - batch % 997, 0, batch, np.array([r[0] if r[0] is not None else 0 for r in rows], np.int64).tobytes(),
                np.array([r[0] is None for r in rows], np.uint8).tobytes(), lens.astype(np.int64).tobytes(), np.array([bool(r[1]) for r in rows], np.uint8).tobytes(), b"", b"")]
        for shard, a, b in _slices(hashes, shards):
            lo, hi = ends[a], ends[b]
            x, y = edge[lo], edge[hi]
            ids, many, its_docs, counts = hashes[second[lo:hi]], docs_of[lo:hi], of_doc[x:y], n[x:y]
            for part, mine, pairs in _parts(ids, first[lo:hi] - a, b - a, shard, shards, cuts):
                if part != shard or shard in cuts:  # the documents of the part's pairs
                    inside = np.zeros(len(ids), bool)
                    inside[mine] = True
                    inside = np.repeat(inside, many)
                else:
                    inside = slice(None)
                out.append((part, batch % salts.get(part, 1), batch, hashes[a:b].tobytes(), pairs.astype(np.uint32).tobytes(), short(ids[mine]),
                            many[mine].astype(np.uint32).tobytes(), its_docs[inside].tobytes(), counts[inside].astype(np.uint32).tobytes()))
        for lo in range(0, len(out), 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[lo: lo + 16]), schema)], schema=schema)


def answer(asked: pa.Table, trie: pa.Table, eps: float, k: float) -> pa.Table:
    """Sums of each document over the tokens that belong to one shard."""
    schema = pa.schema([("batch", pa.int64()), *[(c, pa.binary()) for c in ("docs", "known", "base", "score", "ids")]])
    rows = asked.to_pylist()
    if rows and rows[0]["shard"] < 0:
        return pa.Table.from_pylist([{"batch": r["batch"], "docs": r["pairs"], "known": r["ids"], "base": r["docs_of"], "score": None, "ids": r["words"]} for r in rows], schema=schema)
    t = trie.to_pylist()[0] if trie.num_rows else None
    if t:
        words, starts, sums, ids = (EliasFano.at(t[c]) for c in ("words", "starts", "sums", "ids"))
        codes = np.frombuffer(t["codes"], np.uint8)
    out = []
    for r in rows:
        hashes, pairs = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["pairs"], np.uint32)
        single, at = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int64)
        if t:
            at = words.find(hashes)
            i = at[at >= 0]
            single[at >= 0] = (sums.get(i + 1) - sums.get(i)).astype(np.int64)
        of = np.repeat(np.arange(len(hashes)), pairs)  # word of each pair
        top = np.log10(eps * (single[of] + 1))
        seen = np.flatnonzero(at[of] >= 0)
        if t and len(seen):
            a = at[of[seen]]
            key = (a.astype(np.uint64) << np.uint64(ID_BITS)) | long_ids(r["ids"])[seen]
            hit = ids.find(key, starts.get(a).astype(np.int64), starts.get(a + 1).astype(np.int64))
            got = hit >= 0
            top[seen[got]] = t["low"] + t["step"] * codes[hit[got]]
        value = top - np.log10(single[of] + eps * k)
        docs_of = np.frombuffer(r["docs_of"], np.uint32)
        n, doc = np.frombuffer(r["counts"], np.uint32).astype(np.float64), np.frombuffer(r["docs"], np.uint16)
        mine, back = np.unique(doc, return_inverse=True)
        add = lambda v: np.bincount(back, n * np.repeat(v, docs_of), len(mine))
        out.append({"batch": r["batch"], "docs": mine.tobytes(), "known": add((single > 0)[of]).astype(np.uint32).tobytes(),
                    "base": add(np.log10(single + 1)[of]).tobytes(), "score": add(value).astype(np.float32).tobytes(), "ids": None})
    return pa.Table.from_pylist(out, schema=schema)


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def collect(rows: pa.Table, k: float) -> pa.Table:
    """The documents of one batch from the sums of all shards."""
    parts = rows.to_pylist()
    own = next(p for p in parts if p["ids"] is not None)
    doc_id, n = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["known"], np.int64)
    null, held = np.frombuffer(own["docs"], np.uint8).astype(bool), np.frombuffer(own["base"], np.uint8).astype(bool)
    known, base, score = np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
    for p in sorted((p for p in parts if p["ids"] is None), key=lambda p: (p["docs"], p["base"])):  # same order on every run
        d = np.frombuffer(p["docs"], np.uint16)
        known[d] += np.frombuffer(p["known"], np.uint32)
        base[d] += np.frombuffer(p["base"], np.float64)
        score[d] += np.frombuffer(p["score"], np.float32)
    return pa.table({"doc_id": pa.array(doc_id, mask=null), "held_out": held, "n_tokens": n, "n_known": known, "base_score": base - n * math.log10(k), "score": score})


def score(docs: DataFrame, model: Model, held: Column, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """doc_id, held_out (``held`` as given), n_tokens, n_known, train_tokens, base_score and score of every document."""
    shards, cuts, salts, eps, k = model.shards, model.cuts, model.salts, model.eps, model.n + model.v + 1
    asked = docs.select(F.col("doc_id").cast("long"), held, common.utf8(F.col("text")).alias("t")).mapInArrow(lambda b: ask(b, shards, cuts, salts, batch_tokens), ASK)
    times = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]), F.col("shard")), F.lit(1)) if salts else F.lit(1)
    trie = model.trie.withColumn("salt", F.explode(F.sequence(F.lit(0), times - 1)))
    back = asked.groupBy("shard", "salt").cogroup(trie.groupBy("shard", "salt")).applyInArrow(lambda a, t: answer(a, t, eps, k), BACK)
    return back.groupBy("batch").applyInArrow(lambda t: collect(t, k), OUT).withColumn("train_tokens", F.lit(model.n).cast("long"))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and scores all."""
    held = held_out(F.col("doc_id"))
    return score(docs, train(docs.filter(~held)), held)
