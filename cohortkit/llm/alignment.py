"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A byte-level BPE (A, over space + text) and a piece BPE with byte fallback (B, which adds the space) cut the same bytes.
Character offsets of A and the spans of B's proto give coarse cuts. Where tokens share a character, as pieces of a multibyte
character and byte-fallback tokens do, the lengths of their decoded bytes refine the cuts inside it. Byte offsets at which
tokens of both end cut the text into groups; tokens whose byte ranges overlap are linked.

Both tokenizers cut in front of a single blank between non-blanks, of a line break between non-blanks, and of a mark such as
a full stop behind a Latin letter: A's pattern ends a word there, and no piece of B goes over such a place. What lies between
two such cuts (a unit) is tokenized once and remembered by its worker, new units of many texts together. Tokens, groups and
links of a text are those of its units.

A pair's count is the number of documents in which it is linked. A task gives one row for each batch of some ``BATCH_LINKS``
links: distinct pairs with their documents, and for each document its units. The pairs meet their corpus-wide counts in
a join of (batch, pair) rows, and the answers go back to the batches, which are bounded, so that no text is read twice.

Defined results: texts that are null or empty, or whose tokens do not give back their bytes (U+2581 in a text, broken UTF-8),
have no tokens: zeros and ''. Rows that repeat a document count as documents of their own; very long texts are whole, a batch
then holds one; of pairs that tie for an A id's highest count each is best; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm import common
from cohortkit.llm.common import pieces

FOLDER, A_FILE, B_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH_LINKS, REMEMBERED, REMEMBERED_BYTES = 1_000_000, 400_000, 128 << 20
# Where both tokenizers cut: in front of a single blank, of a line break between non-blanks, and of a mark behind a Latin letter.
CUT = re.compile(r"(?<=\S)(?= [^ ])|(?<=\S)(?=\n\S)|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,;:!?])")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
BATCHES = ("batch long, docs binary, missing binary, per_doc binary, shas binary, doc_ptr binary, unit_of binary, times binary, "
           "unit_ptr binary, pair_of binary, pairs array<long>, pair_docs array<int>")
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Cuts(NamedTuple):
    """Token ids of both tokenizers and the byte offsets at which their tokens end."""
    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, then U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def refined(ids: np.ndarray, size: np.ndarray, coarse: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: ``coarse`` where ``sure``, from there on by the tokens' decoded lengths."""
    decoded = np.cumsum(size[ids])
    last = np.maximum.accumulate(np.where(sure, np.arange(len(ids)), -1))
    known = last >= 0
    return np.where(known, coarse[last] - decoded[last], 0) + decoded


class Tokenizers:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, folder: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(f"{folder}/{A_FILE}")
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
        of = byte_alphabet()
        entries = self.first.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.a_size, self.b_size = np.array([*map(len, self.a_bytes)]), np.array([*map(len, self.b_bytes)])
        self.is_byte = np.array([bool(BYTE_PIECE.fullmatch(p)) for p in pieces])

    def cuts(self, spaced: str) -> Cuts | None:
        """Tokens of space + text; None where the bytes of either do not give it back."""
        raw = spaced.encode()
        got = self.first.encode(spaced, add_special_tokens=False)
        a, spans = np.array(got.ids, np.int64), np.array(got.offsets, np.int64).reshape(-1, 2)
        proto = [(p.id, p.end) for p in self.second.encode(spaced[1:], return_type="proto").pieces]
        b, b_coarse = np.array(proto, np.int64).reshape(-1, 2).T + np.array([[0], [1]])  # spans of the text, which the space precedes
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != raw or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
            return None
        a_coarse = spans[:, 1]
        if len(raw) != len(spaced):
            points = np.frombuffer(spaced.encode("utf-32-le"), np.uint32)
            a_coarse = np.concatenate(([0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))))[a_coarse]
        alone = np.append(spans[:-1, 1] <= spans[1:, 0], True)  # shares no character with the next token
        return Cuts(a, refined(a, self.a_size, a_coarse, alone), b, refined(b, self.b_size, b_coarse, ~self.is_byte[b]))


def groups(c: Cuts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets at which tokens of both end, and the number of A and of B tokens up to each."""
    common_ends = np.intersect1d(c.a_end, c.b_end, assume_unique=True)
    return common_ends, np.searchsorted(c.a_end, common_ends, "right"), np.searchsorted(c.b_end, common_ends, "right")


def links(c: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all token pairs whose byte ranges overlap."""
    first = np.searchsorted(c.b_end, np.concatenate(([0], c.a_end[:-1])), "right")
    last = np.searchsorted(np.concatenate(([0], c.b_end[:-1])), c.a_end, "left")
    n = last - first
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + first[i]


def units(spaced: str) -> list[str]:
    """Space + text, cut where both tokenizers cut for certain."""
    return CUT.split(spaced)


class Memory:
    """What a worker knows of the units it has met: token, group and link counts, the groups' text, linked pairs.

    The numbers of units hold until ``forget``, which keeps the units that occurred often once there are too many.
    """

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.counts, self.uses = np.zeros((1024, 4), np.int64), np.zeros(1024, np.int64)  # A tokens (-1 where bytes are not given back), B tokens, groups, links
        self.said: list[str] = []
        self.pairs, self.pairs_to = array("q"), array("q", [0])
        self.size = 0

    def learn(self, new: list[str]) -> None:
        """Units that keep their cuts when joined are tokenized together, others alone; " a" goes before one without a blank in front."""
        plain = [u for u in new if not u[-1].isspace() and not u.startswith("  ")]
        self._together([x for u in plain for x in ((u,) if u[0] == " " else (" a", u))])
        for u in new:
            if u not in self.number:
                self._together([u] if u[0] == " " else [" a", u])

    def _together(self, new: list[str]) -> None:
        if not new:
            return
        cuts = self.tokenizers.cuts("".join(new))
        if cuts is None and len(new) > 2:
            middle = len(new) // 2 + (new[len(new) // 2][0] != " ")
            self._together(new[:middle])
            self._together(new[middle:])
            return
        if cuts is None:
            self._add(new, np.array([[-1, 0, 0, 0]] * len(new)), [""] * len(new), np.zeros(0, np.int64))
            return
        ends = np.cumsum([len(u.encode()) for u in new])
        at, a_to, b_to = groups(cuts)
        i, j = links(cuts)
        to = np.stack([np.searchsorted(x, ends, "right") for x in (cuts.a_end, cuts.b_end, at, cuts.a_end[i])], 1)
        a_said, b_said = list(map(str, cuts.a.tolist())), list(map(str, cuts.b.tolist()))
        a_to, b_to = [0, *a_to.tolist()], [0, *b_to.tolist()]
        each = [",".join(a_said[a:c]) + "|" + ",".join(b_said[b:d]) for a, c, b, d in zip(a_to, a_to[1:], b_to, b_to[1:])]
        g = [0, *to[:, 2].tolist()]
        said = [each[x] if y == x + 1 else ";".join(each[x:y]) for x, y in zip(g, g[1:])]
        self._add(new, np.diff(to, axis=0, prepend=0), said, cuts.a[i] << 32 | cuts.b[j])

    def _add(self, new: list[str], counts: np.ndarray, said: list[str], pairs: np.ndarray) -> None:
        n = len(self.said)
        while n + len(new) > len(self.counts):
            self.counts, self.uses = np.concatenate((self.counts, np.zeros_like(self.counts))), np.concatenate((self.uses, np.zeros_like(self.uses)))
        self.counts[n: n + len(new)] = counts
        self.said += said
        self.size += sum(map(len, said)) + pairs.nbytes
        self.pairs_to.frombytes((len(self.pairs) + np.cumsum(counts[:, 3])).astype(np.int64).tobytes())
        self.pairs.frombytes(pairs.tobytes())
        self.number.update(zip(new, range(n, n + len(new))))

    def full(self) -> bool:
        return len(self.said) > REMEMBERED or self.size > REMEMBERED_BYTES

    def forget(self) -> None:
        """Keeps the more frequent half of the short units."""
        uses, number, counts, said = self.uses, self.number, self.counts, self.said
        pairs, to = np.frombuffer(self.pairs, np.int64), np.frombuffer(self.pairs_to, np.int64)
        least = max(2, int(np.quantile(uses[: len(said)], 0.5)) + 1)
        kept = [(u, n) for u, n in number.items() if uses[n] >= least and len(u) <= 64]
        at = np.array([n for _, n in kept], np.int64)
        self.clear()
        if kept:
            self._add([u for u, _ in kept], counts[at], [said[n] for _, n in kept], np.concatenate([pairs[to[n]: to[n + 1]] for n in at.tolist()]))
            self.uses[: len(at)] = uses[at] // 2


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


class Batch:
    """Documents of one batch: their own columns, and the numbers of their distinct units with how often each occurs."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.counts: list[tuple[int, ...]] = []
        self.shas: list[bytes] = []
        self.units: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.links = 0

    def add(self, doc: int | None, numbers: list[int], memory: Memory) -> None:
        each = memory.counts[numbers] if numbers else np.zeros((1, 4), np.int64)
        none = not numbers or each[:, 0].min() < 0
        self.docs.append(doc)
        self.counts.append((0, 0, 0, 0) if none else tuple(each.sum(0).tolist()))
        said = memory.said
        self.shas.append(bytes(32) if none else hashlib.sha256(";".join([said[n] for n in numbers]).encode()).digest())
        unit, times = np.unique(np.array([] if none else numbers, np.int64), return_counts=True)
        memory.uses[unit] += times
        self.units.append(unit)
        self.times.append(times)
        self.links += self.counts[-1][3]

    def row(self, number: int, memory: Memory) -> pa.RecordBatch:
        units, unit_of = np.unique(np.concatenate(self.units), return_inverse=True)
        in_doc = np.array([*map(len, self.units)], np.int64)
        to = np.frombuffer(memory.pairs_to, np.int64)
        lengths = to[units + 1] - to[units]
        pairs, pair_of = np.unique(np.frombuffer(memory.pairs, np.int64)[spread(to[units], lengths)], return_inverse=True)
        unit_ptr = np.concatenate(([0], np.cumsum(lengths)))
        of_doc = np.repeat(np.arange(len(in_doc)), in_doc)
        mine = np.unique(np.repeat(of_doc, lengths[unit_of]) * (len(pairs) + 1) + pair_of[spread(unit_ptr[unit_of], lengths[unit_of])])
        held = np.bincount(mine % (len(pairs) + 1), minlength=len(pairs)).astype(np.int32)
        blob = lambda x, kind: zlib.compress(np.asarray(x, kind).tobytes(), 1)
        values = [number, blob([d or 0 for d in self.docs], np.int64), blob([d is None for d in self.docs], np.uint8), blob(self.counts, np.int64),
                  b"".join(self.shas), blob(np.concatenate(([0], np.cumsum(in_doc))), np.int32), blob(unit_of, np.int32), blob(np.concatenate(self.times), np.int32),
                  blob(unit_ptr, np.int32), blob(pair_of, np.int32), pairs, held]
        kinds = [pa.int64(), *[pa.binary()] * 9, pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in BATCHES.split(", ")])


def worker_memory(folder: str) -> Memory:
    """The memory of this Python worker, which Spark reuses for many tasks: it is kept beside the imported modules."""
    kept = sys.modules.setdefault("alignment_memory", ModuleType("alignment_memory")).__dict__.setdefault("of", {})
    if folder not in kept:
        kept[folder] = Memory(Tokenizers(folder))
    return kept[folder]


def tokenized(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that turns (doc_id, text) rows into ``BATCHES`` rows; batch numbers are unique over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, batch = worker_memory(folder), Batch()
        number = TaskContext.get().partitionId() << 32
        for rows in pieces(batches):
            cut = []
            for raw in rows.column(1).to_pylist():
                text = (raw or b"").decode("utf-8", "replace")
                cut.append([] if not raw or text.encode() != raw else units(" " + text))
            known = memory.number
            memory.learn([*dict.fromkeys(u for us in cut for u in us if u not in known)])
            full = memory.full()
            for doc, us in zip(rows.column(0).to_pylist(), cut):
                batch.add(doc, [known[u] for u in us], memory)
                if batch.links >= BATCH_LINKS:
                    yield batch.row(number, memory)
                    batch, number = Batch(), number + 1
            if full and batch.docs:
                yield batch.row(number, memory)
                batch, number = Batch(), number + 1
            if full:
                memory.forget()
        if batch.docs:
            yield batch.row(number, memory)

    return run


def finished(batch: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of the result for one batch, from its documents' units and the answers (pair number, count, best) for its pairs."""
    x = batch.to_pylist()[0]
    read = lambda name, kind: np.frombuffer(zlib.decompress(x[name]), kind)
    count, best = (np.zeros(len(x["pairs"]), np.int64) for _ in range(2))
    at = answers["at"].to_numpy()
    count[at], best[at] = answers["count"].to_numpy(), answers["best"].to_numpy(zero_copy_only=False)
    per_doc = read("per_doc", np.int64).reshape(-1, 4)

    def summed(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[ptr[1:]] - total[ptr[:-1]]

    def per_document(of_pair: np.ndarray) -> np.ndarray:
        of_unit = summed(of_pair[read("pair_of", np.int32)], read("unit_ptr", np.int32))
        return summed(of_unit[read("unit_of", np.int32)] * read("times", np.int32), read("doc_ptr", np.int32))

    shas = [x["shas"][i: i + 32].hex() if n[0] else "" for i, n in zip(range(0, len(x["shas"]), 32), per_doc.tolist())]
    return pa.table({
        "doc_id": pa.array(read("docs", np.int64), mask=read("missing", np.uint8).astype(bool)),
        **{name: per_doc[:, k] for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
        "n_best": per_document(best), "count_sum": per_document(count), "groups_sha256": pa.array(shas, pa.string()),
    })


def align(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``OUT`` for every document. ``folder`` holds the tokenizer files on every executor."""
    batches = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t")) \
        .mapInArrow(tokenized(folder), BATCHES)
    batches = common.stored(batches, "alignment-batches")
    asked = batches.select("batch", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("at", "p")) \
        .select("batch", "at", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("docs"))
    counts = asked.groupBy("pair").agg(F.sum("docs").alias("count"))
    # at most as many rows for an A id as B has ids
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    counts = common.stored(counts.withColumn("best", F.col("count") == F.max("count").over(of_a)), "alignment-counts")
    answers = asked.join(counts, "pair").select(F.col("batch").alias("to"), "at", "count", "best")
    return batches.groupBy("batch").cogroup(answers.groupBy("to")).applyInArrow(finished, OUT)
