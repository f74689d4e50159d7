"""MinHash near-dedup with odd sketches: documents linked where their sets of word pairs have a Jaccard similarity of 0.8 or more.

A set's ``SAMPLES`` = 200 MinHash values give ``BANDS`` = 40 bands of five and, folded by parity into ``BITS`` = 512 bits, its
odd sketch: bit b is set if an odd number of values fall on b. With x bits different between two sketches the similarity
is about 1 + BITS / (4 SAMPLES) ln(1 - 2 x / BITS). Two sets of similarity 0.8 share no band with probability 1.3e-7, and
the estimate falls under ``LEAST`` = 0.55 with a probability of some 1e-7, so pairs below it are not looked at again.

Equal sets are one set. A band's members are first compared with its smallest member: each set's best estimate is confirmed
on the full sets, which gives components. Where a band still holds several, every member outside the band's largest
component is a query against all members of other components, in cells of bounded size. First each query's nearest pair is
confirmed, which merges most. Then all pairs that pass the sketch are confirmed; a query that has more than ``FEW`` of them with
one component is compared with that whole component on full sets instead, again in cells, and gives at most a link a cell.
Pairs inside a component change nothing and are not made, so a band of many near copies costs its size, not its square.

Defined results: null, empty and blank texts have the empty set, are linked with nothing and stand for themselves; one word
is a set of one; a null doc_id counts only where a component has no other; rows that repeat a document share its set; an
empty table gives an empty result. Texts are read whole however long, in slices of shingles; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import common, simhash
from cohortkit.llm.common import pieces, texts

SAMPLES, BANDS, BITS, SEED = 200, 40, 512, 77
LEAST = 0.55
SAME, OF = 80, 100  # linked where OF * intersection >= SAME * union
QUERIES, DATA, FEW = 512, 4096, 4  # members of a cell; pairs of a query with one component that are confirmed one by one
WORDS = BITS // 64
SKETCH = [f"s{i}" for i in range(WORDS)]
ONE, TWO = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word pairs of a UTF-8 text in lower case; one word stands alone."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(w) for w in words]), ">u8").astype(np.uint64)
    return np.unique(mixed(h) if len(h) == 1 else mixed(h[:-1] * np.uint64(ONE) + mixed(h[1:]) * np.uint64(TWO) + np.uint64(1)))


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The least of each of ``SAMPLES`` permutations (odd multipliers of the hashes)."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, SAMPLES, np.uint64) << np.uint64(1) | np.uint64(1)
    least = np.full(SAMPLES, ~np.uint64(0))
    for lo in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[None, lo: lo + 4096] * factors[:, None]).min(1))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One number for each band's number and values."""
    key = np.arange(BANDS, dtype=np.uint64)
    for column in mixed(least).reshape(BANDS, -1).T:
        key = mixed(key * np.uint64(ONE) + column)
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The parity of the number of (sample, value) pairs on each bit, as 64-bit numbers."""
    at = mixed(least + mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64))) % np.uint64(BITS)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def similarity(differing: Column) -> Column:
    """The estimate from the number of differing sketch bits."""
    left = F.lit(1.0) - differing * (2.0 / BITS)
    return F.when(left > 0, 1 + F.log(left) * (BITS / (4 * SAMPLES))).otherwise(0.0)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key (of the set; null if empty), bands and sketch of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sizes, keys, banded, sketch = [], [], [], []
            for text in texts(b.column(1)):
                h = shingles(text)
                sizes.append(len(h))
                least = minhash(h) if len(h) else None
                keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                banded.append(bands(least) if len(h) else None)
                sketch.append(odd_sketch(least) if len(h) else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(banded, longs), pa.array(sketch, longs)],
                                             ["doc_id", "n_shingles", "key", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, key binary, bands array<long>, sketch array<long>")


def with_hashes(docs: DataFrame) -> DataFrame:
    """key and hashes (the whole set) of every document that has a set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets = [h for t in texts(b.column(0)) if len(h := shingles(t))]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in sets], pa.binary()),
                                              pa.array([h.tobytes() for h in sets], pa.binary())], ["key", "hashes"])

    return docs.select("text").mapInArrow(run, "key binary, hashes binary")


def overlapping(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v, hashes of both) that are linked: exact intersection and union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            linked = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(OF * shared >= SAME * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return pairs.select("u", "v", "hu", "hv").mapInArrow(run, "u long, v long")


class Corpus:
    """The distinct sets of a corpus and the members of their bands."""

    def __init__(self, docs: DataFrame) -> None:
        self.docs = docs.select("doc_id", "text")
        self.rows = common.stored(sketched(docs), "sketches")
        sets = self.rows.filter("key IS NOT NULL").groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        # numbers are fixed once written
        self.sets = common.stored(sets.select(F.monotonically_increasing_id().alias("sid"), "key", "least_id", "n", "bands", *[F.col("sketch")[i].alias(s) for i, s in enumerate(SKETCH)]), "sets")
        banded = self.sets.select("sid", F.explode("bands").alias("band"))
        shared = banded.groupBy("band").agg(F.min("sid").alias("pivot"), F.count("*").alias("size")).filter("size > 1")
        self.members = common.stored(banded.join(shared, "band"), "band-members")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that may be linked by their sizes and sketches, with the estimate."""
        side = lambda x: self.sets.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), *[F.col(s).alias(x + s) for s in SKETCH])
        return pairs.join(side("u"), "u").join(side("v"), "v").withColumn("about", estimate("u", "v")).filter(possible("u", "v")).select("u", "v", "about")

    def full_sets(self, asked: DataFrame) -> DataFrame:
        """sid and h (the whole set) of the asked sets; only texts of these are read again and moved."""
        asked = common.stored(asked.distinct().join(self.sets.select("sid", "key", "least_id"), "sid"), "asked-sets")
        ids = asked.select("least_id").distinct()
        there = self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["least_id"]), "left_semi")
        return common.stored(with_hashes(there).join(asked, "key").groupBy("sid").agg(F.first("hashes").alias("h")), "full-sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are linked by the full sets."""
        hashes = self.full_sets(pairs.select(F.explode(F.array("u", "v")).alias("sid")))
        both = pairs.select("u", "v").join(hashes.select(F.col("sid").alias("u"), F.col("h").alias("hu")), "u") \
            .join(hashes.select(F.col("sid").alias("v"), F.col("h").alias("hv")), "v")
        return common.stored(overlapping(both), "confirmed")

    def rooted(self, links: DataFrame) -> DataFrame:
        """sid and root of every set that has a link and is not its component's smallest."""
        return common.stored(simhash.components(links.select("u", "v").distinct()).select(F.col("u").alias("sid"), "root"), "roots")

    def between(self, roots: DataFrame, best: bool) -> DataFrame:
        """What ``meet`` finds between components that share a band."""
        placed = self.members.join(roots, "sid", "left").select("band", "sid", F.coalesce("root", "sid").alias("root"))
        parts = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
        several = parts.groupBy("band").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("size"), F.count("*").alias("parts")).filter("parts > 1") \
            .select("band", F.col("most.root").alias("main"), (F.ceil((F.col("size") - F.col("most.n")) / QUERIES)).cast("int").alias("q_cells"),
                    F.ceil(F.col("size") / DATA).cast("int").alias("d_cells"))
        open_ = common.stored(placed.join(several, "band").join(self.sets.select("sid", "n", *SKETCH), "sid"), "open-bands")
        met = common.stored(dealt(open_, "band", F.col("root") != F.col("main"), ["sid", "n", "root", *SKETCH]), "cells")
        shards = max(1, met.count() // DATA)
        kind = "u long, v long, bits int, root long"
        met = met.withColumn("shard", F.pmod(F.xxhash64("band", "q", "d"), F.lit(shards)))
        return common.stored(met.groupBy("shard").applyInArrow(lambda t: meet(t, best), kind).distinct(), "met")

    def scanned(self, hot: DataFrame, roots: DataFrame) -> DataFrame:
        """Links (u, v) of the sets ``hot`` (sid, root) with any member of that root's component, by the full sets, cell by cell."""
        size = self.sets.select("sid", "n").join(roots, "sid", "left").select("sid", F.coalesce("root", "sid").alias("root"))
        wanted = common.stored(hot.groupBy("root").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("q_cells")), "hot-roots")
        members = size.join(wanted.select("root"), "root")
        cells = wanted.join(members.groupBy("root").agg(F.ceil(F.count("*") / DATA).cast("int").alias("d_cells")), "root")
        both = common.stored(members.withColumn("asks", F.lit(False)).unionByName(hot.select("root", "sid").withColumn("asks", F.lit(True))).join(cells, "root"), "hot-members")
        both = both.join(self.full_sets(both.select("sid")), "sid")
        met = dealt(both, "root", F.col("asks"), ["sid", "h"], ~F.col("asks"))
        return common.stored(met.groupBy("root", "q", "d").applyInArrow(first_links, "u long, v long"), "hot-links")


def dealt(members: DataFrame, group: str, asks: Column, columns: list[str], asked: Column | None = None) -> DataFrame:
    """Rows of each cell (group, q, d): queries, dealt to q_cells, go to every d; the members asked (all if not said), dealt to
    d_cells, go to every q."""
    own = lambda n: F.pmod(F.xxhash64("sid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = members.filter(asks).select(group, own("q_cells").alias("q"), every("d_cells").alias("d"), F.lit(True).alias("query"), *columns)
    rest = members if asked is None else members.filter(asked)
    return asking.unionByName(rest.select(group, every("q_cells").alias("q"), own("d_cells").alias("d"), F.lit(False).alias("query"), *columns))


def most_bits() -> int:
    """The most sketch bits that may differ at an estimate of ``LEAST``."""
    return int(BITS / 2 * (1 - np.exp((LEAST - 1) * 4 * SAMPLES / BITS)))


def meet(t: pa.Table, best: bool) -> pa.Table:
    """Of the cells in ``t``: for each query the nearest member of another component (``best``), else the members of other
    components that pass the sketch, or the component's root alone where it has more than ``FEW``."""
    band, q, d, query = (t[c].to_numpy(zero_copy_only=False) for c in ("band", "q", "d", "query"))
    sid, n, root = (t[c].to_numpy() for c in ("sid", "n", "root"))
    sketch = np.stack([t[s].to_numpy() for s in SKETCH])
    order = np.lexsort((query, d, q, band))
    keys = np.stack([band, q, d])[:, order]
    cuts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(0)))) if len(order) else []
    out: list[tuple] = []
    for a, e in zip(cuts, [*cuts[1:], len(order)]):
        cell = order[a:e]
        ask, data = cell[query[cell]], cell[~query[cell]]
        bits = np.zeros((len(ask), len(data)), np.int16)
        for word in sketch:
            bits += np.bitwise_count(word[ask][:, None] ^ word[data][None])
        less, more = np.minimum(n[ask][:, None], n[data][None]), np.maximum(n[ask][:, None], n[data][None])
        bits[(root[ask][:, None] == root[data][None]) | (OF * less < SAME * more)] = BITS
        passing = bits <= most_bits()
        for i in np.flatnonzero(passing.any(1)).tolist():
            u = int(sid[ask[i]])
            there = [int(bits[i].argmin())] if best else np.flatnonzero(passing[i]).tolist()
            of_root = Counter(root[data[there]].tolist())
            for j in there:
                v, r = int(sid[data[j]]), int(root[data[j]])
                out.append((max(u, v), min(u, v), int(bits[i, j]), None) if of_root[r] <= FEW else (u, None, None, r))
    out = list(dict.fromkeys(out))
    return pa.table({name: pa.array([o[k] for o in out], kind) for k, (name, kind) in enumerate((("u", pa.int64()), ("v", pa.int64()), ("bits", pa.int32()), ("root", pa.int64())))})


def first_links(t: pa.Table) -> pa.Table:
    """For each query of a cell one linked member, if there is any, by counting shared hashes over an inverted index."""
    query = t["query"].to_numpy(zero_copy_only=False)
    sid, sets = t["sid"].to_numpy(), [np.frombuffer(h, np.uint64) for h in t["h"].to_pylist()]
    data = np.flatnonzero(~query).tolist()
    found: list[tuple[int, int]] = []
    if data:
        flat = np.concatenate([sets[j] for j in data])
        sizes = np.array([len(sets[j]) for j in data])
        of = np.repeat(np.arange(len(data)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, of = flat[order], of[order]
        for i in np.flatnonzero(query).tolist():
            lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
            at = np.arange((hi - lo).sum()) + np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo)
            shared = np.bincount(of[at], minlength=len(data))
            linked = np.flatnonzero(OF * shared >= SAME * (sizes + len(sets[i]) - shared))
            if len(linked):
                u, v = int(sid[i]), int(sid[data[linked[0]]])
                found.append((max(u, v), min(u, v)))
    return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})


def estimate(u: str, v: str) -> Column:
    bits = [F.bit_count(F.col(u + s).bitwiseXOR(F.col(v + s))) for s in SKETCH]
    return similarity(reduce(Column.__add__, bits))


def possible(u: str, v: str) -> Column:
    """Sizes that allow the similarity, and an estimate that does not rule it out."""
    return (OF * F.least(f"n{u}", f"n{v}") >= SAME * F.greatest(f"n{u}", f"n{v}")) & (estimate(u, v) >= LEAST)


def components(corpus: Corpus) -> DataFrame:
    """sid and root of every set that is linked and not its component's smallest."""
    star = corpus.members.filter("sid != pivot").select(F.col("sid").alias("u"), F.col("pivot").alias("v")).distinct()
    tried = corpus.estimated(star).groupBy("u").agg(F.max(F.struct("about", "v")).alias("m")).select("u", F.col("m.v").alias("v"))
    tried = common.stored(tried, "star-pairs")
    links = corpus.confirmed(tried)
    roots = corpus.rooted(links)
    for best in (True, False):
        met = corpus.between(roots, best)
        pairs = met.filter("v IS NOT NULL")
        if best:  # the nearest of all its bands
            ends = pairs.select("u", "v", "bits").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "bits"))
            nearest = ends.groupBy("u").agg(F.min(F.struct("bits", "v")).alias("m")).select("u", F.col("m.v").alias("v"))
            pairs = nearest.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        pairs = common.stored(pairs.select("u", "v").distinct().join(tried, ["u", "v"], "left_anti"), "open-pairs")
        links = links.unionByName(corpus.confirmed(pairs))
        if not best:
            links = links.unionByName(corpus.scanned(met.filter("v IS NULL").select(F.col("u").alias("sid"), "root").distinct(), roots))
        tried = tried.unionByName(pairs)
        roots = corpus.rooted(links)
    return roots


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    corpus = Corpus(docs)
    rooted = corpus.sets.select("sid", "key", "least_id").join(components(corpus), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = common.stored(rooted, "set-roots")
    ids = common.stored(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "set-components")
    of_key = common.stored(rooted.join(ids, "root").select("key", "component_id"), "set-classes")
    found = corpus.rows.select("doc_id", "n_shingles", "key").join(of_key, "key", "left")
    found = found.withColumn("component_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
