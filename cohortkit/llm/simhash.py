"""SimHash near-dedup: fingerprints linked by Hamming distance, searched with vantage-point trees.

Distinct fingerprints within ``DISTANCE`` = 4 bits are linked. On all 64 bits the distances of unrelated fingerprints
crowd around 32, so the triangle bound with radius 4 prunes little (about a sixth of the pairs a level). Two
fingerprints within 4 bits are within 1 bit on one of three blocks of 21 or 22 bits, so there is one tree per block:
its vantage points measure Hamming distance on the block (radius 1) or, where that cannot split, on all bits (radius 4).
The tree's top is built from a bounded sample and cuts the fingerprints into shards. A fingerprint lives in its home
shard and is also sent as a query to every shard whose side of a boundary it reaches by the triangle bound. In a
shard the same tree goes on down to small leaves, where all 64 bits are compared. No pair is lost by the pruning.

A shard returns a spanning forest of its links, not its pairs; alternating large-star and small-star rounds over the
forests give components, with each round written to the shared folder.

Defined results: null text counts as empty (fingerprint zero, linked like any other); null doc_ids count only where a
component has no other; repeated rows share a fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm import common

SHINGLE, DISTANCE, XX_SEED = 4, 4, 42
SHARD, SAMPLE, LEAF, TRIES, SEED = 8192, 20_000, 96, 6, 11
BLOCKS = (0x1FFFFF, 0x1FFFFF << 21, 0x3FFFFF << 42)  # 21 + 21 + 22 bits
ALL = (1 << 64) - 1


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """SimHash of the word shingles (repeats included) as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= k:
        hashes = digest(line, XX_SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = b"".join([digest(line[s:e], XX_SEED) for s, e in zip(starts[: 1 - k].tolist(), ends[k - 1:].tolist())])
    n = len(hashes) // 8
    ones = np.zeros(64, np.int64)
    raw = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for lo in range(0, n, 1 << 16):
        ones += np.unpackbits(raw[lo: lo + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    return common.add_column(docs, name, T.LongType(), "text", lambda: fingerprint)


def _apart(x: np.ndarray, v: int, mask: int) -> np.ndarray:
    return np.bitwise_count((x ^ np.uint64(v)) & np.uint64(mask)).astype(np.int16)


def split(points: np.ndarray, block: int, rng: np.random.Generator) -> tuple[int, int, int, int] | None:
    """The vantage point, mask, radius and boundary that send the fewest of ``points`` to both sides; None if no boundary splits."""
    best, best_cost = None, 2.0
    for mask, radius in ((block, 1), (ALL, DISTANCE)):
        for v in points[rng.integers(0, len(points), TRIES)].tolist():
            d = _apart(points, v, mask)
            mu = int(np.median(d))
            mu -= int(mu == d.max())
            inner = (d <= mu).mean()
            if 0 < inner < 1:
                cost = inner * (d <= mu + radius).mean() + (1 - inner) * (d > mu - radius).mean()  # share of pairs that stay together
                if cost < best_cost:
                    best, best_cost = (v, mask, radius, mu), cost
        if best_cost < 0.95:
            break
    return best


def plan_shards(sample: np.ndarray, total: int) -> list:
    """The top of one tree per block as nested (vantage, mask, radius, boundary, inner, outer); a leaf is a shard number."""
    rng, n = np.random.default_rng(SEED), 0

    def grow(points: np.ndarray, block: int) -> tuple | int:
        nonlocal n
        cut = split(points, block, rng) if len(points) * total > SHARD * len(sample) and len(points) > 8 else None
        if cut is None:
            n += 1
            return n - 1
        near = _apart(points, *cut[:2]) <= cut[3]
        return (*cut, grow(points[near], block), grow(points[~near], block))

    return [grow(sample, b) for b in BLOCKS]


def route(tree: tuple | int, x: np.ndarray, home: np.ndarray, out: list) -> None:
    """Appends (shard, fingerprints, whether at home) for every shard that some of ``x`` reach."""
    if not len(x):
        return
    if isinstance(tree, int):
        out.append((tree, x, home))
        return
    v, mask, radius, mu, inner, outer = tree
    d = _apart(x, v, mask)
    for side, reach, own in ((inner, d <= mu + radius, d <= mu), (outer, d > mu - radius, d > mu)):
        route(side, x[reach], (home & own)[reach], out)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the classes of a[i] and b[i]; a class is labelled by its smallest member."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
        while (to[to] != to).any():
            to = to[to]
        label[:] = to[label]


def link(data: np.ndarray, ask: np.ndarray, x: np.ndarray, label: np.ndarray, block: int, rng: np.random.Generator) -> None:
    """Unites what lies within ``DISTANCE``. ``data`` and ``ask`` index ``x``; both shrink on the way down the tree."""
    if not len(data) or not len(ask):
        return
    cut = split(x[data], block, rng) if len(data) > LEAF else None
    if cut is None:
        for lo in range(0, len(data), LEAF):
            d = data[lo: lo + LEAF]
            for at in range(0, len(ask), 8192):
                q = ask[at: at + 8192]
                i, j = np.nonzero(np.bitwise_count(x[d][:, None] ^ x[q][None, :]) <= DISTANCE)
                unite(label, d[i], q[j])
        return
    v, mask, radius, mu = cut
    dd, dq = _apart(x[data], v, mask), _apart(x[ask], v, mask)
    link(data[dd <= mu], ask[dq <= mu + radius], x, label, block, rng)
    link(data[dd > mu], ask[dq > mu - radius], x, label, block, rng)


def forest(rows: pa.Table, block_of: list[int]) -> pa.Table:
    """Links of one shard as (u, v) with v the smallest fingerprint of u's class there."""
    fp, home = rows["fp"].to_numpy(), rows["home"].to_numpy(zero_copy_only=False).astype(bool)
    order = np.argsort(fp)
    fp, home = fp[order], home[order]
    label = np.arange(len(fp))
    if len(fp):
        link(np.flatnonzero(home), np.arange(len(fp)), fp.view(np.uint64), label, BLOCKS[block_of[rows["shard"][0].as_py()]], np.random.default_rng(SEED))
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return pa.table({"u": fp[linked], "v": fp[label[linked]]}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def links(prints: DataFrame, total: int) -> DataFrame:
    """(u, v) links, u > v, that connect all distinct fingerprints (column fp) within ``DISTANCE``."""
    sample = np.array([r[0] for r in prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    if not len(sample):
        return prints.sparkSession.createDataFrame([], "u long, v long")
    trees = plan_shards(sample, total)
    block_of: list[int] = []

    def number(tree: tuple | int, block: int) -> None:
        if isinstance(tree, int):
            block_of.append(block)
        else:
            number(tree[4], block)
            number(tree[5], block)

    for i, t in enumerate(trees):
        number(t, i)

    def send(batches):
        for b in batches:
            x, out = b.column(0).to_numpy().view(np.uint64), []
            for t in trees:
                route(t, x, np.ones(len(x), bool), out)
            for shard, fps, home in out:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), shard), pa.int64()), pa.array(fps.view(np.int64)), pa.array(home)], ["shard", "fp", "home"])

    sent = prints.select("fp").mapInArrow(send, "shard long, fp long, home boolean")
    return sent.groupBy("shard").applyInArrow(lambda t: forest(t, block_of), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every node that has an edge and is not its component's smallest, by large-star and small-star rounds."""
    e, before = common.stored(edges, "star"), None
    while True:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if state == before or not state["n"]:
            return e.select("u", F.col("v").alias("root"))
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = common.stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-min")  # written, so that Spark can split a hub in the join
        large = common.stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star-large")
        least = common.stored(large.groupBy("u").agg(F.min("v").alias("m")), "star-min")
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = common.stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "star")


def classes(rows: DataFrame) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of ``rows`` (doc_id, fp)."""
    prints = common.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    root = components(links(prints, prints.count())).withColumnRenamed("u", "fp")
    rooted = common.stored(prints.join(root, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "roots")
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return common.stored(rooted.join(common.stored(ids, "component-ids"), "root").select("fp", "component_id"), "classes")


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    rows = common.stored(with_fingerprint(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "fingerprints")
    return rows.join(classes(rows), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component (the smallest doc_id) with its columns."""
    key = common.fresh(docs, "fp__")
    keyed = with_fingerprint(docs, key)
    rows = common.stored(keyed.select("doc_id", F.col(key).alias("fp")), "fingerprints")
    per = rows.join(classes(rows), "fp").groupBy("component_id", "doc_id", "fp").agg(F.count("*").alias("n"))
    per = common.stored(per.select("component_id", "doc_id", F.col("fp").alias(key), "n"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("f")
    # a component without any doc_id is told from the others by nothing but null, so its fingerprints stand for themselves
    top = common.stored(per.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col(key)).alias("lone")).agg(first)
                        .select(F.col("f.doc_id").alias("doc_id"), F.col(f"f.{key}").alias(key)), "first-members")
    dropped = common.stored(per.join(top, common.same(per, top, ["doc_id", key]), "left_anti").select("doc_id", key), "dropped")
    several = per.filter("n > 1").join(top, common.same(per, top, ["doc_id", key]), "left_semi").select("doc_id", key)
    return common.without(keyed, dropped, ["doc_id", key], several).drop(key)
