"""Exact dedup: a minimal perfect hash over the historical distinct digests.

History is reduced to one row per digest (winner, count) and cut by digest into shards of about ``SHARD_KEYS`` keys.
Each shard becomes one row: the level bit arrays of a minimal perfect hash, and slots that hold the whole digest, the
winner's doc_id (the locator) and the count. Arrivals are grouped by digest before they meet the shards. A lookup hashes
the digest to its slot and compares all 32 bytes: members join the slot's group, nonmembers form groups of their own.

Defined results: null text is the empty text; a null doc_id sorts below every other; of rows that repeat doc_id and
text one stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm import common

SHARD_KEYS = 4096
GROUPS = "digest binary, keep_id long, group_size long, winner_rows long, member boolean"


def digest(text: bytes) -> bytes:
    """SHA-256 of a UTF-8 text after lower-casing A-Z (``bytes.lower`` touches ASCII only)."""
    return hashlib.sha256(text.lower()).digest()


def with_digest(docs: DataFrame, name: str) -> DataFrame:
    return common.add_column(docs, name, T.BinaryType(), "text", lambda: digest)


def _positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """A slot in [0, size) for each digest (rows of four 64-bit words), another one at each level."""
    h = np.full(len(keys), (0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for word in keys.T:
        h = (h ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and bits: a key is placed at the first level where no other remaining key has its position."""
    sizes, bits = [], []
    while len(keys):
        size = max(8, 2 * len(keys))
        at = _positions(keys, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        keys = keys[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot in [0, n) of each key, -1 for a key that no level holds."""
    rank, out, base = np.cumsum(bits) - 1, np.full(len(keys), -1, np.int64), 0
    left = np.arange(len(keys))
    for level, size in enumerate(sizes):
        at = base + _positions(keys[left], level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def _words(digest_column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digest_column.to_pylist()), "<u8").reshape(-1, 4)


INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()),
    T.StructField("digests", T.BinaryType()), T.StructField("locators", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("winner_rows", T.ArrayType(T.LongType())),
])


def build_shard(rows: pa.Table) -> pa.Table:
    """One index row from the distinct digests of a shard."""
    keys = _words(rows["digest"])
    sizes, bits = build(keys)
    order = np.argsort(slots(keys, sizes, bits))
    taken = rows.take(order)
    return pa.table({
        "shard": [rows["shard"][0].as_py()], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()],
        "digests": [keys[order].tobytes()], "locators": [taken["keep_id"].to_pylist()],
        "counts": [taken["group_size"].to_pylist()], "winner_rows": [taken["winner_rows"].to_pylist()],
    }, schema=pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("digests", pa.binary()),
                         ("locators", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("winner_rows", pa.list_(pa.int64()))]))


def _better(a: tuple, b: tuple) -> tuple:
    """The larger (doc_id, rows with it); null below all; equal ids add their rows."""
    if a[0] == b[0]:
        return a[0], a[1] + b[1]
    return a if b[0] is None or (a[0] is not None and a[0] > b[0]) else b


def merge_shard(arrivals: pa.Table, index: pa.Table) -> pa.Table:
    """Groups of one shard: the index slots with the arrivals that are members, then the other arrivals."""
    out: dict[str, list] = {"digest": [], "keep_id": [], "group_size": [], "winner_rows": [], "member": []}

    def emit(digest: bytes, keep: int | None, size: int, rows: int, member: bool) -> None:
        for k, v in zip(out, (digest, keep, size, rows, member)):
            out[k].append(v)

    found, held = {}, []
    asked = arrivals.to_pylist()
    if index.num_rows:
        x = index.to_pylist()[0]
        held = np.frombuffer(x["digests"], "<u8").reshape(-1, 4)
        if asked:
            keys = _words(arrivals["digest"])
            at = slots(keys, x["sizes"], np.unpackbits(np.frombuffer(x["bits"], np.uint8))[: sum(x["sizes"])].astype(bool))
            whole = (at >= 0) & (held[at] == keys).all(axis=1)  # all 32 bytes, as any nonmember also hashes to some slot
            found = {int(s): i for i, s in enumerate(at) if whole[i]}
        for s, (keep, n, rows) in enumerate(zip(x["locators"], x["counts"], x["winner_rows"])):
            size = n
            if s in found:
                a = asked[found[s]]
                (keep, rows), size = _better((keep, rows), (a["keep_id"], a["winner_rows"])), n + a["group_size"]
            emit(held[s].tobytes(), keep, size, rows, True)
    members = set(found.values())
    for i, a in enumerate(asked):
        if i not in members:
            emit(a["digest"], a["keep_id"], a["group_size"], a["winner_rows"], False)
    return pa.table(out, schema=pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
                                           ("winner_rows", pa.int64()), ("member", pa.bool_())]))


def grouped(rows: DataFrame, n_shards: int) -> DataFrame:
    """(doc_id, digest) rows as one row per digest; both aggregates combine before their shuffle, so copies cost little."""
    per_id = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "n"))
    return per_id.groupBy("digest").agg(best.alias("w"), F.sum("n").alias("group_size")).select(
        F.pmod(F.xxhash64("digest"), F.lit(n_shards)).alias("shard"), "digest", F.col("w.doc_id").cast("long").alias("keep_id"),
        "group_size", F.col("w.n").alias("winner_rows"))


def build_index(history: DataFrame, n_shards: int) -> DataFrame:
    """The index (a row per shard) over the digests of ``history`` (doc_id, digest)."""
    return grouped(history, n_shards).groupBy("shard").applyInArrow(build_shard, INDEX)


def merge(arrivals: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """Groups (``GROUPS``) of history and arrivals together, from the index and the arrivals' digests."""
    asked = grouped(arrivals, n_shards)
    return asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(merge_shard, GROUPS)


def shards_for(n_rows: int) -> int:
    return max(1, -(-n_rows // SHARD_KEYS))


def duplicate_groups(rows: DataFrame, historical: Column, n_rows: int) -> DataFrame:
    """Groups of equal digests in ``rows`` (doc_id, digest): ``historical`` rows are indexed, the others looked up."""
    n = shards_for(n_rows)
    past = F.coalesce(historical, F.lit(False))
    index = common.stored(build_index(rows.filter(past), n), "mph-index")
    return common.stored(merge(rows.filter(~past), index, n), "mph-groups")


def first_half(rows: DataFrame) -> tuple[Column, int]:
    """History as the lower half of the doc_id range (ids follow arrival), and the number of rows."""
    x = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).first()
    middle = 0 if x["lo"] is None else (x["lo"] + x["hi"]) // 2
    return F.col("doc_id") <= F.lit(middle), x["n"]


def mark(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text)."""
    rows = with_digest(docs.select("doc_id", "text"), "digest").select("doc_id", "digest")
    rows = common.stored(rows.withColumn("rid", F.monotonically_increasing_id()), "digests")  # fixed once written
    past, n = first_half(rows)
    groups = duplicate_groups(rows.select("doc_id", "digest"), past, n)
    several = groups.filter("winner_rows > 1").select(F.col("digest").alias("d2"), "keep_id")
    first = rows.join(several, (F.col("digest") == F.col("d2")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))) \
        .groupBy("digest").agg(F.min("rid").alias("first_rid"))
    groups = common.stored(groups.join(first, "digest", "left"), "mph-winners")
    mine = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("first_rid").isNull() | (F.col("rid") == F.col("first_rid")))
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", mine.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    key = common.fresh(docs, "digest__")
    keyed = with_digest(docs, key)
    rows = common.stored(keyed.select("doc_id", F.col(key).alias("digest")), "digests")
    past, n = first_half(rows)
    groups = duplicate_groups(rows, past, n)
    winners = groups.filter("group_size > 1").select(F.col("digest").alias(key), F.col("keep_id").alias("doc_id"), "winner_rows")
    # distinct before the join (on both columns, which spreads a large group), so that nothing above the
    # join keeps Spark from splitting a hot digest
    losers = rows.distinct().withColumnRenamed("digest", key).join(winners.withColumnRenamed("doc_id", "keep_id"), key) \
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(key, "doc_id")
    losers = common.stored(losers, "mph-losers")
    return common.without(keyed, losers, [key, "doc_id"], winners.filter("winner_rows > 1").select(key, "doc_id")).drop(key)


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
