"""Best-fit packing into sequences of several permitted lengths.

A document of more words than the longest length is cut into pieces. Pieces are dealt to shards of about ``SHARD_PIECES``
by hash and packed there from long to short: a piece goes to the open bin with the least room that still holds it
(best fit). When none does, the permitted lengths are weighed against each other: each length is filled on paper with the
longest pieces still waiting, and the one with the least cost per word, (length + ``BIN_COST``) / words held, is
opened. Finally every bin is downsized to the shortest permitted length that holds its contents.

Only lengths are shuffled, never texts. Pieces are dealt and ordered by doc_id, a hash of the text, the number of the copy and
the piece, so the result does not depend on how the rows are split over files. Equal sizes go in that order. Defined results: an empty or null text has one row with 0 words, no bin and no
capacity; repeated rows are packed each; an empty table gives an empty result; other columns are not read;
a very long text is counted by Spark and packed in pieces of the longest length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import common

LENGTHS = (512, 1024, 2048, 4096)
BIN_COST = 16
SHARD_PIECES = 16_384
OUT = "doc_id long, piece long, start_word long, n_words long, bin_id long, capacity long, offset long"


def _cost(capacity: int, first: int, waiting: list[int], count: Counter) -> float:
    """Cost per word of a bin that starts with ``first`` and is filled with the longest of the waiting lengths."""
    room, i, held = capacity - first, len(waiting), first
    while room and i:
        i = bisect_left(waiting, room + 1, 0, i) - 1
        if i < 0:
            break
        n = min(count[waiting[i]], room // waiting[i])
        held, room = held + n * waiting[i], room - n * waiting[i]
    return (capacity + BIN_COST) / held


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> list[tuple[int, int, int]]:
    """(bin, capacity after downsizing, offset) of each size; no size is 0 or over the longest length."""
    lengths = tuple(sorted(lengths))
    out: list = [None] * len(sizes)
    count = Counter(sizes)
    waiting = sorted(count)
    by_room: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]  # open bins by the room they have
    rooms, used, caps = 0, [], []  # rooms: bit r is set while some bin has room r
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        count[size] -= 1
        if not count[size]:
            del waiting[bisect_left(waiting, size)]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b = len(used)
            room = min((c for c in lengths if c >= size), key=lambda c: (_cost(c, size, waiting, count), c))
            caps.append(room)
            used.append(0)
        out[i] = (b, used[b])
        used[b] += size
        if room > size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    down = [lengths[bisect_left(lengths, u)] for u in used]
    return [(b, down[b], at) for b, at in out]


def _pack(rows: pa.Table, lengths: tuple[int, ...]) -> pa.Table:
    rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "digest", "copy", "piece")])
    placed = best_fit(rows["n_words"].to_pylist(), lengths)
    shard = rows["shard"][0].as_py() if rows.num_rows else 0
    return pa.table({
        **{c: rows[c] for c in ("doc_id", "piece", "start_word", "n_words")}, "bin_id": pa.array([shard << 32 | b for b, _, _ in placed], pa.int64()),
        "capacity": pa.array([c for _, c, _ in placed], pa.int64()), "offset": pa.array([o for _, _, o in placed], pa.int64())})


def pack(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """``OUT``: where each piece of each document goes."""
    longest = max(lengths)
    key = ["doc_id", "digest", "size"]
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("digest"),
                        common.word_count(F.col("text")).alias("size")).groupBy(key).agg(F.count("*").alias("copies"))
    sizes = common.stored(common.numbered(items, "copies", "copy"), "pack-sizes")
    n = sizes.agg(F.sum(F.ceil(F.col("size") / longest))).first()[0] or 0
    pieces = sizes.filter("size > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {longest}"))))
    pieces = pieces.withColumn("start_word", F.col("piece") * longest) \
        .withColumn("n_words", F.least(F.lit(longest), F.col("size") - F.col("start_word")).cast("long")) \
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "digest", "copy", "piece"), F.lit(max(1, -(-n // SHARD_PIECES)))))
    lengths = tuple(lengths)
    packed = pieces.drop("size").groupBy("shard").applyInArrow(lambda t: _pack(t, lengths), OUT)
    none = F.lit(None).cast("long")
    empty = sizes.filter("size = 0").select("doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start_word"),
                                            F.lit(0).cast("long").alias("n_words"), none.alias("bin_id"), none.alias("capacity"), none.alias("offset"))
    return packed.unionByName(empty)
