"""Conversation prefix trie: burst tries over the turns of conversations.

A turn is known by 128 bits of the SHA-256 of its role and text, a prefix by its length and the XOR of 128-bit hashes of (place,
turn), so that prefixes of a long conversation come from sums over its parts. Equal conversations are one sequence with its
copies. A sequence is cut into segments of ``SEGMENT`` turns (the last may be empty); a segment is a suffix in the container
under the trie head that its prefix names, so no task needs a whole long conversation. A container of more than ``CONTAINER``
suffixes bursts: the head becomes a node and each suffix goes to the container of its next turn. What remains is dealt to
shards, which sort each container and sweep its levels into nodes.

The sweep runs twice. First it finds for each sequence down to which depth others are smaller members and whether it ends in
a leaf; every node is then owned by its smallest member, below one depth of that sequence. With that, leaves and saved
words of a subtree are plain sums over members, which a container or a burst head has at hand: saved is copies times the
words below the node, less the words of owned nodes.

Defined results: rows without conv_id are no conversation; null role or text is empty; turns that tie, also with null, are
ordered by their hash, equal rows are equal turns; an empty table has no node, not even the root; texts are hashed and
counted whole by Spark; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm import common

SEGMENT, CONTAINER, SHARD, BUCKET, ENDS = 64, 2048, 8192, 1024, 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
# The contract's rule: conversation c starts with up to crc32(c) % 4 turns of conversation c - c % 20.
PERIOD, BORROWED = 20, 4
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
HEAD = ["k", "depth", "h1", "h2"]  # a head at a border stands for a node in one segment and starts a container in the next


def hashed(place: Column, turn: Column, which: int) -> Column:
    return F.xxhash64(F.lit(which), place.cast("long"), turn)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id (of role and text) and words of every row that belongs to a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("id"), common.word_count(text).alias("words"))


def placed(rows: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ... in the order of turn, null first), id, words. Ranges of rows are counted each by a task, so that
    a conversation may be longer than one; what earlier ranges hold of it is added after."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            conv = b.column(0).to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv)))) + 1
            if last is not None and conv[0] == last:
                place[: starts[1] if len(starts) > 1 else len(conv)] += seen
            last, seen = conv[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(conv), part), pa.int64()), pa.array(place, pa.int64()), b.column(1), b.column(2)],
                                             ["conv_id", "part", "at", "id", "words"])

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id"), F.col("serial")]  # the serial parts equal rows only
    ranged = rows.withColumn("serial", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = common.stored(ranged.select("conv_id", "id", "words").mapInArrow(number, "conv_id long, part long, at long, id binary, words long"), "ordered-turns")
    held = ranged.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range at most
    earlier = held.withColumn("earlier", F.sum("n").over(before)).filter("earlier > 0").select("conv_id", "part", "earlier")
    # at most one conversation goes on from one range to the next, so there are fewer rows than partitions
    return ranged.join(F.broadcast(earlier), ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("earlier", F.lit(0))).alias("place"), "id", "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, id, words) of the contract's rebuilt conversations, and (conv_id, length) of all, turnless ones too."""
    own = common.stored(placed(turns(conversations)), "placed-turns")
    convs = own.groupBy("conv_id").agg(F.max("place").alias("n")).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED) \
        .withColumn("first", F.col("conv_id") - F.col("conv_id") % PERIOD)
    convs = common.stored(convs, "conversations")
    lent = own.filter((F.col("conv_id") % PERIOD == 0) & (F.col("place") < BORROWED)).withColumnRenamed("conv_id", "first")
    lender = convs.filter("conv_id = first").select("first", F.col("n").alias("there"))
    convs = convs.join(lender, "first", "left").withColumn("m", F.least("h", F.coalesce("there", F.lit(0)))) \
        .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = common.stored(convs.select("conv_id", "first", "h", "m", "length"), "rebuilt-conversations")
    borrowed = convs.join(lent, "first").filter("place <= h").select("conv_id", "place", "id", "words")
    kept = own.join(convs, "conv_id").filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("place"), "id", "words")
    return common.stored(borrowed.unionByName(kept), "rebuilt-turns"), convs.select("conv_id", "length")


def segments(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The segments of all conversations: arrays of ids and words, hashes of the prefix in front, words after, last."""
    k = F.expr(f"(place - 1) DIV {SEGMENT}")
    cut = rows.groupBy("conv_id", k.alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "words"))).alias("t"), F.sum("words").alias("held"),
        *[F.bit_xor(hashed(F.col("place"), F.col("id"), i)).alias(f"z{i}") for i in (1, 2)])
    cut = cut.select("conv_id", "k", F.col("t.id").alias("ids"), F.col("t.words").alias("words"), "held", "z1", "z2")
    ends = lengths.filter(F.col("length") % SEGMENT == 0).select(
        "conv_id", F.expr(f"length DIV {SEGMENT}").alias("k"), F.expr("array()").cast("array<binary>").alias("ids"), F.expr("array()").cast("array<long>").alias("words"),
        *[F.lit(0).cast("long").alias(c) for c in ("held", "z1", "z2")])
    cut = common.stored(cut.unionByName(ends).withColumn("bucket", F.expr(f"k DIV {BUCKET}")), "segments")
    sums = [(F.sum, "held", "before"), (F.bit_xor, "z1", "h1"), (F.bit_xor, "z2", "h2")]
    # buckets of segments are summed first, so that no window holds a whole long conversation
    in_bucket = Window.partitionBy("conv_id", "bucket").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    over_buckets = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = cut.groupBy("conv_id", "bucket").agg(*[f(c).alias(c) for f, c, _ in sums])
    buckets = buckets.select("conv_id", "bucket", *[f(c).over(over_buckets).alias(f"{to}_") for f, c, to in sums]).filter("bucket > 0")
    cut = cut.select("*", *[F.coalesce(f(c).over(in_bucket), F.lit(0)).alias(to) for f, c, to in sums]).join(buckets, ["conv_id", "bucket"], "left")
    cut = cut.withColumn("before", F.col("before") + F.coalesce("before_", F.lit(0))).withColumns({h: F.col(h).bitwiseXOR(F.coalesce(f"{h}_", F.lit(0).cast("long"))) for h in ("h1", "h2")})
    return cut.select("conv_id", "k", "ids", "words", "held", "before", "h1", "h2", "z1", "z2")


def ends_hashes(members: DataFrame) -> DataFrame:
    """rep and the SHA-256 of its members' numbers in ascending order (rep, conv_id rows). Blocks of numbers are joined in
    parallel; one task then feeds a sequence's blocks to the hash one by one, since SHA-256 has no other way."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, conv = b.column(0).to_numpy(), b.column(1).to_pylist()
            cuts = np.flatnonzero(np.concatenate(([True], rep[1:] != rep[:-1]))).tolist() if len(rep) else []
            spans = [(x, min(x + ENDS, y)) for a, y in zip(cuts, [*cuts[1:], len(conv)]) for x in range(a, y, ENDS)]
            yield pa.RecordBatch.from_arrays([pa.array([rep[x] for x, _ in spans], pa.int64()), pa.array([conv[x] for x, _ in spans], pa.int64()),
                                              pa.array([",".join(map(str, conv[x:y])) for x, y in spans], pa.string())], ["rep", "conv_id", "said"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = lambda rep, sha: pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([sha.hexdigest()])], ["rep", "ends"])
        rep, sha = None, None
        for b in batches:
            for r, said in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if r != rep:
                    if sha:
                        yield row(rep, sha)
                    rep, sha = r, hashlib.sha256(said.encode())
                else:
                    sha.update(b"," + said.encode())
        if sha:
            yield row(rep, sha)

    joined = members.select("rep", "conv_id").repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(blocks, "rep long, conv_id long, said string")
    return joined.repartition("rep").sortWithinPartitions("rep", "conv_id").select("rep", "said").mapInArrow(hashes, "rep long, ends string")


def suffixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per segment of each distinct sequence, named by its smallest conversation."""
    cut = common.stored(segments(rows, lengths), "prefixed-segments")
    whole = cut.groupBy("conv_id").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.sum("held").alias("total")).join(lengths, "conv_id")
    whole = common.stored(whole, "whole-conversations")
    groups = whole.groupBy("length", "z1", "z2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("copies"), F.first("total").alias("total"))
    groups = common.stored(groups, "sequences")
    several = ends_hashes(whole.join(groups.filter("copies > 1"), ["length", "z1", "z2"]))
    reps = groups.join(common.stored(several, "sequence-ends"), "rep", "left").select(
        F.col("rep").alias("conv_id"), "copies", "total", "length", F.coalesce("ends", F.sha2(F.col("rep").cast("string").cast("binary"), 256)).alias("ends"))
    return cut.join(reps, "conv_id").select(
        "conv_id", "k", "ids", "words", "h1", "h2", (F.col("k") * SEGMENT).alias("depth"), F.lit(0).alias("off"), F.lit(None).cast("long").alias("parent"),
        "copies", (F.expr(f"length DIV {SEGMENT}") == F.col("k")).alias("last"), (F.col("total") - F.col("before") - F.col("held")).alias("after"), "ends")


def burst(items: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The suffixes under their last heads, and for each round the suffixes of the heads that burst, with the head's smallest member."""
    done, burst_rounds = [], []
    while True:
        items = common.stored(items, "suffixes")
        big = items.groupBy(*HEAD).agg(F.count("*").alias("size"), F.min("conv_id").alias("low")).filter(F.col("size") > CONTAINER).drop("size")
        big = common.stored(big, "big-heads")
        n = big.count()
        if not n:
            return common.stored(_union([*done, items]), "containers"), burst_rounds
        big = common.small(big, n, 40)
        done.append(items.join(big, HEAD, "left_anti"))
        burst_rounds.append(common.stored(items.join(big, HEAD), "burst"))
        turn = F.element_at("ids", F.col("off") + 1)
        step = burst_rounds[-1].filter(F.col("off") < F.size("ids"))
        items = step.withColumns({"h1": F.col("h1").bitwiseXOR(hashed(F.col("depth") + 1, turn, 1)), "h2": F.col("h2").bitwiseXOR(hashed(F.col("depth") + 1, turn, 2)),
                                  "depth": F.col("depth") + 1, "off": F.col("off") + 1, "parent": F.col("low")}).drop("low")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class Levels:
    """The suffixes of a shard's containers, sorted; ``at[j]`` has the runs of suffixes that share j turns under their head."""

    def __init__(self, t: pa.Table) -> None:
        ids = t["ids"].combine_chunks()
        flat, to = ids.flatten(), ids.offsets.to_numpy().astype(np.int64)
        raw, to = b"".join(flat.to_pylist()), to - to[0]
        off = t["off"].to_numpy()
        first = to[:-1] + off
        head = list(zip(*(t[c].to_pylist() for c in HEAD)))
        order = np.array(sorted(range(t.num_rows), key=lambda i: (head[i], raw[16 * first[i]: 16 * to[i + 1]])), np.int64)
        self.rows = t.take(pa.array(order))
        self.first, self.end = first[order], to[1:][order]
        codes = flat.dictionary_encode().indices.to_numpy()
        self.conv, self.depth, self.off = (self.rows[c].to_numpy() for c in ("conv_id", "depth", "off"))
        left = self.end - self.first
        self.left = left
        new = np.array([True, *[head[a] != head[b] for a, b in zip(order[1:], order[:-1])]])
        run, low, parent = None, np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        self.at: list[dict] = []
        for j in range(int(left.max()) + 1):
            alive = np.flatnonzero(left >= j)
            if j:
                code = np.full(len(order), -1)
                code[alive] = codes[self.first[alive] + j - 1]
                new = new | np.concatenate(([True], code[1:] != code[:-1]))
            starts = np.flatnonzero(new[alive])
            lows = np.minimum.reduceat(self.conv[alive], starts)
            if self.at:
                parent = low.copy()
                self.at[-1]["children"] = np.bincount(run[alive[starts]], minlength=len(self.at[-1]["starts"]))
            run = np.zeros(len(order), np.int64)
            run[alive] = np.cumsum(new[alive]) - 1
            low[alive] = lows[run[alive]]
            self.at.append({"alive": alive, "starts": starts, "low": lows, "run": run[alive], "parent": parent[alive[starts]], "children": np.zeros(len(starts), np.int64)})


def claims(t: pa.Table) -> pa.Table:
    """(conv_id, bound, leaf) of each suffix: the last depth with a smaller member, and whether the sequence ends in a leaf here; and
    (conv_id, depth, children, ends) of the heads that continue another container."""
    x = Levels(t)
    bound, leaf = np.full(t.num_rows, -1), np.zeros(t.num_rows, bool)
    last, k, ends = x.rows["last"].to_numpy(zero_copy_only=False), x.rows["k"].to_numpy(), x.rows["ends"].to_pylist()
    for j, level in enumerate(x.at):
        a = level["alive"]
        bound[a] = np.where(x.conv[a] != level["low"][level["run"]], x.depth[a] + j, bound[a])
        over = (x.left[a] == j) & last[a]
        leaf[a[over]] = level["children"][level["run"][over]] == 0
    top = x.at[0]
    told: list[str | None] = [None] * len(top["starts"])
    for i in np.flatnonzero((x.left == 0) & last).tolist():
        told[top["run"][i]] = ends[i]
    heads = top["alive"][top["starts"]]
    goes_on = (k[heads] > 0) & (x.off[heads] == 0)
    none = lambda n, kind: pa.nulls(n, kind)
    n, m = t.num_rows, int(goes_on.sum())
    return pa.table({
        "conv_id": pa.chunked_array([pa.array(x.conv, pa.int64()), pa.array(top["low"][goes_on], pa.int64())]),
        "bound": pa.chunked_array([pa.array(bound, pa.int64()), none(m, pa.int64())]), "leaf": pa.chunked_array([pa.array(leaf), none(m, pa.bool_())]),
        "depth": pa.chunked_array([none(n, pa.int64()), pa.array(x.depth[heads][goes_on], pa.int64())]),
        "children": pa.chunked_array([none(n, pa.int64()), pa.array(top["children"][goes_on], pa.int64())]),
        "ends": pa.chunked_array([none(n, pa.string()), pa.array([e for e, g in zip(told, goes_on.tolist()) if g], pa.string())]),
    })


def nodes(t: pa.Table) -> pa.Table:
    """The nodes of a shard's containers; a head that continues another container is that one's node."""
    x = Levels(t)
    words = t["words"].combine_chunks()
    summed = np.concatenate(([0], np.cumsum(words.flatten().to_numpy())))
    get = lambda c: x.rows[c].to_numpy(zero_copy_only=False)
    copies, after, owned_from, owned, leaf, last, k = (get(c) for c in ("copies", "after", "bound", "owned", "leaf", "last", "k"))
    parents, ends = x.rows["parent"].to_pylist(), x.rows["ends"].to_pylist()
    out = {c.split()[0]: [] for c in NODE.split(", ")}
    for j, level in enumerate(x.at):
        a, s = level["alive"], level["starts"]
        from_turn = x.first[a] + j - ((x.off[a] > 0) | (j > 0))
        below = summed[x.end[a]] - summed[from_turn] + after[a]
        saved = copies[a] * below - np.where(x.depth[a] + j <= owned_from[a], owned[a], below)
        told = [EMPTY_SHA] * len(s)
        for i in np.flatnonzero((x.left[a] == j) & last[a]).tolist():
            told[level["run"][i]] = ends[a[i]]
        kept = np.full(len(s), True) if j else (x.off[a[s]] > 0) | (k[a[s]] == 0)
        sums = [np.add.reduceat(v, s) for v in (copies[a], leaf[a].astype(np.int64), saved)]
        columns = (level["low"], x.depth[a[s]] + j, level["parent"] if j else [parents[i] for i in a[s].tolist()], sums[0], level["children"], sums[1], sums[2], told)
        for name, column in zip(out, columns):
            out[name] += [v for v, g in zip(column.tolist() if isinstance(column, np.ndarray) else column, kept.tolist()) if g]
    return pa.table(out, schema=pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in NODE.split(", ")]))


def trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """``NODE`` of every distinct prefix of the conversations (conv_id, place, id, words), (conv_id, length)."""
    spark = rows.sparkSession
    items = common.stored(suffixes(rows, lengths), "first-suffixes")
    n = items.count()
    contained, rounds = burst(items)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // SHARD), min(partitions, n // 64))
    dealt = contained.withColumn("shard", F.pmod(F.xxhash64(*HEAD), F.lit(shards)))
    found = common.stored(dealt.groupBy("shard").applyInArrow(claims, "conv_id long, bound long, leaf boolean, depth long, children long, ends string"), "claims")
    ended = lambda c: F.max(F.when((F.col("off") == F.size("ids")) & F.col("last"), F.col(c)))
    bounds, heads = [found.filter("bound IS NOT NULL").select("conv_id", "bound", "leaf")], [found.filter("depth IS NOT NULL").select("conv_id", "depth", "children", "ends")]
    counted = []
    for r in rounds:  # distinct sequences share a burst head, so none ends there in a leaf
        bounds.append(r.select("conv_id", F.when(F.col("conv_id") != F.col("low"), F.col("depth")).otherwise(-1).alias("bound"), F.lit(False).alias("leaf")))
        step = r.filter(F.col("off") < F.size("ids")).select("low", "depth", F.element_at("ids", F.col("off") + 1).alias("turn")).distinct()
        counted.append(step.groupBy("low", "depth").agg(F.count("*").alias("children")))
        top = r.filter("k > 0 AND off = 0").groupBy("low", "depth").agg(ended("ends").alias("ends")).join(counted[-1], ["low", "depth"], "left")
        heads.append(top.select(F.col("low").alias("conv_id"), "depth", F.coalesce("children", F.lit(0)).alias("children"), "ends"))
    claim = common.stored(_union(bounds).groupBy("conv_id").agg(F.max("bound").alias("bound"), F.bool_or("leaf").alias("leaf")), "bounds")
    passed = F.greatest(F.lit(0), F.least(F.size("ids"), (F.col("bound") - F.col("depth")).cast("int")))
    own = items.join(claim, "conv_id").select("conv_id", F.aggregate(F.slice("words", passed + 1, F.size("ids")), F.lit(0).cast("long"), lambda a, w: a + w).alias("w"))
    claim = common.stored(claim.join(own.groupBy("conv_id").agg(F.sum("w").alias("owned")), "conv_id"), "owners")
    all_nodes = [dealt.join(claim, "conv_id").groupBy("shard").applyInArrow(nodes, NODE)]
    for r, children in zip(rounds, counted):
        seen = F.when(F.col("off") > 0, F.col("off")).otherwise(1)  # the words of the head's own turn count, the root has none
        below = F.aggregate(F.slice("words", seen, F.size("ids")), F.lit(0).cast("long"), lambda a, w: a + w) + F.col("after")
        saved = F.col("copies") * F.col("below") - F.when(F.col("depth") <= F.col("bound"), F.col("owned")).otherwise(F.col("below"))
        inner = r.filter("k = 0 OR off > 0").join(claim, "conv_id").withColumn("below", below)
        per = inner.groupBy("low", "depth").agg(
            F.max("parent").alias("parent_conv_id"), F.sum("copies").alias("n_convs"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"), F.sum(saved).alias("saved_tokens"),
            F.coalesce(ended("ends"), F.lit(EMPTY_SHA)).alias("ends_sha256"))
        per = per.join(children, ["low", "depth"], "left")
        all_nodes.append(per.select(F.col("low").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256"))
    made = common.stored(_union(all_nodes), "nodes")
    border = (F.col("depth") % SEGMENT == 0) & (F.col("depth") > 0)
    more = made.filter(border).join(_union(heads).withColumnRenamed("ends", "more_ends"), ["conv_id", "depth"], "left") \
        .withColumn("n_children", F.col("n_children") + F.coalesce("children", F.lit(0))).withColumn("ends_sha256", F.coalesce("more_ends", "ends_sha256"))
    return made.filter(~border).unionByName(more.select(made.columns))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the contract's rebuilt conversations."""
    return trie(*rebuilt(conversations))


# crc32 bit by bit over the decimal digits (fixed values: the start, the reversed polynomial)
ORACLE = """
WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM raw),
c AS (SELECT conv_id, max(place) AS n, conv_id - conv_id % 20 AS first, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
  string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 4 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.place AS d, t.role, t.text FROM c JOIN t ON t.conv_id = c.first AND t.place <= c.h
  UNION ALL SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(p.n, 0)), t.role, t.text FROM c JOIN t USING (conv_id) LEFT JOIN c p ON p.conv_id = c.first WHERE t.place > c.h),
k AS (SELECT conv_id, d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w,
  sha256(string_agg(sha256(role) || sha256(text), '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(d) AS length FROM k GROUP BY conv_id),
n AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
  sha256(coalesce(string_agg(CASE WHEN length = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM k JOIN l USING (conv_id) GROUP BY d, key),
up AS (SELECT n.conv_id, n.d, pk.key AS pkey, p.conv_id AS parent FROM n JOIN k pk ON pk.conv_id = n.conv_id AND pk.d = n.d - 1 JOIN n p ON p.d = pk.d AND p.key = pk.key),
kids AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM up GROUP BY ALL),
full_n AS (SELECT n.*, up.parent, coalesce(kids.n_children, 0) AS n_children FROM n LEFT JOIN up ON up.conv_id = n.conv_id AND up.d = n.d
  LEFT JOIN kids ON kids.parent = n.conv_id AND kids.d = n.d),
sub AS (SELECT a.d, a.key, sum((u.n_convs - 1) * u.w) AS saved_tokens, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM full_n u JOIN k a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.d, a.key)
SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM full_n JOIN sub USING (d, key)
"""
