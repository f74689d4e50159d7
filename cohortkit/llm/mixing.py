"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source gets a target number of words. Its documents are dealt to shards by hash, laid end to end in a seeded order
and cut into blocks of ``BLOCK_WORDS`` words. Blocks are seats: the highest quotients words / (2k + 1) give each source,
then each of its shards, an integer quota of blocks. A shard with n blocks takes every block ``quota div n`` times, and
``quota mod n`` of them, picked by a seeded affine permutation, once more.

Only one row per source passes through the driver. Repeated rows are laid out as one item with a count, so a row that is
repeated often does not fill one shard. Defined results: null text has size 0; sources go by code point, null last;
a source without words has target 0; an empty table gives an empty result; reruns agree.
"""

from __future__ import annotations

import heapq
import math
import random
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cohortkit.llm import common
from cohortkit.llm.common import pieces as cut

BLOCK_WORDS = 256
SHARD_ITEMS = 4_096
WEIGHTS = (3, 1, 2)
SHARE, MOST, SEED = 1.5, 2, 20240229
RE_WORD = re.compile(common.WORD)
KEYS = ["doc_id", "source", "size", "text_hash"]


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """``total`` shared by weight; a share stops at ``most`` times its size and the excess is reshared by weight."""
    out, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2k + 1), at most ``most`` each; ties go to the first.

    All but a few seats come from a divisor found by bisection, so the cost does not grow with the seats.
    """
    seats = min(seats, sum(m for v, m in zip(votes, most) if v > 0))
    at = lambda d: [min(m, int(v / d + 0.5)) if v > 0 else 0 for v, m in zip(votes, most)]
    lo, hi = 0.0, 2 * max(votes, default=0.0) + 1  # at hi nobody has a seat
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if sum(at(mid)) > seats else (lo, mid)
    out = at(hi)
    heap = [(-v / (2 * out[i] + 1), i) for i, v in enumerate(votes) if v > 0 and out[i] < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def _quotas(pdf: pd.DataFrame) -> pd.DataFrame:
    """Quota and seeded permutation of each shard of one source."""
    pdf = pdf.sort_values("shard")
    blocks = [-(-int(w) // BLOCK_WORDS) for w in pdf["words"]]
    given = sainte_lague([float(w) for w in pdf["words"]], int(pdf["seats"].iloc[0]), [MOST * b for b in blocks])
    rows = []
    for shard, n, q in zip(pdf["shard"], blocks, given):
        r = random.Random(f"{SEED}/{pdf['src'].iloc[0]}/{shard}")
        a = next(x for x in iter(lambda: r.randrange(1, n + 1) if n else 1, None) if math.gcd(x, n) <= 1)
        rows.append((int(pdf["src"].iloc[0]), int(shard), n, q, a, r.randrange(n) if n else 0))
    return pd.DataFrame(rows, columns=["src", "shard", "n", "q", "a", "c"])


def plan(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per document (repeats included): KEYS, source_size, target, taken and its place [s, e) in the shard's layout."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       common.word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    items = common.stored(rows.groupBy(*KEYS).agg(F.count("*").alias("m")), "mix-items")
    per = items.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("w"), F.count("*").alias("k")).collect()
    per.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    total = sum(r["w"] for r in per)
    goal = targets([r["w"] for r in per], [weights[i % len(weights)] for i in range(len(per))], share * total)
    blocks = [-(-r["w"] // BLOCK_WORDS) for r in per]
    votes = [g * b * BLOCK_WORDS / r["w"] if r["w"] else 0.0 for g, b, r in zip(goal, blocks, per)]  # as if the last block were full
    seats = sainte_lague(votes, round(sum(votes) / BLOCK_WORDS), [MOST * b for b in blocks])
    sources = spark.createDataFrame(
        [(i, r["source"], r["w"], goal[i], seats[i], max(1, -(-r["k"] // SHARD_ITEMS))) for i, r in enumerate(per)],
        "src int, name string, source_size long, target double, seats long, shards long")
    x = items.join(common.small(sources, len(per), 100), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    x = x.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id", "text_hash")).withColumn("shard", F.pmod("h", "shards"))
    laid = F.sum(F.col("size") * F.col("m")).over(W.partitionBy("src", "shard").orderBy("h", *KEYS[:1], *KEYS[2:]).rowsBetween(W.unboundedPreceding, -1))
    quotas = x.groupBy("src", "shard").agg(F.sum(F.col("size") * F.col("m")).alias("words"), F.max("seats").alias("seats")) \
        .groupBy("src").applyInPandas(_quotas, "src int, shard long, n long, q long, a long, c long")
    x = x.withColumn("base", F.coalesce(laid, F.lit(0))).join(common.stored(quotas, "mix-quotas"), ["src", "shard"])
    x = x.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    x = x.withColumn("s", F.col("base") + F.col("copy") * F.col("size")).withColumn("e", F.col("s") + F.col("size"))
    taken = F.expr(f"""CASE WHEN size = 0 THEN 0L ELSE aggregate(sequence(s div {BLOCK_WORDS}, (e - 1) div {BLOCK_WORDS}), 0L, (acc, b) ->
        acc + (least(e, (b + 1) * {BLOCK_WORDS}) - greatest(s, b * {BLOCK_WORDS})) * (q div n + IF(pmod(a * b + c, n) < pmod(q, n), 1, 0))) END""")
    return x.withColumn("taken", taken).select(*KEYS, "source_size", "target", "taken", "copy", "s", "e", "n", "q", "a", "c")


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def pieces(text: str, s: int, e: int, n: int, q: int, a: int, c: int) -> list[str]:
    """What the mix takes of a text laid at words [s, e): in each pass, the runs of blocks that this pass still takes."""
    out: list[str] = []
    if e <= s:
        return out
    ends: list[tuple[int, int]] = []
    for k in range(1, MOST + 1):
        runs: list[list[int]] = []
        for b in range(s // BLOCK_WORDS, (e - 1) // BLOCK_WORDS + 1):
            if q // n + ((a * b + c) % n < q % n) >= k:
                lo, hi = max(s, b * BLOCK_WORDS) - s, min(e, (b + 1) * BLOCK_WORDS) - s
                if runs and runs[-1][1] == lo:
                    runs[-1][1] = hi
                else:
                    runs.append([lo, hi])
        for lo, hi in runs:
            if hi - lo == e - s:
                out.append(text)
            else:
                ends = ends or [m.span() for m in RE_WORD.finditer(text)]
                out.append(text[ends[lo][0]: ends[hi - 1][1]])
    return out


def apply_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the taken runs of every document as rows with the columns of ``docs`` (text and n_chars renewed)."""
    p = common.stored(plan(docs).filter("taken > 0").select(*[F.col(k).alias(f"{k}__") for k in KEYS], "copy", "s", "e", "n", "q", "a", "c"), "mix-plan")
    keys = {"doc_id__": F.col("doc_id").cast("long"), "source__": F.col("source").cast("string"),
            "size__": common.word_count(F.col("text")), "text_hash__": F.xxhash64("text")}
    fields = docs.schema.fields
    whole = common.fresh(docs, "whole")
    one = docs.select(F.struct(*docs.columns).alias(whole), *[v.alias(f"k{i}") for i, v in enumerate(keys.values())])
    if not p.filter("copy > 0").isEmpty():  # repeated rows: the plan has a row for each, so one of them brings the text
        one = one.dropDuplicates([f"k{i}" for i in range(len(keys))])
    cond = [F.col(f"k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)]
    joined = one.join(p, cond[0] & cond[1] & cond[2] & cond[3]).select(f"{whole}.*", *[F.col(x).alias(f"__{x}") for x in "senqac"])
    names = [f.name for f in fields]
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut(batches):
            take, texts = [], []
            for i, (t, *place) in enumerate(zip(b.column(at).to_pylist(), *(b.column(len(names) + j).to_pylist() for j in range(6)))):
                got = pieces(t, *place)
                texts += got
                take += [i] * len(got)
            cols = [b.column(j).take(pa.array(take, pa.int64())) for j in range(len(names))]
            cols[at] = pa.array(texts, b.column(at).type)
            if chars >= 0:
                cols[chars] = pa.array([len(t) for t in texts], pa.int64()).cast(b.column(chars).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, T.StructType(fields))
