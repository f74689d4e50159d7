"""Quality rules: a hashed n-gram log-likelihood ratio beside counted rules, in DataFrame functions only.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials are counted over all documents: the trusted
target (documents labelled quality 1) and the raw corpus. A document's ratio is the mean over its n-grams of
log p_target / p_raw, with ``PRIOR`` n-grams of ratio 0 added, so that a few words decide nothing. A document stays when
the base rules pass and the ratio is at least ``THRESHOLD``.

Windows of five words are compared by their 64-bit XXH64 chain within one text. Defined results: null text is empty
(0 words, base failed); rows that repeat are judged each; of labels that repeat a doc_id the largest counts; without
trusted rows every ratio is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import common

BUCKETS, PRIOR, THRESHOLD = 1 << 14, 8, -0.06
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
SYMBOLS = r"[#*$%&|<>]"


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("w", F.regexp_extract_all("text", F.lit(common.WORD), F.lit(0)))


def ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log p_target / p_raw of each bucket, both with one added to every bucket."""
    trusted = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q")) \
        .filter("q = 1").select(F.col("doc_id").alias("t_id"))
    trusted = common.small(trusted, trusted.count(), 16)
    x = words(docs).join(trusted, F.col("doc_id") == F.col("t_id"), "left").select(F.col("t_id").isNotNull().cast("long").alias("t"), "w")
    x = x.select("t", F.explode(F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))).alias("b"))).alias("g"))
    x = x.select("t", _bucket(F.col("g.a")).alias("one"), F.when(F.col("g.b").isNotNull(), _bucket(F.col("g.a"), F.col("g.b"))).alias("two"))
    x = x.select("t", F.expr("stack(2, one, two) AS bucket")).filter("bucket IS NOT NULL")
    target, raw = [1] * BUCKETS, [1] * BUCKETS
    for r in x.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("t").alias("t")).collect():  # BUCKETS rows at most
        raw[r["bucket"]] += r["n"]
        target[r["bucket"]] += r["t"]
    nt, nr = sum(target), sum(raw)
    if nt == BUCKETS:
        return [0.0] * BUCKETS
    return [math.log(t / nt) - math.log(r / nr) for t, r in zip(target, raw)]


def counts(x: DataFrame) -> DataFrame:
    """The base counts beside ``w``."""
    starts = F.sequence(F.lit(0), F.size("w") - WINDOW)
    h = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("w"), i + k) for k in range(WINDOW)]))
    x = x.withColumn("n_words", F.size("w").cast("long")).withColumn("h", F.when(F.size("w") >= WINDOW, h))
    found = F.expr("""CASE WHEN h IS NOT NULL AND size(array_distinct(h)) < size(h)
        THEN sort_array(transform(h, (v, i) -> struct(v AS v, i AS i))) END""")
    x = x.withColumn("s", found)
    at = F.expr("""sort_array(transform(filter(s, (x, k) -> (k > 0 AND get(s, k - 1).v = x.v) OR (k < size(s) - 1 AND get(s, k + 1).v = x.v)),
        x -> x.i))""")
    x = x.withColumn("at", F.when(F.col("s").isNotNull(), at))
    repeat = F.expr(f"aggregate(transform(at, (p, k) -> least({WINDOW}, coalesce(get(at, k + 1) - p, {WINDOW}))), 0L, (a, b) -> a + b)")
    x = x.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda line: line.rlike(common.WORD)))
    return x.select(
        "doc_id", "w", "n_words", F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeat, F.lit(0)).cast("long").alias("n_repeat_words"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the ratio (llr) of every document."""
    # a string that is split once, when the plan is made: an array constant without BUCKETS expressions
    table = F.split(F.lit(",".join(repr(round(v, 6)) for v in ratios(docs, labels))), ",").cast("array<double>")
    x = counts(words(docs))
    pair = lambda i: F.when(i > 0, F.get(table, _bucket(F.get(F.col("w"), i - 1), F.get(F.col("w"), i)))).otherwise(F.lit(0.0))
    total = F.aggregate(F.sequence(F.lit(0), F.size("w") - 1), F.lit(0.0),
                        lambda acc, i: acc + F.get(table, _bucket(F.get(F.col("w"), i))) + pair(i))
    llr = F.when(F.size("w") > 0, total / (2 * F.size("w") - 1 + PRIOR)).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    x = x.withColumn("llr", llr).withColumn("base_failed", failed)
    return x.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "llr")
