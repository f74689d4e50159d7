"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by whole digests.

A rule is (host, path, action). It fits its host and all subdomains when the URL's path starts with the rule's path; the
longest rule wins, at equal length the longer host, then block before allow. Every distinct (host, path) is expanded
into the expressions that some rule could equal: host suffixes of up to as many labels as the longest rule host, times
path prefixes of the lengths that occur among rules. Expressions meet the rules by the first 8 hex digits of their
SHA-256; a candidate counts when the whole digests agree.

Defined results: a null URL or one without ``://`` has empty host and path and the default verdict; null page ids and
repeated rows stay as they are; no rules or no pages give no matches or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import common

PREFIX_DIGITS = 8
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    part = lambda i: F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i)
    return (F.coalesce(common.ascii_lower(part(1)), F.lit("")), F.coalesce(part(2), F.lit("")))


def hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules with digest, short prefix and precedence; equal rules are merged, block first."""
    r = rules.groupBy(F.col("host").alias("r_host"), F.col("path").alias("r_path")).agg(F.max("action").alias("action"))
    r = r.select(F.concat("r_host", "r_path").alias("rule"), "r_host", "r_path", "action")
    r = r.withColumn("digest", F.sha2("rule", 256))
    return r.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))


def expressions(urls: DataFrame, max_labels: int, path_lengths: list[int]) -> DataFrame:
    """Each (host, path) with the expressions that a rule could equal."""
    suffixes = F.expr(f"""transform(sequence(1, least(size(labels), {max_labels})),
        i -> array_join(slice(labels, size(labels) - i + 1, i), '.'))""")
    lengths = F.array(*[F.lit(n) for n in path_lengths])
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))
    x = urls.withColumn("labels", F.split("host", r"\.", -1)).withColumn("suffix", F.explode(suffixes))
    x = x.withColumn("prefix", F.explode(prefixes))
    return x.select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("x_digest")) \
        .withColumn("x_short", F.substring("x_digest", 1, PREFIX_DIGITS))


def filter_urls(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``keep`` columns of every page with host, path, rule and verdict."""
    host, path = host_path(F.col(url))
    rows = pages.select(*[F.col(c).alias(f"keep_{c}") for c in keep], host.alias("host"), path.alias("path"))
    size = rules.agg(F.count("*").alias("n"), F.max(F.length("host") + F.length("path")).alias("w"),
                     F.max(F.size(F.split("host", r"\.", -1))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    held = common.small(hashed_rules(rules), size["n"], 2 * (size["w"] or 0) + 120)
    asked = expressions(rows.select("host", "path").distinct(), size["labels"] or 1, sorted(size["lengths"]) or [0])
    hits = asked.join(held, asked["x_short"] == held["short"]).filter(F.col("x_digest") == F.col("digest"))
    rank = F.struct(F.length("rule"), F.length("r_host"), F.col("action"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), rank).alias("hit"))
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"keep_{c}").alias(c) for c in keep], "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", F.lit(default)).alias("verdict"))


def contract_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, action string")


ORACLE = """
WITH u AS (SELECT page_id, CASE WHEN url IS NOT NULL AND position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u),
w AS (SELECT page_id, host, path, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM w
"""
