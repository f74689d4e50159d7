"""Sinks (S15, S16): published tables as Parquet folders, all of a run or none.

A ``Publication`` writes its tables into a run folder of its own, ``<out>/runs/<id>/<table>``, which
no reader looks at. ``commit`` writes the list of the tables to a scratch file and renames it to the
next number under ``<out>/manifests``; readers take the highest number there. So the new set appears
with one rename, a run that dies before it leaves the old set as it was, and a reader that has
resolved a set keeps reading it while another one is published. ``drop_old`` removes run folders that no
kept manifest names. Everything goes through the Hadoop file system of the path; a lost executor only
re-runs its own tasks of a write.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortkit.sources.files import write_text

MANIFESTS, RUNS = "manifests", "runs"


def write_table(df: DataFrame, path: str, sort_within: list[str] | None = None, mode: str = "overwrite") -> str:
    """One table as a Parquet folder, rows sorted within each file (O1). Overwriting removes the old
    files first; use a ``Publication`` where readers must never see that."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode(mode).parquet(path)
    return path


def write_clustered(df: DataFrame, path: str, by: list[str]) -> str:
    """One table as a Parquet folder in ranges of ``by``, sorted within each file (O1): no two files overlap, so the
    statistics of files and row groups lead a read of one patient to its rows. The ranges of several columns also split
    a patient with very many rows. ``df`` should be stored already: Spark reads it twice, once to sample the bounds."""
    return write_table(df.repartitionByRange(*by), path, by, mode="error")


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifests(spark: SparkSession, out_dir: str) -> dict[int, str]:
    """Number -> path of the committed manifests."""
    fs, where = _fs(spark, f"{out_dir}/{MANIFESTS}")
    if not fs.exists(where):
        return {}
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(where)]
    return {int(n.removesuffix(".json")): p for n, p in names if n.endswith(".json") and n.removesuffix(".json").isdigit()}


def _read_manifest(spark: SparkSession, path: str) -> dict:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def published(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Table name -> path of the set published last; empty if there is none."""
    found = _manifests(spark, out_dir)
    if not found:
        return {}
    manifest = _read_manifest(spark, found[max(found)])
    return {name: f"{out_dir}/{RUNS}/{manifest['run']}/{name}" for name in manifest["tables"]}


def read_published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    tables = published(spark, out_dir)
    if name not in tables:
        raise FileNotFoundError(f"{out_dir} has no published table {name}")
    return spark.read.parquet(tables[name])


class Publication:
    """The tables of one run; they become visible together. ``clustered`` (table -> columns) and ``bucketed`` (table -> column)
    name the tables that ``write`` stores by ``write_clustered`` and ``write_bucketed``."""

    def __init__(self, spark: SparkSession, out_dir: str, clustered: dict[str, list[str]] | None = None,
                 bucketed: dict[str, str] | None = None) -> None:
        self.spark, self.out_dir = spark, out_dir.rstrip("/")
        self.clustered, self.bucketed = clustered or {}, bucketed or {}
        self.run = uuid.uuid4().hex
        self.tables: dict[str, str] = {}
        self.entries: list[str] = []

    def _path(self, name: str) -> str:
        if name in self.tables:
            raise ValueError(f"table {name} is written twice")
        self.tables[name] = f"{self.out_dir}/{RUNS}/{self.run}/{name}"
        return self.tables[name]

    def write(self, name: str, df: DataFrame, sort_within: list[str] | None = None) -> DataFrame:
        """Writes a table of this run and returns it as stored."""
        if name in self.clustered:
            return self.write_clustered(name, df, self.clustered[name])
        if name in self.bucketed:
            return self.write_bucketed(name, df, self.bucketed[name])
        path = write_table(df, self._path(name), sort_within, mode="error")
        return self.spark.read.schema(df.schema).parquet(path)

    def write_clustered(self, name: str, df: DataFrame, by: list[str]) -> DataFrame:
        """Writes a table of this run in ranges of ``by`` and returns it as stored. The rows are stored as they come
        first, so that finding the ranges does not run the plan of ``df`` a second time."""
        path = self._path(name)
        first = write_table(df, f"{self.out_dir}/{RUNS}/{self.run}/_{name}", mode="error")
        write_clustered(self.spark.read.schema(df.schema).parquet(first), path, by)
        fs, where = _fs(self.spark, first)
        fs.delete(where, True)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, name: str, df: DataFrame, by: str, buckets: int | None = None) -> DataFrame:
        """Writes a table of this run in ``buckets`` buckets of ``by`` (the session's shuffle partitions if not given) and
        returns it as stored: tables of equal buckets join and group by ``by`` without another shuffle. The catalog entry
        that tells Spark of the buckets is dropped by ``commit`` or ``release``; the files stay."""
        path, table = self._path(name), f"run_{self.run}_{name}"
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(buckets, by).sortBy(by).format("parquet").option("path", path).mode("error").saveAsTable(table)
        self.entries.append(table)
        return self.spark.table(table)

    def release(self) -> None:
        """Drops the catalog entries of this run's bucketed tables."""
        for table in self.entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.entries.clear()

    def commit(self) -> dict[str, str]:
        """Publishes the tables; of two runs that commit at once the later one gets the higher number."""
        fs, scratch = _fs(self.spark, f"{self.out_dir}/{MANIFESTS}/.{self.run}.tmp")
        write_text(self.spark, scratch.toString(), json.dumps({"run": self.run, "tables": sorted(self.tables)}))
        while True:
            number = max(_manifests(self.spark, self.out_dir), default=0) + 1
            _, target = _fs(self.spark, f"{self.out_dir}/{MANIFESTS}/{number:012d}.json")
            if not fs.exists(target) and fs.rename(scratch, target):
                self.release()
                return dict(self.tables)


def drop_old(spark: SparkSession, out_dir: str, keep: int = 1) -> list[str]:
    """Removes the manifests but the last ``keep`` (one at least), and the run folders that these do not name;
    returns the runs removed. Not to be called while a run is being written."""
    found = _manifests(spark, out_dir)
    kept = sorted(found)[-max(1, keep):]
    if not kept:
        return []
    runs = {_read_manifest(spark, found[k])["run"] for k in kept}
    for k in sorted(set(found) - set(kept)):
        fs, where = _fs(spark, found[k])
        fs.delete(where, False)
    fs, where = _fs(spark, f"{out_dir}/{RUNS}")
    removed = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName() not in runs]
    for path in removed:
        fs.delete(path, True)
    return sorted(p.getName() for p in removed)
