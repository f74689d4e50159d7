"""Schema census (S1-S4): names and types of many files in one distributed pass.

Parquet footers and CSV headers are read by tasks, many files each, and reduced to one row per
signature with its paths, so the number of Spark jobs does not depend on the number of files. The
tasks open local, HDFS, S3, GCS and Azure paths themselves; files of any other scheme, which only
Hadoop's file systems reach, have their footers read through those by threads of the driver, again
without a Spark job. Types come from the footer: a column counts as nanoseconds by its logical
type, never by its values.

Whether a CSV file has quoted line breaks is counted by Spark over its lines: a file with a line
that holds an odd number of quotes is read in multi-line mode (one task a file), all others are
split like any text file.
"""

from __future__ import annotations

import csv
import gzip
import io
import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# (kind, (name, type) of each column); kinds: parquet, nanos (Parquet with nanosecond timestamps), csv, csv_breaks
Signature = tuple[str, tuple[tuple[str, str], ...]]
NANOS = "timestamp in nanoseconds"
FILES_PER_TASK = 256
DRIVER_THREADS = 16
TASK_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def is_csv(path: str) -> bool:
    low = path.lower()
    return low.endswith(".csv") or low.endswith(".csv.gz")


def scheme(path: str) -> str:
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return m[1].lower() if m else "file"


def plain(path: str) -> str:
    """One form for Hadoop's and Spark's spelling of a path (``file:/a b``, ``file:///a%20b``)."""
    return re.sub(r"^file:/+", "file:/", unquote(path))


def _census_task(schemes: dict[str, str], nanos: str):
    """The function of a census task; it names nothing of this package, which executors need not have."""
    def header(stream) -> list[tuple[str, str]]:
        text = io.TextIOWrapper(stream, "utf-8-sig", newline="")
        return [(c, "string") for c in next(csv.reader(text), [])]

    def one(path: str) -> str:
        import pyarrow.parquet as pq
        from pyarrow import fs

        kind, _, rest = path.partition(":")
        if kind == "file" or not rest:
            where, name = fs.LocalFileSystem(), re.sub(r"^/+", "/", rest or path)
        else:
            where, name = fs.FileSystem.from_uri(f"{schemes[kind.lower()]}:{rest}")
        low = name.lower()
        with where.open_input_file(name) as f:
            if low.endswith(".csv"):
                return json.dumps(["csv", header(f)])
            if low.endswith(".csv.gz"):
                return json.dumps(["csv", header(gzip.GzipFile(fileobj=f))])
            schema = pq.ParquetFile(f).schema
        leaves: dict[str, list[str]] = {}
        for i in range(len(schema)):
            c = schema.column(i)
            logical = str(c.logical_type)
            kind = nanos if "timeUnit=nanoseconds" in logical and c.path == c.name else f"{c.physical_type} {logical} {c.length}"
            leaves.setdefault(c.path.split(".")[0], []).append(kind if c.path == c.name else f"{c.path} {kind}")
        columns = [(n, ", ".join(v)) for n, v in leaves.items()]
        return json.dumps(["nanos" if any(t == nanos for _, t in columns) else "parquet", columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, errors = [], []
            for path in b.column(0).to_pylist():
                try:
                    found.append(one(path))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001 - raised on the driver, or reported in a profile
                    found.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), pa.array(errors, pa.string())], ["path", "signature", "error"])

    return run


def _through_hadoop(spark: SparkSession, path: str) -> Signature:
    """The signature of a file that only Hadoop's file systems reach."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    if is_csv(path):
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(re.sub(r"([\[\]{}*?\\])", r"\\\1", path))
        return "csv", tuple((c.lstrip("﻿"), "string") for c in df.columns)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(where, conf))
    try:
        fields = reader.getFooter().getFileMetaData().getSchema().getFields()
        columns = tuple((f.getName(), NANOS if f.isPrimitive() and "TIMESTAMP(NANOS" in f.toString() else f.toString()) for f in fields)
    finally:
        reader.close()
    return ("nanos" if any(t == NANOS for _, t in columns) else "parquet"), columns


def signatures(spark: SparkSession, paths: list[str]) -> dict[str, Signature | str]:
    """The signature of each file, or the text of the error that kept it from being read."""
    near, far = [p for p in paths if scheme(p) in TASK_SCHEMES], [p for p in paths if scheme(p) not in TASK_SCHEMES]
    out: dict[str, Signature | str] = {}
    if near:
        tasks = min(-(-len(near) // 8), max(spark.sparkContext.defaultParallelism, -(-len(near) // FILES_PER_TASK)))
        listed = spark.createDataFrame(pa.table({"path": near})).repartition(tasks)
        read = listed.mapInArrow(_census_task(TASK_SCHEMES, NANOS), "path string, signature string, error string")
        for row in read.groupBy("signature", "error").agg(F.collect_list("path").alias("paths")).collect():
            got: Signature | str = row["error"]
            if row["signature"]:
                kind, columns = json.loads(row["signature"])
                got = (kind, tuple((n, t) for n, t in columns))
            out.update({p: got for p in row["paths"]})

    def ask(path: str) -> Signature | str:
        try:
            return _through_hadoop(spark, path)
        except Exception as exc:  # noqa: BLE001 - raised by the caller, or reported in a profile
            return f"{type(exc).__name__}: {exc}"

    if far:
        with ThreadPoolExecutor(DRIVER_THREADS) as pool:
            out.update(zip(far, pool.map(ask, far)))
    return out


def with_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """The CSV files (``plain`` paths) in which a quoted field goes over a line break: one pass over their lines."""
    if not paths:
        return set()
    lines = spark.read.text([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]).select("value", F.col("_metadata.file_path").alias("path"))
    odd = lines.filter(F.regexp_count("value", F.lit('"')) % 2 == 1).select("path").distinct()
    return {plain(r["path"]) for r in odd.collect()}


def group_by_signature(spark: SparkSession, paths: list[str]) -> "OrderedDict[Signature, list[str]]":
    """Files with equal schema (or CSV header and reader) together, in the order of ``paths``; a file that cannot be read raises."""
    found = signatures(spark, paths) if paths else {}
    for path in paths:
        if isinstance(found[path], str):
            raise ValueError(f"{path}: {found[path]}")
    broken = with_breaks(spark, [p for p in paths if found[p][0] == "csv"])
    groups: "OrderedDict[Signature, list[str]]" = OrderedDict()
    for path in paths:
        kind, columns = found[path]
        groups.setdefault(("csv_breaks" if kind == "csv" and plain(path) in broken else kind, columns), []).append(path)
    return groups
