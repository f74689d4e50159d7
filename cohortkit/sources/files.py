"""File sources (S1-S4, S6, S7, S13) and the code-map CSV reader.

Column resolution must follow each file's own schema (T8), so files are grouped by schema and
every group is read once with ``spark.read.parquet(*paths)`` (or ``csv``); groups are
standardized to the fixed schema and unioned. The driver only handles the file listing and one
schema per group (``census``).

* Listing goes through the Hadoop file system of the path, so it sees what Spark's readers can
  open (local, HDFS, object stores), takes the plain files of the folder only, and raises on
  any error but a missing folder.
* Spark's readers ignore files whose names start with ``_``. A file of that kind which holds
  bytes is an error that names it (T26); empty ones are commit markers.
* Schemas are read by one distributed pass over footers and headers.
* CSV (``.csv`` / ``.csv.gz``) is read with every column as text (T25), quoted fields may hold
  line breaks and doubled quotes; other suffixes are Parquet (S1). Records that do not fit the
  header keep what they have, as nulls or without the surplus, and are listed by ``csv_rejects``.
* Parquet TIMESTAMP(NANOS), which Spark does not map to a type, is read as a number and made a
  microsecond timestamp, decided by the column's type in the footer.
"""

from __future__ import annotations

import os
import re
import uuid
import weakref
from collections.abc import Iterable
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.dates import parse_birth_date, parse_event_ts
from cohortkit.operators.standardize import patient_id
from cohortkit.sources.census import NANOS, Signature, group_by_signature, is_csv, signatures

# FIXED VALUES: order files whose base name contains one of these are left out
ORDER_EXCLUDED_YEARS = ("2023", "2024", "2025")
# FIXED VALUES: default file pattern of the order, medication and procedure sources
PARQUET_GZIP_PATTERN = "*.parquet.gzip"
# FIXED VALUES: columns that hold dates in the hospital extract
DATE_COLUMNS = ("REC_DATE", "D001KEY", "PerformDate", "BillDate", "D020AT3")
REJECTED = "_rejected_record"


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def list_files(spark: SparkSession, directory: str, pattern: str | None = None) -> list[str]:
    """Sorted plain files of ``directory`` whose names match ``pattern``; never of its subfolders.

    A missing directory gives an empty list. Names starting with ``.`` are left out, as by a
    shell pattern. A file named ``_..`` that holds bytes cannot be read by Spark and raises.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found, unread = [], []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if not status.isFile() or name.startswith(".") or (pattern and not fnmatchcase(name, pattern)):
            continue
        if name.startswith("_"):
            if status.getLen():
                unread.append(name)
        else:
            found.append(status.getPath().toString())
    if unread:
        raise ValueError(f"{directory}: Spark cannot read files whose names start with '_': {', '.join(sorted(unread))}")
    return sorted(found)


def is_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file through the Hadoop file system of its path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _literal(path: str) -> str:
    """``path`` with the characters that Spark's readers would expand as a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


# -- schemas ------------------------------------------------------------------------------------
_NANOS: "weakref.WeakKeyDictionary[SparkSession, SparkSession]" = weakref.WeakKeyDictionary()


def _nanos_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads TIMESTAMP(NANOS) columns as numbers."""
    if spark not in _NANOS:
        _NANOS[spark] = spark.newSession()
        _NANOS[spark].conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return _NANOS[spark]


def _read_csv(spark: SparkSession, paths: list[str], columns: list[str], breaks: bool, rejects: bool = False) -> DataFrame:
    """CSV files with one header, all columns as text; with ``rejects`` also what does not fit, whole, in ``REJECTED``."""
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", breaks).option("escape", '"'))
    named = all(columns) and len({c.lower() for c in columns}) == len(columns)
    if named or rejects:  # the header is known; otherwise Spark makes its names unique
        names = columns if named else [f"_c{i}" for i in range(len(columns))]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *([REJECTED] if rejects else [])]])
        reader = reader.schema(schema).option("enforceSchema", True)
    if rejects:
        reader = reader.option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", False)
    df = reader.csv([_literal(p) for p in paths])
    return df if named or rejects else df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def _nanos_to_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """The nanosecond columns, read as numbers, as microsecond timestamps."""
    for name in columns:
        nanos = F.expr(f"timestampadd(MICROSECOND, `{name}` div 1000, timestamp_ntz'1970-01-01 00:00:00')")
        df = df.withColumn(name, nanos)
    return df


def read_group(spark: SparkSession, paths: list[str], signature: Signature) -> DataFrame:
    """One schema group -> one DataFrame (CSV all-text, Parquet with its own types)."""
    kind, columns = signature
    if kind in ("csv", "csv_breaks"):
        return _read_csv(spark, paths, [c for c, _ in columns], kind == "csv_breaks")
    if kind == "nanos":
        whole = _nanos_session(spark).read.parquet(*[_literal(p) for p in paths])
        return _nanos_to_timestamps(whole, [c for c, t in columns if t == NANOS])
    return spark.read.parquet(*[_literal(p) for p in paths])


def csv_rejects(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_name, first_field, record and reason of every CSV record that does not have its header's number of
    fields or leaves a quote open; a record of blanks alone is none."""
    out = spark.createDataFrame([], "file_name string, first_field string, record string, reason string")
    for (kind, columns), group in group_by_signature(spark, [p for p in paths if is_csv(p)]).items():
        rows = _read_csv(spark, group, [c for c, _ in columns], kind == "csv_breaks", rejects=True)
        record = F.col(REJECTED)
        held = F.coalesce(*[F.col(c) for c in rows.columns[:-1]]).isNotNull() | (F.length(F.trim(record)) > 0)
        bad = rows.withColumn("file_name", F.col("_metadata.file_name")).filter(record.isNotNull() & held)
        fields = F.regexp_count(F.regexp_replace(record, r'"(?:[^"]|"")*"', ""), F.lit(",")) + 1
        reason = F.when(F.regexp_count(record, F.lit('"')) % 2 == 1, "open quote").when(fields < len(columns), "fewer fields").otherwise("more fields")
        out = out.unionByName(bad.select("file_name", F.col(rows.columns[0]).alias("first_field"), record.alias("record"), reason.alias("reason")))
    return out


# -- sources ----------------------------------------------------------------------------------
@dataclass
class FileSources:
    """Sources read from a data lake laid out like the hospital extract.

    ``diagnosis_dir``: every regular file (CSV or Parquet, S2); ``order_dir`` and
    ``medication_dir``: ``*.parquet.gzip`` files, order files of 2023-2025 left out (S3);
    ``procedure_dirs``: operation and surgery files (S4); ``demographic_path``: one file (S7).
    """

    spark: SparkSession
    diagnosis_dir: str | None = None
    order_dir: str | None = None
    medication_dir: str | None = None
    procedure_dirs: tuple[str, ...] = ()
    demographic_path: str | None = None
    pattern: str = PARQUET_GZIP_PATTERN
    excluded_years: tuple[str, ...] = ORDER_EXCLUDED_YEARS
    _memo: dict = field(default_factory=dict, repr=False)

    def _layouts(self, paths: list[str], name: str) -> dict[str, DataFrame]:
        key = (name, *paths)
        if key not in self._memo:  # schemas are read once for each list of files
            self._memo[key] = self._grouped(paths, name)
        return dict(self._memo[key])

    def _grouped(self, paths: list[str], name: str) -> dict[str, DataFrame]:
        out: dict[str, DataFrame] = {}
        for i, (signature, group) in enumerate(group_by_signature(self.spark, paths).items()):
            out[f"{name}_{i}"] = read_group(self.spark, group, signature)
        return out

    def diagnosis_rejects(self) -> DataFrame:
        """The malformed records of the diagnosis CSV files (``csv_rejects``)."""
        return csv_rejects(self.spark, list_files(self.spark, self.diagnosis_dir) if self.diagnosis_dir else [])

    def diagnosis_layouts(self) -> dict[str, DataFrame]:
        if not self.diagnosis_dir:
            return {}
        return self._layouts(list_files(self.spark, self.diagnosis_dir), "diagnosis")

    def medication_files(self) -> list[str]:
        orders = [p for p in (list_files(self.spark, self.order_dir, self.pattern) if self.order_dir else [])
                  if not any(y in base_name(p) for y in self.excluded_years)]
        meds = list_files(self.spark, self.medication_dir, self.pattern) if self.medication_dir else []
        return orders + meds

    def medication_layouts(self) -> dict[str, DataFrame]:
        return self._layouts(self.medication_files(), "medication")

    def procedure_files(self) -> list[str]:
        files: set[str] = set()
        for d in self.procedure_dirs:
            files.update(list_files(self.spark, d, self.pattern))
        return sorted(files)

    def procedure_layouts(self) -> dict[str, DataFrame]:
        return self._layouts(self.procedure_files(), "procedure")

    def profile(self) -> DataFrame:
        """The profile of the procedure folders."""
        return profile_sources(self.spark, self.procedure_dirs, pattern=self.pattern)

    def demographic(self) -> DataFrame:
        if not self.demographic_path:
            return self.spark.createDataFrame([], "ENC_HN string, D020AT3 double")
        paths = list_files(self.spark, self.demographic_path) if is_folder(self.spark, self.demographic_path) else [self.demographic_path]
        frames = [f.select("ENC_HN", "D020AT3") for f in self._layouts(paths, "demographic").values()]
        if len(frames) == 1:
            return frames[0]
        # several types: ids as text by the rule of all sources, birth dates as parsed dates
        return reduce(DataFrame.unionByName, [f.select(patient_id(f).alias("ENC_HN"), parse_birth_date("D020AT3", f.schema["D020AT3"].dataType).alias("D020AT3")) for f in frames])


# -- S13: source profile ------------------------------------------------------------------------
# FIXED VALUE: how a profile reports a file whose schema cannot be read
SCHEMA_ERROR = "SCHEMA_ERROR: "


def profile_sources(spark: SparkSession, directories: Iterable[str], max_files_per_dir: int = 3,
                    pattern: str = "*.parquet*") -> DataFrame:
    """Per directory: file count, the first ``n`` file names and their column lists (the feature
    is a sample). A file whose schema cannot be read yields ``SCHEMA_ERROR: ..``; a missing
    directory profiles as zero files, any other listing error raises."""
    def columns(path: str) -> str:
        got = found[path]
        return f"{SCHEMA_ERROR}{got}" if isinstance(got, str) else ", ".join(name for name, _ in got[1])

    listed = {d: list_files(spark, d, pattern) for d in directories}
    sample = [(d, i + 1, p) for d, files in listed.items() for i, p in enumerate(files[:max_files_per_dir])]
    found = signatures(spark, [p for _, _, p in sample]) if sample else {}
    rows = [(d, len(listed[d]), rank, base_name(p), columns(p)) for d, rank, p in sample]
    rows += [(d, 0, None, None, None) for d, files in listed.items() if not files]
    return spark.createDataFrame(rows, "directory string, file_count long, sample_rank int, file_name string, columns string")


# -- S5 / S6: code-map CSVs -------------------------------------------------------------------
def read_map_csv(spark: SparkSession, path: str, columns: list[str], required: bool = False) -> list[dict]:
    """A code map as a list of dicts with ``columns`` (all text). A missing file or code column of
    an optional map gives ``[]`` (S6) and a missing other column reads as null; a ``required``
    map must exist with all its columns. Maps are dimension tables of tens of rows."""
    if not list_files(spark, os.path.dirname(path) or ".", base_name(path)):
        if required:
            raise FileNotFoundError(f"code map {path} does not exist")
        return []
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    # header names as written, without a leading byte-order mark or surrounding blanks
    df = df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])
    present = [c for c in columns if c in df.columns]
    if required and len(present) < len(columns):
        raise ValueError(f"code map {path} has no column {', '.join(c for c in columns if c not in present)}")
    if columns[0] not in df.columns:  # S6: no code column -> empty map
        return []
    rows = df.select(*present).collect()
    return [{c: (r[c] if c in present else None) for c in columns} for r in rows]


# -- a file lake written from the derived sources -------------------------------------------------
def materialize_derived_lake(spark: SparkSession, sf_dir: str, root: str | None = None,
                             split_layouts: bool = False, files_per_layout: int | None = None) -> str:
    """Write the derived sources as a file lake under the shared checkpoint folder and return
    its root: ``diagnosis/ order/ medication/ operation/ surgery/ demographic/``.

    By default the two medication layouts share ``medication/`` (a mixed folder, as in the
    hospital extract); ``split_layouts`` gives each layout its own folder (``medication_b/``,
    ``medication_c/``). ``files_per_layout`` spreads each layout over that many files
    (several extracts).
    """
    from cohortkit.session import checkpoint_dir
    from cohortkit.sources.derived import DerivedSources

    root = root or f"{checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex[:12]}"
    src = DerivedSources(spark, sf_dir).stored()

    def write(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
        if files_per_layout:
            df = df.repartition(files_per_layout)
        df.write.mode(mode).parquet(f"{root}/{folder}")

    write(src.diagnosis(), "diagnosis")
    lay = src.medication_layouts()
    write(lay["order_a"], "order")
    if split_layouts:
        write(lay["medication_b"], "medication_b")
        write(lay["medication_c"], "medication_c")
    else:
        # two layouts in one folder: the reader has to group the files by footer signature
        write(lay["medication_b"], "medication")
        write(lay["medication_c"], "medication", mode="append")
    proc = src.procedure_layouts()
    write(proc["operation"], "operation")
    write(proc["surgery"], "surgery")
    write(src.demographic(), "demographic")
    return root


_LAKES: "weakref.WeakKeyDictionary[SparkSession, dict[str, str]]" = weakref.WeakKeyDictionary()


def _stamp(spark: SparkSession, sf_dir: str) -> str:
    """What tells one state of the tables from another: names, lengths and times of their files."""
    seen = []
    for name in ("lineitem", "orders", "customer"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            seen.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join([sf_dir, *sorted(seen)])


def mixed_lake(spark: SparkSession, sf_dir: str) -> str:
    """The derived sources as a lake of mixed forms under the shared folder, written once for a state of the tables:

    diagnosis: CSV, gzipped CSV, Parquet with timestamps and double ids, Parquet with dates and
    integer ids; order: text dates; medication: integer dates and double ids (BillDate layout),
    timestamps and D403KEY codes (PerformDate layout); operation: dates; surgery: text. Ids are
    numbers without leading zeros everywhere.
    """
    from cohortkit.session import checkpoint_dir
    from cohortkit.sources.derived import DX_CODE_DEFAULT, DerivedSources

    lakes, stamp = _LAKES.setdefault(spark, {}), _stamp(spark, sf_dir)
    if stamp in lakes:
        return lakes[stamp]
    root = f"{checkpoint_dir(spark).rstrip('/')}/mixed-lake-{uuid.uuid4().hex[:12]}"
    src = DerivedSources(spark, sf_dir).stored()
    number = F.col("ENC_HN").cast("bigint")

    def ts(name: str, kind: str = "timestamp_ntz"):
        return parse_event_ts(name).cast(kind).alias(name)

    dx = src.diagnosis().withColumn("part", F.pmod(F.xxhash64("ENC_HN", "D001KEY", "D035KEY"), F.lit(4)))
    text = [number.cast("string").alias("ENC_HN"), "D001KEY", "D035KEY"]
    part = [dx.filter(F.col("part") == i) for i in range(4)]
    plain = {"header": True, "escape": '"'}
    part[0].select(*text).write.options(**plain).csv(f"{root}/diagnosis")
    part[1].select(*text).write.options(**plain, compression="gzip").mode("append").csv(f"{root}/diagnosis")
    # records with a field missing, below a header of three: a file separated by ; whose one column is the text
    broken = dx.filter((F.col("D035KEY") == DX_CODE_DEFAULT) & (number % 10 == 0))
    broken.select(F.concat_ws(",", number.cast("string"), F.translate("D001KEY", ",", "")).alias("ENC_HN,D001KEY,D035KEY")) \
        .write.options(header=True, sep=";").mode("append").csv(f"{root}/diagnosis")
    part[2].select(number.cast("double").alias("ENC_HN"), ts("D001KEY"), "D035KEY").write.mode("append").parquet(f"{root}/diagnosis")
    part[3].select(number.alias("ENC_HN"), ts("D001KEY", "date"), "D035KEY").write.mode("append").parquet(f"{root}/diagnosis")
    med = src.medication_layouts()
    med["order_a"].withColumn("ENC_HN", number).write.parquet(f"{root}/order")
    day = F.date_format(parse_event_ts("BillDate"), "yyyyMMdd").cast("bigint")
    med["medication_b"].select(number.cast("double").alias("ENC_HN"), day.alias("BillDate"), "freetext", "Drugcode") \
        .write.parquet(f"{root}/medication")
    med["medication_c"].select(number.cast("decimal(12,0)").alias("ENC_HN"), parse_event_ts("D001KEY").alias("PerformDate"),
                               F.col("DSPCode").alias("D403KEY")).write.mode("append").parquet(f"{root}/medication")
    proc = src.procedure_layouts()
    proc["operation"].select(number.cast("int").alias("ENC_HN"), ts("D001KEY", "date"), "D036KEY").write.parquet(f"{root}/operation")
    proc["surgery"].withColumn("ENC_HN", number.cast("string")).write.parquet(f"{root}/surgery")
    src.demographic().withColumn("ENC_HN", number).write.parquet(f"{root}/demographic")
    lakes[stamp] = root
    return root


def lake_sources(spark: SparkSession, root: str) -> FileSources:
    """File sources over the folders of a lake written by this module."""
    return FileSources(spark, f"{root}/diagnosis", f"{root}/order", f"{root}/medication", (f"{root}/operation", f"{root}/surgery"),
                       f"{root}/demographic", pattern="*.parquet")
