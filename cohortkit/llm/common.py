"""Helpers shared by the operators: tables, words, the shared folder, bounded broadcasts, keeping one row of a group."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.session import checkpoint_dir

# A word is a maximal run of characters other than the six ASCII blanks; ``bytes.split()`` cuts UTF-8 the same way.
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 8 << 20
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def word_count(col: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(col: Column) -> Column:
    """The text as UTF-8 bytes (null: empty), the form in which Python tasks receive it."""
    return F.coalesce(col, F.lit("")).cast("binary")


def constant(values: list, kind: str) -> Column:
    """An array constant: one string that is split when the plan is made, not one expression for each value."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast hint when ``rows`` (counted by the caller) stay under the bound; otherwise Spark joins by shuffle."""
    return F.broadcast(df) if rows * bytes_per_row <= BROADCAST_BYTES else df


RUN = 4_096


def numbered(df: DataFrame, count: str, name: str) -> DataFrame:
    """Each row ``count`` times, with its number from 0 as ``name``. Large counts are dealt in runs of ``RUN`` numbers to all
    tasks first, so that no task writes all copies of one row."""
    runs = df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({count} - 1) div {RUN}"))))
    last = F.least(F.col(count), (F.col(name) + 1) * RUN) - 1
    return runs.repartition(*[F.col(c) for c in runs.columns]) \
        .withColumn(name, F.explode(F.sequence(F.col(name) * RUN, last))).drop(count)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``SLICE_ROWS`` rows, so that few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column (the cast copies nothing); null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def add_column(df: DataFrame, name: str, kind: T.DataType, text_col: str, start: Callable[[], Callable[[bytes], object]]) -> DataFrame:
    """``df`` and a column that a function computes from each text; ``start`` makes the function, once per task."""
    i, as_arrow = df.columns.index(text_col), {T.BinaryType(): pa.binary(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([each(t) for t in texts(b.column(i))], as_arrow)], [*b.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = a[keys[0]].eqNullSafe(b[keys[0]])
    for k in keys[1:]:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def without(rows: DataFrame, dropped: DataFrame, keys: list[str], repeated: DataFrame) -> DataFrame:
    """Rows whose ``keys`` (nulls equal) are not in ``dropped``; keys in ``repeated`` keep one of their rows.

    The dropped keys are unique, so the anti-join emits no pairs; Spark splits a hot key on the row side.
    """
    kept = rows.join(dropped, same(rows, dropped, keys), "left_anti")
    if repeated.isEmpty():
        return kept
    alone = kept.join(repeated, same(kept, repeated, keys), "left_anti")
    return alone.unionByName(kept.join(repeated, same(kept, repeated, keys), "left_semi").dropDuplicates(keys))
