"""Standardize heterogeneous source layouts to one fixed schema.

Column resolution is by *presence* in the layout's schema (the first present candidate wins
even where its values are null, T8), never by a value-level coalesce over merged schemas.
One layout is one DataFrame (a derived source or a group of files with one footer signature);
layouts are unioned by name after each was cast to the fixed schema.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit import schemas as S
from cohortkit.functions.codes import normalize_code
from cohortkit.functions.dates import parse_event_ts

# FIXED VALUES: medication date column candidates, first present wins
MED_DATE_CANDIDATES = ("REC_DATE", "D001KEY", "PerformDate", "BillDate")
# FIXED VALUES: medication code column rules, first match wins (S9): (required columns, code column)
MED_CODE_RULES = (
    (("Comment", "DSPCode"), "DSPCode"),
    (("PROP_HELP", "CODE"), "CODE"),
    (("freetext", "Drugcode"), "Drugcode"),
    (("CODE",), "CODE"),
    (("Drugcode",), "Drugcode"),
    (("D403KEY",), "D403KEY"),
)
ID_COL = "ENC_HN"


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def patient_id(df: DataFrame, name: str = ID_COL) -> Column:
    """The patient id as text, equal for equal numbers of any numeric type (1234567890 and
    1.23456789E9 are one patient). A number that is not whole cannot be an id and raises. Text
    ids are taken as they are, so ``0000123`` in a CSV and the number 123 are two ids (T25)."""
    c, dtype = F.col(name), _dtype(df, name)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c)  # the missing id of a floating column
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = c.cast("decimal(38,0)")
        c = F.when(c.isNull() | (c == whole), whole).otherwise(F.raise_error(F.concat(F.lit("patient id is not a whole number: "), c.cast("string"))))
    return c.cast("string")


def resolve_medication_columns(columns: Iterable[str]) -> tuple[str, str] | None:
    """S8 + S9 on a set of column names; ``None`` when the layout cannot be used."""
    names = set(columns)
    if ID_COL not in names:
        return None
    date_col = next((c for c in MED_DATE_CANDIDATES if c in names), None)
    if date_col is None:
        return None
    code_col = next((code for req, code in MED_CODE_RULES if all(r in names for r in req)), None)
    if code_col is None:
        return None
    return date_col, code_col


def standardize_medication(df: DataFrame) -> DataFrame | None:
    """One layout -> (ENC_HN, REC_DATE, CODE), a projection only.

    The null filters are applied by the caller (``standardized_medication``), or implied by
    the selective code and window filters of ``med_working``, which then run first.
    """
    cols = resolve_medication_columns(df.columns)
    if cols is None:
        return None
    date_col, code_col = cols
    return df.select(
        patient_id(df).alias("ENC_HN"),
        parse_event_ts(F.col(date_col), _dtype(df, date_col)).alias("REC_DATE"),
        normalize_code(F.col(code_col)).alias("CODE"),
    )


def standardize_procedure(df: DataFrame) -> DataFrame | None:
    """Operation layout (D036KEY) or surgery layout (OPR_* columns unpivoted)."""
    names = set(df.columns)
    if ID_COL not in names or "D001KEY" not in names:
        return None
    hn = patient_id(df).alias("ENC_HN")
    ts = parse_event_ts(F.col("D001KEY"), _dtype(df, "D001KEY")).alias("PROC_DATE")
    if "D036KEY" in names:
        return df.select(hn, ts, normalize_code(F.col("D036KEY")).alias("PROC_CODE"))
    opr = sorted(c for c in names if c.startswith("OPR_"))
    if not opr:
        return None
    wide = df.select(hn, ts, *[F.col(c).cast("string").alias(c) for c in opr])
    # wide -> long; unpivot keeps null cells, so blank and null codes are filtered after
    long = wide.unpivot(["ENC_HN", "PROC_DATE"], opr, "OPR_COL", "RAW_CODE")
    # blank cells of the wide layout are not events (a blank code never matches a map code)
    return (
        long.filter(F.col("RAW_CODE").isNotNull())
        .select("ENC_HN", "PROC_DATE", normalize_code(F.col("RAW_CODE")).alias("PROC_CODE"))
        .filter(F.col("PROC_CODE") != "")
    )


def raw_window_filter(df: DataFrame, date_col: str, window) -> Column | None:
    """F3 on the *raw* date column when it is typed, so the reader gets a pushed filter and
    skips row groups outside the study window by their statistics; ``None`` for text (or
    zoned) columns, whose window test has to follow the parse.

    naive timestamp: ``start <= d <= end``; date: the same on whole days (``cast(d) >= start``
    is ``d >= start`` or the next day when ``start`` has a time part; ``cast(d) <= end`` is
    ``d <= date(end)``).
    """
    import datetime as _dt

    from cohortkit.operators.diagnosis import ts_literal

    dtype = _dtype(df, date_col)
    c = F.col(date_col)
    if isinstance(dtype, T.TimestampNTZType):
        return c.between(ts_literal(window.start), ts_literal(window.end))
    if isinstance(dtype, T.DateType):
        lo = window.start.date() + (_dt.timedelta(days=1) if window.start.time() != _dt.time(0) else _dt.timedelta(0))
        return c.between(F.lit(lo), F.lit(window.end.date()))
    return None


def standardize_diagnosis(df: DataFrame) -> DataFrame:
    """Diagnosis layout: fixed ENC_HN, D001KEY, D035KEY (a missing column is an error)."""
    return df.select(
        patient_id(df).alias("ENC_HN"),
        parse_event_ts(F.col("D001KEY"), _dtype(df, "D001KEY")).alias("D001KEY"),
        normalize_code(F.col("D035KEY")).alias("code"),
    )


def union_layouts(spark: SparkSession, frames: Iterable[DataFrame | None], schema) -> DataFrame:
    """Union by name of standardized layouts; typed empty frame when there is none."""
    usable = [f.select(*[F.col(fl.name).cast(fl.dataType) for fl in schema.fields]) for f in frames if f is not None]
    if not usable:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), usable)


def medication_union(spark: SparkSession, layouts: Iterable[DataFrame]) -> DataFrame:
    """All medication layouts projected to (ENC_HN, REC_DATE, CODE), unfiltered."""
    return union_layouts(spark, (standardize_medication(d) for d in layouts), S.MED_STANDARD)


def procedure_union(spark: SparkSession, layouts: Iterable[DataFrame]) -> DataFrame:
    """All procedure layouts projected to (ENC_HN, PROC_DATE, PROC_CODE), unfiltered."""
    return union_layouts(spark, (standardize_procedure(d) for d in layouts), S.PROC_STANDARD)


def _complete(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def standardized_medication(spark: SparkSession, layouts: Iterable[DataFrame]) -> DataFrame:
    """Standardized medication rows with id, date and code present."""
    return _complete(medication_union(spark, layouts), ("ENC_HN", "REC_DATE", "CODE"))


def standardized_procedure(spark: SparkSession, layouts: Iterable[DataFrame]) -> DataFrame:
    """Standardized procedure rows with id, date and code present."""
    return _complete(procedure_union(spark, layouts), ("ENC_HN", "PROC_DATE", "PROC_CODE"))
