"""Radiotherapy (P4, E31, J8): procedure events -> course per patient; memantine in a course."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.codes import code_in, prefix_match
from cohortkit.operators.diagnosis import in_window
from cohortkit.schemas import StudyWindow
from cohortkit.sources.codemaps import CodeMaps


def rt_working_from_layouts(spark, layouts, maps: CodeMaps, window: StudyWindow) -> DataFrame:
    """Procedure events whose ICD-9 code starts with a radiotherapy code, filtered per layout before the union (the window is pushable on a typed
    raw date column)."""
    from cohortkit.operators.standardize import raw_window_filter, standardize_procedure, union_layouts
    from cohortkit.schemas import PROC_STANDARD

    frames = []
    for layout in layouts:
        if "D001KEY" not in layout.columns:
            continue
        raw = raw_window_filter(layout, "D001KEY", window)
        std = standardize_procedure(layout.filter(raw) if raw is not None else layout)
        if std is None:
            continue
        cond = F.col("ENC_HN").isNotNull() & prefix_match("PROC_CODE", maps.radiotherapy)
        frames.append(std.filter(cond if raw is not None else cond & in_window("PROC_DATE", window)))
    return union_layouts(spark, frames, PROC_STANDARD)


def rt_summary(working: DataFrame, date_col: str = "PROC_DATE") -> DataFrame:
    """A5: first and last radiotherapy date per patient (partial aggregate, skew-safe)."""
    return working.groupBy("ENC_HN").agg(
        F.min(date_col).alias("rt_first_date"), F.max(date_col).alias("rt_last_date")
    )


def rt_billing_working(med_standard: DataFrame, maps: CodeMaps, window: StudyWindow) -> DataFrame:
    """Radiotherapy by institution billing code (method 2) on the order/medication
    events, with the brain/spine marker of the code."""
    brain = [c for c, b in maps.billing if b]
    return med_standard.filter(
        F.col("ENC_HN").isNotNull() & code_in("CODE", [c for c, _ in maps.billing]) & in_window("REC_DATE", window)
    ).select("ENC_HN", "REC_DATE", "CODE", code_in("CODE", brain).alias("is_brain_spine"))


def rt_billing_from_layouts(spark, layouts, maps: CodeMaps, window: StudyWindow) -> DataFrame:
    """``rt_billing_working`` per order/medication layout before the union (the window is
    pushable on a typed raw date column)."""
    from cohortkit.operators.standardize import (
        raw_window_filter, resolve_medication_columns, standardize_medication, union_layouts,
    )
    from cohortkit.schemas import MED_STANDARD

    frames = []
    for layout in layouts:
        cols = resolve_medication_columns(layout.columns)
        if cols is None:
            continue
        raw = raw_window_filter(layout, cols[0], window)
        std = standardize_medication(layout.filter(raw) if raw is not None else layout)
        frames.append(std if raw is not None else std.filter(F.col("CODE").isNotNull()))
    union = union_layouts(spark, frames, MED_STANDARD)
    return rt_billing_working(union, maps, window)


def rt_billing_summary(billing_working: DataFrame) -> DataFrame:
    """E31 + A5: billing-code radiotherapy course per patient."""
    return billing_working.groupBy("ENC_HN").agg(
        F.min("REC_DATE").alias("rt_first_date"),
        F.max("REC_DATE").alias("rt_last_date"),
        F.count(F.lit(1)).alias("n_billing_events"),
        F.bool_or("is_brain_spine").alias("has_brain_spine_code"),
    )


def memantine_during_rt(med_working: DataFrame, rt_summary_df: DataFrame) -> DataFrame:
    """Every memantine event inside its patient's radiotherapy course.

    An equi-join on the patient id plus a range predicate. The course side has one row per
    patient (no fan-out). Equal events are counted before the join, map-side first, and
    repeated after it, so a hot patient brings at most one row per day and code to the join.
    """
    keys = ["ENC_HN", "REC_DATE", "CODE"]
    mem = med_working.filter(F.col("drug_class") == "Memantine").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return mem.join(rt_summary_df, "ENC_HN", "inner").filter(
        F.col("REC_DATE").between(F.col("rt_first_date"), F.col("rt_last_date"))
    ).select(*keys, "rt_first_date", "rt_last_date", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).drop("col")
