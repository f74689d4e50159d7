"""Medication arm (P3): standardized prescriptions -> med_working -> med_summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.codes import class_lookup, code_in
from cohortkit.operators.diagnosis import in_window
from cohortkit.schemas import StudyWindow
from cohortkit.sources.codemaps import CodeMaps


def _with_classes(events: DataFrame, maps: CodeMaps) -> DataFrame:
    """Class and flags of the kept drug events. The class lookup is a literal ``InSet`` test
    (no join); the map is bounded by the drug vocabulary."""
    classes = maps.drug_classes()
    return (
        events
        .select(
            "ENC_HN", "REC_DATE", "CODE",
            class_lookup("CODE", classes).alias("drug_class"),
            code_in("CODE", maps.clozapine).alias("is_clozapine"),
        )
        .select("ENC_HN", "REC_DATE", "CODE", "drug_class",
                F.col("drug_class").isNotNull().alias("is_dementia_med"), "is_clozapine")
    )


def med_working_from_layouts(spark, layouts, maps: CodeMaps, window: StudyWindow) -> DataFrame:
    """Dementia-drug and clozapine events, filtered per layout before the union: a plain,
    pushable comparison on a typed raw date column, the parse-once test on text."""
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
        cond = F.col("ENC_HN").isNotNull() & code_in("CODE", maps.relevant_drug_codes)
        frames.append(std.filter(cond if raw is not None else cond & in_window("REC_DATE", window)))
    return _with_classes(union_layouts(spark, frames, MED_STANDARD), maps)


def med_summary(working: DataFrame) -> DataFrame:
    """A4: per patient, earliest dementia-drug / AChEI / memantine / clozapine date."""
    d = F.col("REC_DATE")
    return working.groupBy("ENC_HN").agg(
        F.min(F.when(F.col("is_dementia_med"), d)).alias("medication_date"),
        F.min(F.when(F.col("drug_class") == "AChEI", d)).alias("achei_date"),
        F.min(F.when(F.col("drug_class") == "Memantine", d)).alias("memantine_date"),
        F.min(F.when(F.col("is_clozapine"), d)).alias("clozapine_date"),
        F.bool_or(F.col("is_clozapine")).alias("has_clozapine_history"),
    )
