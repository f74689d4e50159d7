"""Diagnosis arm (P1, P2): filtered events -> dx_working -> dx_summary.

Plan shape: scan (3 columns) -> parse + normalize + prefix/window filters in one codegen
stage -> ``groupBy(ENC_HN, D001KEY)`` for dx_working (exchange hashes on both keys, so a
patient with a huge history still spreads over partitions) -> ``groupBy(ENC_HN)`` with a
map-side partial aggregate for dx_summary (a hot patient collapses to one row per task
before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.codes import code_mask, mask_bits, normalize_code, prefix_match
from cohortkit.schemas import DX_FLAGS, StudyWindow
from cohortkit.sources.codemaps import UNSPECIFIED_DATE_PREFIX, CodeMaps
from cohortkit.operators.standardize import standardize_diagnosis


def ts_literal(value) -> Column:
    """A naive timestamp literal that does not depend on the session time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def in_window(col: Column | str, window: StudyWindow) -> Column:
    """F3 as one null-safe predicate (null -> false).

    Written so the (possibly expensive) date expression occurs once in the pushed-down
    filter, and so Catalyst infers no ``isnotnull(date)`` constraint that it would evaluate
    ahead of the cheaper, more selective code tests.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.between(ts_literal(window.start), ts_literal(window.end)), F.lit(False))


def dx_standardized(spark, layouts) -> DataFrame:
    """Every diagnosis layout standardized (E1 E2) and unioned."""
    from cohortkit.operators.standardize import union_layouts
    from cohortkit.schemas import DX_STANDARD

    return union_layouts(spark, (standardize_diagnosis(d) for d in layouts), DX_STANDARD)


def dx_events_from_layouts(spark, layouts, maps: CodeMaps, window: StudyWindow) -> DataFrame:
    """F1 F2 F3 per layout, before the union (filter before union).

    A typed date column gets the window as a plain comparison on the raw column, which the
    Parquet reader receives as a pushed filter (row groups outside the window are skipped);
    a text date column gets the parse-once window test after the code filter.
    """
    from cohortkit.operators.standardize import raw_window_filter, union_layouts
    from cohortkit.schemas import DX_STANDARD

    frames = []
    for layout in layouts:
        raw = raw_window_filter(layout, "D001KEY", window)
        std = standardize_diagnosis(layout.filter(raw) if raw is not None else layout)
        cond = F.col("ENC_HN").isNotNull() & prefix_match("code", maps.diagnosis_prefixes)
        frames.append(std.filter(cond if raw is not None else cond & in_window("D001KEY", window)))
    return union_layouts(spark, frames, DX_STANDARD)


def mask_groups(maps: CodeMaps) -> dict[str, list[str]]:
    """The prefix lists of the seven diagnosis flags, and of the literal F03."""
    return {**maps.diagnosis_groups(), "is_f03": [UNSPECIFIED_DATE_PREFIX]}


def with_mask(events: DataFrame, maps: CodeMaps, name: str = "mask") -> DataFrame:
    """``events`` and the flags of each normalized code as bits, looked up once a row."""
    return events.withColumn(name, code_mask("code", mask_groups(maps)))


def flags(mask: Column | str, maps: CodeMaps) -> dict[str, Column]:
    """The flags that a mask holds, by name."""
    m = F.col(mask) if isinstance(mask, str) else mask
    return {g: m.bitwiseAND(F.lit(bit)) != 0 for g, bit in mask_bits(mask_groups(maps)).items()}


def dx_working(events: DataFrame, maps: CodeMaps) -> DataFrame:
    """A1 + A2 fused (no join back, J1): per (patient, timestamp) the sorted distinct codes
    joined by ", " and the any-flags of those codes, which are one ``bit_or`` of their masks."""
    flagged = with_mask(events.select("ENC_HN", "D001KEY", "code"), maps)
    per_time = flagged.groupBy("ENC_HN", "D001KEY").agg(
        F.array_join(F.array_sort(F.collect_set("code")), ", ").alias("D035KEY"), F.bit_or("mask").alias("mask"))
    has = flags("mask", maps)
    return per_time.select("ENC_HN", "D001KEY", "D035KEY", *[has[f].alias(f) for f in DX_FLAGS])


def dx_summary_from_events(events: DataFrame, maps: CodeMaps) -> DataFrame:
    """A3 straight from the event rows: the same result as ``dx_summary(dx_working(..))``
    (every signal is a min or an any over the same codes), with one shuffle instead of two."""
    return _summarize(events.select("ENC_HN", "D001KEY", "code"), maps)


def dx_summary(working: DataFrame, maps: CodeMaps) -> DataFrame:
    """A3: per patient, earliest date of each signal and the two history flags.

    Reads dx_working (so it also works on a dx_working table read back from storage): the
    code text is split, re-normalized and re-flagged (E10), then aggregated with ``min`` /
    ``bool_or`` only, which Spark combines map-side before the shuffle.
    """
    codes = working.select(
        "ENC_HN", "D001KEY", F.explode(F.split(F.col("D035KEY"), ", ")).alias("raw")
    ).select("ENC_HN", "D001KEY", normalize_code(F.col("raw")).alias("code")).filter(
        F.col("code").isNotNull() & (F.col("code") != "")
    )
    return _summarize(codes, maps)


def _summarize(codes: DataFrame, maps: CodeMaps) -> DataFrame:
    has, ts = flags("mask", maps), F.col("D001KEY")
    every = flags("every", maps)

    def first(flag: str, name: str) -> Column:
        return F.min(F.when(has[flag], ts)).alias(name)

    return with_mask(codes, maps).groupBy("ENC_HN").agg(
        first("is_dementia", "diagnosis_date"),
        first("is_ad", "ad_date"),
        first("is_vad", "vad_date"),
        first("is_other", "other_date"),
        first("is_f03", "unspecified_date"),  # E8 / T11: literal F03
        first("is_mci", "mci_date"),
        first("is_schizophrenia", "schizophrenia_date"),
        F.bit_or("mask").alias("every"),
    ).select("*", every["is_mci"].alias("has_mci_history"), every["is_schizophrenia"].alias("has_schizophrenia_history")).drop("every")
