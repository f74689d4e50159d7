"""Exact criteria (P5): merge the three patient summaries and apply the exclusion rules.

Two equivalent merges feed ``apply_criteria``:

* ``merged_summaries`` (join form, J2 + J3) over stored summaries: every input is one row per
  patient hashed on ``ENC_HN``, and the joins are ordered so that none re-shuffles;
* ``merged_summaries_from_events``: one aggregate over the union of the three filtered event
  streams (a single shuffle with map-side combining), used by lazily composed plans and by
  the streaming refresh.

Null handling follows T12: every comparison that may meet a missing value is wrapped in
``coalesce(.., false)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: exact-criteria counter names, in published order
EXACT_COUNTERS = (
    "medication_patients_evaluated", "achei_patients", "memantine_patients", "achei_excluded_mci",
    "achei_left", "memantine_excluded_schizo", "memantine_after_schizo", "memantine_excluded_radio",
    "memantine_left", "medication_qualifying_patients", "medication_excluded_patients",
    "inferred_unspecified_patients",
)

DX_COLS = ("ENC_HN", "diagnosis_date", "ad_date", "vad_date", "other_date", "unspecified_date", "mci_date",
           "schizophrenia_date", "has_mci_history", "has_schizophrenia_history")
MED_COLS = ("ENC_HN", "medication_date", "achei_date", "memantine_date", "clozapine_date", "has_clozapine_history")
RT_COLS = ("ENC_HN", "rt_first_date", "rt_last_date")


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def exact_criteria_base(dx_summary: DataFrame, med_summary: DataFrame, rt_summary: DataFrame) -> DataFrame:
    """The merged base with every flag of the exact criteria.

    Join form over the three stored summaries: full outer join of diagnosis and medication
    (J2), left join of the radiotherapy course (J3; radiotherapy-only patients never enter).
    ``medication_date`` is published as the *qualified* medication date (T13); the raw
    earliest dementia-drug date is only used for the candidate flags.
    """
    return apply_criteria(merged_summaries(dx_summary, med_summary, rt_summary))


def merged_summaries(dx_summary: DataFrame, med_summary: DataFrame, rt_summary: DataFrame) -> DataFrame:
    """J2 + J3 without a re-shuffle: the course is left-joined to each summary first (both
    sides hashed on ENC_HN by their aggregates, the course aggregate computed once and its
    exchange reused), then the two are full-outer joined on that same partitioning. Joining
    the course after the full outer join would re-shuffle, because the coalesced key of a
    full outer join has no known partitioning. Radiotherapy-only patients never enter (T20)."""
    rt = rt_summary.select(*RT_COLS)
    dx = dx_summary.select(*DX_COLS).join(rt, "ENC_HN", "left").withColumnsRenamed(
        {"rt_first_date": "_dx_rt_first", "rt_last_date": "_dx_rt_last"})
    med = med_summary.select(*MED_COLS).join(rt, "ENC_HN", "left").withColumnsRenamed(
        {"rt_first_date": "_med_rt_first", "rt_last_date": "_med_rt_last"})
    merged = dx.join(med, "ENC_HN", "full_outer")
    return merged.select(
        *DX_COLS, *MED_COLS[1:],
        F.coalesce("_dx_rt_first", "_med_rt_first").alias("rt_first_date"),
        F.coalesce("_dx_rt_last", "_med_rt_last").alias("rt_last_date"),
    )


def merged_summaries_from_events(dx_events: DataFrame, med_working: DataFrame, rt_working: DataFrame,
                                 maps) -> DataFrame:
    """The same merged per-patient table as J2 + J3, as ONE aggregate over the union of the
    three event streams: every summary column is a min, max or any, so the three summaries
    and their joins collapse into a single shuffle with map-side partial aggregation.

    Patients with radiotherapy events only are dropped, as the left join drops them (T20).
    """
    from cohortkit.operators.diagnosis import flags, with_mask

    has = flags("mask", maps)
    no = F.lit(None).cast("boolean")
    dx_flags = {
        "f_dementia": has["is_dementia"], "f_ad": has["is_ad"], "f_vad": has["is_vad"], "f_other": has["is_other"],
        "f_f03": has["is_f03"], "f_mci": has["is_mci"], "f_scz": has["is_schizophrenia"],
    }
    med_flags = {
        "f_dmed": F.col("is_dementia_med"),
        "f_achei": F.coalesce(F.col("drug_class") == "AChEI", F.lit(False)),
        "f_mem": F.coalesce(F.col("drug_class") == "Memantine", F.lit(False)),
        "f_cloz": F.col("is_clozapine"),
    }
    names = list(dx_flags) + list(med_flags)

    def arm(df: DataFrame, src: str, ts: str, flags: dict) -> DataFrame:
        return df.select(F.col("ENC_HN"), F.col(ts).alias("ts"), F.lit(src).alias("src"),
                         *[(flags[n] if n in flags else no).alias(n) for n in names])

    ev = (arm(with_mask(dx_events, maps), "dx", "D001KEY", dx_flags)
          .unionByName(arm(med_working, "med", "REC_DATE", med_flags))
          .unionByName(arm(rt_working, "rt", "PROC_DATE", {})))
    ts, src = F.col("ts"), F.col("src")

    def first(flag: str, name: str):
        return F.min(F.when(F.col(flag), ts)).alias(name)

    merged = ev.groupBy("ENC_HN").agg(
        first("f_dementia", "diagnosis_date"), first("f_ad", "ad_date"), first("f_vad", "vad_date"),
        first("f_other", "other_date"), first("f_f03", "unspecified_date"), first("f_mci", "mci_date"),
        first("f_scz", "schizophrenia_date"),
        F.bool_or("f_mci").alias("has_mci_history"), F.bool_or("f_scz").alias("has_schizophrenia_history"),
        first("f_dmed", "medication_date"), first("f_achei", "achei_date"), first("f_mem", "memantine_date"),
        first("f_cloz", "clozapine_date"), F.bool_or("f_cloz").alias("has_clozapine_history"),
        F.min(F.when(src == "rt", ts)).alias("rt_first_date"), F.max(F.when(src == "rt", ts)).alias("rt_last_date"),
        F.count_if(src != "rt").alias("_n_base_rows"),
    )
    return merged.filter(F.col("_n_base_rows") > 0).drop("_n_base_rows")


def apply_criteria(merged: DataFrame) -> DataFrame:
    """E13-E22 on the merged per-patient table (diagnosis, medication and course columns)."""
    col = F.col
    has_mci = _false_if_null(col("has_mci_history"))
    has_scz = _false_if_null(col("has_schizophrenia_history"))
    has_clz = _false_if_null(col("has_clozapine_history"))
    is_dx = col("diagnosis_date").isNotNull()
    is_med = col("medication_date").isNotNull()  # raw earliest dementia-drug date
    achei_cand = is_med & col("achei_date").isNotNull()
    excl_mci = achei_cand & has_mci
    achei_left = achei_cand & ~excl_mci
    mem_cand = is_med & col("memantine_date").isNotNull()
    excl_scz = mem_cand & (has_scz | has_clz)
    mem_after = mem_cand & ~excl_scz
    in_course = _false_if_null(
        col("rt_first_date").isNotNull() & col("rt_last_date").isNotNull()
        & (col("memantine_date") >= col("rt_first_date")) & (col("memantine_date") <= col("rt_last_date"))
    )
    excl_rt = mem_after & in_course  # T15: first memantine date only; T18: after schizophrenia
    mem_left = mem_after & ~excl_rt
    qualifying = achei_left | mem_left
    q_achei = F.when(achei_left, col("achei_date"))
    q_mem = F.when(mem_left, col("memantine_date"))
    q_med = F.least(q_achei, q_mem)  # skips nulls (E20)

    return merged.select(
        "ENC_HN", "diagnosis_date", "ad_date", "vad_date", "other_date", "unspecified_date", "mci_date",
        "schizophrenia_date", has_mci.alias("has_mci_history"), has_scz.alias("has_schizophrenia_history"),
        q_med.alias("medication_date"),  # E21: overwritten by the qualified date
        "achei_date", "memantine_date", "clozapine_date", has_clz.alias("has_clozapine_history"),
        "rt_first_date", "rt_last_date",
        is_dx.alias("is_dx_confirmed"),
        is_med.alias("is_med_candidate"),
        achei_cand.alias("is_achei_candidate"),
        excl_mci.alias("exclude_mci_achei"),
        achei_left.alias("achei_left"),
        mem_cand.alias("is_memantine_candidate"),
        excl_scz.alias("exclude_schizophrenia_memantine"),
        mem_after.alias("memantine_after_schizo"),
        excl_rt.alias("exclude_radiotherapy_memantine"),
        mem_left.alias("memantine_left"),
        (excl_mci | excl_scz | excl_rt).alias("excluded_med"),  # T14: any branch excluded
        qualifying.alias("is_med_qualifying"),
        q_achei.alias("qualified_achei_date"),
        q_mem.alias("qualified_memantine_date"),
        q_med.alias("qualified_medication_date"),
        (qualifying & ~is_dx).alias("is_inferred_unspecified"),
        (is_dx | qualifying).alias("is_final_cohort"),
    )


def exact_med_evaluated(base: DataFrame) -> DataFrame:
    """patients with any dementia drug."""
    return base.filter(F.col("is_med_candidate"))


def inferred_unspecified(base: DataFrame) -> DataFrame:
    """qualifying medication without an ICD-10 dementia diagnosis."""
    return base.filter(F.col("is_inferred_unspecified"))


def final_cohort(base: DataFrame) -> DataFrame:
    """diagnosis confirmed or qualifying medication."""
    return base.filter(F.col("is_final_cohort"))


def exact_criteria_counts(base: DataFrame) -> DataFrame:
    """The twelve counters as (metric, value) rows, from one global aggregate."""
    return to_long(exact_criteria_counts_wide(base), list(EXACT_COUNTERS), "metric", "value")


def exact_criteria_counts_wide(base: DataFrame) -> DataFrame:
    """The twelve counters as one row (one global aggregate, partial + final)."""
    c = F.col
    conds = {
        "medication_patients_evaluated": c("is_med_candidate"),
        "achei_patients": c("is_achei_candidate"),
        "memantine_patients": c("is_memantine_candidate"),
        "achei_excluded_mci": c("exclude_mci_achei"),
        "achei_left": c("achei_left"),
        "memantine_excluded_schizo": c("exclude_schizophrenia_memantine"),
        "memantine_after_schizo": c("memantine_after_schizo"),
        "memantine_excluded_radio": c("exclude_radiotherapy_memantine"),
        "memantine_left": c("memantine_left"),
        "medication_qualifying_patients": c("is_med_qualifying"),
        "medication_excluded_patients": c("is_med_candidate") & ~c("is_med_qualifying"),  # T14
        "inferred_unspecified_patients": c("is_inferred_unspecified"),
    }
    return base.agg(*[F.count_if(conds[name]).alias(name) for name in EXACT_COUNTERS])


def to_long(wide_one_row: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    """One-row wide aggregate -> (key, value) rows, via ``stack`` (no shuffle)."""
    parts = []
    for n in names:
        parts.append("'" + n.replace("'", "\\'") + "'")
        parts.append(f"`{n}`")
    return wide_one_row.selectExpr(f"stack({len(names)}, {', '.join(parts)}) as ({key}, {value})")
