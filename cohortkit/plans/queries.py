"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver tables of ``sf_dir`` through the derived sources, so its work
grows with the tables; nothing runs on fixed input alone. Column names match the DuckDB
oracle SQL in ``cohortkit.checks.oracle``.
"""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.codes import normalize_code, padded_id
from cohortkit.functions.dates import parse_event_ts
from cohortkit.operators import criteria, diagnosis, index, reports
from cohortkit.operators.standardize import resolve_medication_columns
from cohortkit.plans.cohort import CohortPlan
from cohortkit.schemas import StudyWindow
from cohortkit.sources import crosswalk
from cohortkit.sources.codemaps import CodeMaps
from cohortkit.sources.derived import DERIVED_WINDOW, MED_CODE_DEFAULT, DerivedSources, MixedWidths

DERIVED_STUDY_WINDOW = StudyWindow(*DERIVED_WINDOW)

# Derived source definitions per session and table folder, like temp views over the driver
# tables: lazy DataFrames only (no data is cached; every query runs its whole plan).
_SOURCES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DerivedSources]]" = weakref.WeakKeyDictionary()


def derived_sources(spark: SparkSession, sf_dir: str) -> DerivedSources:
    per_session = _SOURCES.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = DerivedSources(spark, sf_dir)
    return per_session[sf_dir]


def derived_plan(spark: SparkSession, sf_dir: str, maps: CodeMaps | None = None) -> CohortPlan:
    return CohortPlan(spark, derived_sources(spark, sf_dir), maps or CodeMaps.default(), DERIVED_STUDY_WINDOW)


# -- scalar-function queries (E1, E2, E4/E5/J6) ---------------------------------------------
def q_normalize_codes(spark, sf_dir):
    """E1 over every raw diagnosis and drug code: raw -> normalized, with row counts."""
    src = derived_sources(spark, sf_dir)
    parts = [src.diagnosis().select(F.lit("diagnosis").alias("source"), F.col("D035KEY").alias("raw_code"))]
    for df in src.medication_layouts().values():
        _, code_col = resolve_medication_columns(df.columns)
        parts.append(df.select(F.lit("medication").alias("source"), F.col(code_col).alias("raw_code")))
    raw = reduce(DataFrame.unionByName, parts)
    return raw.groupBy("source", "raw_code").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "source", "raw_code", normalize_code(F.col("raw_code")).alias("code"), "n_rows")


def q_parse_dates(spark, sf_dir):
    """E2 over every raw event-date text: text -> timestamp (null when unparsable)."""
    src = derived_sources(spark, sf_dir)
    parts = [src.diagnosis().select(F.lit("diagnosis").alias("source"), F.col("D001KEY").alias("raw_date"))]
    for df in src.medication_layouts().values():
        date_col, _ = resolve_medication_columns(df.columns)
        parts.append(df.select(F.lit("medication").alias("source"), F.col(date_col).alias("raw_date")))
    for df in src.procedure_layouts().values():
        parts.append(df.select(F.lit("procedure").alias("source"), F.col("D001KEY").alias("raw_date")))
    raw = reduce(DataFrame.unionByName, parts)
    return raw.groupBy("source", "raw_date").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "source", "raw_date", parse_event_ts(F.col("raw_date")).alias("event_ts"), "n_rows")


def q_prefix_match(spark, sf_dir):
    """E4 E5 J6 (join form): every distinct normalized diagnosis code with each map prefix it
    starts with. The distinct codes (bounded by the code vocabulary) are expanded to their
    candidate prefixes of the map's prefix lengths and equi-joined to the broadcast map."""
    maps = CodeMaps.default()
    rows = sorted({(c, "dementia") for c in maps.dementia_codes} | {(c, "mci") for c in maps.mci}
                  | {(c, "schizophrenia") for c in maps.schizophrenia} | {(r.code, "review") for r in maps.review})
    lengths = sorted({len(c) for c, _ in rows})
    mp = spark.createDataFrame(rows, "prefix string, map_name string")
    codes = derived_sources(spark, sf_dir).diagnosis().select(normalize_code(F.col("D035KEY")).alias("code")).distinct()
    cand = codes.select("code", F.explode(F.array(*[F.substring("code", 1, k) for k in lengths])).alias("prefix"))
    cand = cand.distinct()
    return cand.join(F.broadcast(mp), "prefix", "inner").select("code", "prefix", "map_name").distinct()


# -- arms -----------------------------------------------------------------------------------
def _plan_attr(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return getattr(derived_plan(spark, sf_dir), name)
    run.__name__ = f"q_{name}"
    return run


def q_stage_counts(spark, sf_dir):
    plan = derived_plan(spark, sf_dir)
    return reports.stage_counts(plan.dx_working, plan.med_working, plan.rt_working)


def q_exact_med_evaluated(spark, sf_dir):
    return criteria.exact_med_evaluated(derived_plan(spark, sf_dir).exact_base)


def q_inferred_unspecified(spark, sf_dir):
    return criteria.inferred_unspecified(derived_plan(spark, sf_dir).exact_base)


def q_exact_criteria_counts(spark, sf_dir):
    return criteria.exact_criteria_counts(derived_plan(spark, sf_dir).exact_base)


def q_exclusion_steps(spark, sf_dir):
    return reports.exclusion_steps(derived_plan(spark, sf_dir).exact_base)


def q_flow_by_availability(spark, sf_dir):
    return derived_plan(spark, sf_dir).flow_by_availability()


def q_flow_by_index(spark, sf_dir):
    return derived_plan(spark, sf_dir).flow_by_index()


def q_dementia_index_labelled(spark, sf_dir):
    return derived_plan(spark, sf_dir).labelled


def q_label_with_arm(spark, sf_dir):
    return index.label_with_arm(derived_plan(spark, sf_dir).labelled)


def q_age_exception_stats(spark, sf_dir):
    return reports.age_exception_stats(derived_plan(spark, sf_dir).indexed)


def q_age_filter_counts(spark, sf_dir):
    return reports.age_filter_counts(derived_plan(spark, sf_dir).indexed)


def q_null_id_counts(spark, sf_dir):
    return reports.null_id_counts(derived_plan(spark, sf_dir))


def q_subtype_distribution(spark, sf_dir):
    return derived_plan(spark, sf_dir).subtype_distribution()


def q_subtype_transition(spark, sf_dir):
    return derived_plan(spark, sf_dir).subtype_transition()


def q_formatted_percentages(spark, sf_dir):
    return reports.subtype_distribution_display(derived_plan(spark, sf_dir).labelled)


def q_formatted_transition(spark, sf_dir):
    return reports.subtype_transition_display(derived_plan(spark, sf_dir).labelled)


def q_review_code_counts(spark, sf_dir):
    plan = derived_plan(spark, sf_dir)
    return reports.review_code_counts(plan.dx_events, plan.maps)


# -- file sources (S1-S4, S7, S13): the same stages read back from files of mixed forms ----------
def file_plan(spark, sf_dir) -> CohortPlan:
    from cohortkit.sources.files import lake_sources, mixed_lake

    return CohortPlan(spark, lake_sources(spark, mixed_lake(spark, sf_dir)), CodeMaps.default(), DERIVED_STUDY_WINDOW)


def _file_attr(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A stage over the files; their numeric ids are padded as in the derived sources."""
    def run(spark, sf_dir):
        return getattr(file_plan(spark, sf_dir), name).withColumn("ENC_HN", padded_id("ENC_HN"))
    run.__name__ = f"q_file_{name}"
    return run


def q_source_profile(spark, sf_dir):
    """S13 over the procedure and order folders: folder name, whether it has files, and the columns
    of its sampled files (part-file names and counts depend on the cluster)."""
    from cohortkit.sources.files import mixed_lake, profile_sources

    lake = mixed_lake(spark, sf_dir)
    prof = profile_sources(spark, [f"{lake}/{d}" for d in ("operation", "surgery", "order", "none")], pattern="*.parquet")
    return prof.select(F.element_at(F.split("directory", "/"), -1).alias("folder"), (F.col("file_count") > 0).alias("has_files"),
                       "columns").distinct()


def q_file_csv_rejects(spark, sf_dir):
    """Malformed records of the lake's diagnosis CSV files, counted by reason."""
    from cohortkit.sources.files import lake_sources, mixed_lake

    rejects = lake_sources(spark, mixed_lake(spark, sf_dir)).diagnosis_rejects()
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("record").alias("n_records"))


def _published(spark, tables: dict, name: str) -> DataFrame:
    """``tables`` (name -> function of the tables stored so far) written and published in the shared folder; ``name`` as readers find it."""
    from cohortkit.session import checkpoint_dir
    from cohortkit.sources.sinks import Publication, read_published

    out = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex[:12]}"
    publication, stored = Publication(spark, out), {}
    for table, make in tables.items():
        stored[table] = publication.write(table, make(stored))
    publication.commit()
    return read_published(spark, out, name)


def q_published_dx_summary(spark, sf_dir):
    """The working table is stored sorted, the summary is made from its stored code texts, both are published
    together and the summary is read back through the manifest. Equals ``dx_summary``."""
    plan = derived_plan(spark, sf_dir)
    return _published(spark, {"dx_working": lambda t: plan.dx_working,
                              "dx_summary": lambda t: diagnosis.dx_summary(t["dx_working"], plan.maps)}, "dx_summary")


def q_published_dx_working(spark, sf_dir):
    """The working table stored in ranges of patient and date, published and read back. Equals ``dx_working``."""
    from cohortkit.session import checkpoint_dir
    from cohortkit.sources.sinks import Publication, read_published

    out = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex[:12]}"
    publication = Publication(spark, out)
    publication.write_clustered("dx_working", derived_plan(spark, sf_dir).dx_working, ["ENC_HN", "D001KEY"])
    publication.commit()
    return read_published(spark, out, "dx_working")


def q_stored_exact_base(spark, sf_dir):
    """J2 J3 over the three summaries stored in buckets of the patient. Equals ``exact_criteria_base``."""
    from cohortkit.session import checkpoint_dir
    from cohortkit.sources.sinks import Publication, read_published

    plan = CohortPlan(spark, derived_sources(spark, sf_dir).stored(), CodeMaps.default(), DERIVED_STUDY_WINDOW)
    out = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex[:12]}"
    publication = Publication(spark, out)
    stored = [publication.write_bucketed(n, getattr(plan, n), "ENC_HN") for n in ("dx_summary", "med_summary", "rt_summary")]
    publication.write("exact_criteria_base", criteria.exact_criteria_base(*stored))
    publication.commit()
    return read_published(spark, out, "exact_criteria_base")


def q_published_age_issues(spark, sf_dir):
    """The patients without a usable age, published and read back. Equals ``age_exceptions``."""
    plan = derived_plan(spark, sf_dir)
    return _published(spark, {"index_with_age": lambda t: plan.indexed,
                              "potential_age_issues": lambda t: index.age_exceptions(t["index_with_age"])}, "potential_age_issues")


def _by_stored_maps(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A stage by code maps that are written as CSV files and read again; the medication map also lists
    the drug of most events as not included, so the result equals that of the built-in maps."""
    def run(spark, sf_dir):
        from cohortkit.session import checkpoint_dir

        folder = CodeMaps.default().to_dir(spark, f"{checkpoint_dir(spark).rstrip('/')}/maps-{uuid.uuid4().hex[:12]}", (MED_CODE_DEFAULT,))
        return getattr(derived_plan(spark, sf_dir, CodeMaps.from_dir(spark, folder)), name)
    run.__name__ = f"q_mapped_{name}"
    return run


def q_exact_criteria_base_joined(spark, sf_dir):
    """J2 J3 J7 in join form, as ``run`` merges the three stored summaries."""
    plan = derived_plan(spark, sf_dir)
    return criteria.exact_criteria_base(plan.dx_summary, plan.med_summary, plan.rt_summary)


def q_stored_demographics(spark, sf_dir):
    """Birth dates of a stored cohort behind the Bloom filter of its ids. Equals ``demographics_dedup``."""
    plan = derived_plan(spark, sf_dir)
    return _published(spark, {"final_cohort": lambda t: plan.final_cohort,
                              "birth_dates": lambda t: plan.cohort_birth_dates(t["final_cohort"])}, "birth_dates")


def q_id_profile(spark, sf_dir):
    """Widths and kinds of the patient ids of each layout whose widths differ."""
    return crosswalk.id_profile(crosswalk.id_forms(MixedWidths(derived_sources(spark, sf_dir), True).id_layouts()))


def q_id_conflicts(spark, sf_dir):
    """The numbers that one layout writes both with and without leading zeros."""
    return crosswalk.id_conflicts(crosswalk.id_forms(MixedWidths(derived_sources(spark, sf_dir), True).id_layouts()))


def q_crosswalk_exact_base(spark, sf_dir):
    """Sources of three id widths joined by their stored crosswalk. Equals ``exact_criteria_base``."""
    sources = MixedWidths(derived_sources(spark, sf_dir).stored())
    table = _published(spark, {"id_crosswalk": lambda t: crosswalk.id_crosswalk(crosswalk.id_forms(sources.id_layouts()))}, "id_crosswalk")
    return CohortPlan(spark, sources, CodeMaps.default(), DERIVED_STUDY_WINDOW, crosswalk=table).exact_base


def q_refresh_exact_base(spark, sf_dir):
    """Streaming refresh: the derived sources are written as extract files, merged per patient by
    a streaming aggregation, and the exact criteria applied to the snapshot. Equals
    ``exact_criteria_base``."""
    from cohortkit.sources.files import materialize_derived_lake
    from cohortkit.streaming.refresh import StreamLayouts, refresh_merged_summaries, refreshed_base

    lake = materialize_derived_lake(spark, sf_dir, split_layouts=True)

    def schema(folder):
        return spark.read.parquet(f"{lake}/{folder}").schema

    layouts = StreamLayouts(
        diagnosis={f"{lake}/diagnosis": schema("diagnosis")},
        medication={f"{lake}/{f}": schema(f) for f in ("order", "medication_b", "medication_c")},
        procedure={f"{lake}/{f}": schema(f) for f in ("operation", "surgery")},
    )
    out = refresh_merged_summaries(spark, layouts, f"{lake}/merged_summaries", f"{lake}/refresh-checkpoint",
                                   window=DERIVED_STUDY_WINDOW)
    return refreshed_base(spark, out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_codes": q_normalize_codes,
    "parse_dates": q_parse_dates,
    "prefix_match": q_prefix_match,
    "dx_events_filtered": _plan_attr("dx_events"),
    "dx_working": _plan_attr("dx_working"),
    "dx_summary": _plan_attr("dx_summary"),
    "med_standardized": _plan_attr("med_standardized"),
    "med_working": _plan_attr("med_working"),
    "med_summary": _plan_attr("med_summary"),
    "proc_standardized": _plan_attr("proc_standardized"),
    "rt_working": _plan_attr("rt_working"),
    "rt_summary": _plan_attr("rt_summary"),
    "stage_counts": q_stage_counts,
    "exact_criteria_base": _plan_attr("exact_base"),
    "exact_med_evaluated": q_exact_med_evaluated,
    "inferred_unspecified": q_inferred_unspecified,
    "final_cohort": _plan_attr("final_cohort"),
    "exact_criteria_counts": q_exact_criteria_counts,
    "exclusion_steps": q_exclusion_steps,
    "flow_by_availability": q_flow_by_availability,
    "flow_by_index": q_flow_by_index,
    "demographics_dedup": _plan_attr("demographics"),
    "dementia_index": _plan_attr("dementia_index"),
    "age_exceptions": _plan_attr("age_exceptions"),
    "age_exception_stats": q_age_exception_stats,
    "age_filter_counts": q_age_filter_counts,
    "null_id_counts": q_null_id_counts,
    "dementia_index_labelled": q_dementia_index_labelled,
    "label_with_arm": q_label_with_arm,
    "subtype_distribution": q_subtype_distribution,
    "subtype_transition": q_subtype_transition,
    "formatted_percentages": q_formatted_percentages,
    "formatted_transition": q_formatted_transition,
    "review_code_counts": q_review_code_counts,
    "rt_billing_summary": _plan_attr("rt_billing_summary"),
    "memantine_during_rt_events": _plan_attr("memantine_during_rt"),
    "source_profile": q_source_profile,
    "file_dx_summary": _file_attr("dx_summary"),
    "file_med_working": _file_attr("med_working"),
    "file_rt_summary": _file_attr("rt_summary"),
    "file_exact_base": _file_attr("exact_base"),
    "file_dementia_index_labelled": _file_attr("labelled"),
    "file_csv_rejects": q_file_csv_rejects,
    "published_dx_summary": q_published_dx_summary,
    "published_dx_working": q_published_dx_working,
    "stored_exact_base": q_stored_exact_base,
    "published_age_issues": q_published_age_issues,
    "mapped_dx_summary": _by_stored_maps("dx_summary"),
    "mapped_med_working": _by_stored_maps("med_working"),
    "exact_criteria_base_joined": q_exact_criteria_base_joined,
    "refresh_exact_base": q_refresh_exact_base,
    "stored_demographics": q_stored_demographics,
    "id_profile": q_id_profile,
    "id_conflicts": q_id_conflicts,
    "crosswalk_exact_base": q_crosswalk_exact_base,
}
