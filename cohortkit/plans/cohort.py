"""The cohort plan: every stage of the pipeline as a lazy DataFrame over one set of sources.

``CohortPlan`` wires the operators together; each property returns a DataFrame and nothing
runs until an action. Sources are anything with ``diagnosis_layouts()``, ``medication_layouts()``,
``procedure_layouts()`` and ``demographic()`` (derived sources or file sources).

``CohortPlan.run(out_dir)`` materializes the published tables. Each arm's working table is
written once and read back, which cuts the lineage (an executor lost later recomputes from
the written table, not from the raw sources) and lets both the summary and the reports
reuse it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators import criteria, diagnosis, index, medication, prefilter, radiotherapy, reports
from cohortkit.operators.standardize import (
    medication_union, patient_id, procedure_union, standardized_medication, standardized_procedure,
)
from cohortkit.schemas import StudyWindow
from cohortkit.sources.codemaps import CodeMaps
from cohortkit.sources.crosswalk import with_crosswalk


@dataclass
class CohortPlan:
    spark: SparkSession
    sources: object
    maps: CodeMaps = field(default_factory=CodeMaps.default)
    window: StudyWindow = field(default_factory=StudyWindow)
    # radiotherapy course for the memantine exclusion: ICD-9 procedure codes (method 1, as
    # published), institution billing codes on the order/medication events (method 2), or both
    rt_method: str = "icd9"
    # raw_id -> ENC_HN (``sources.crosswalk``), applied to the filtered events and the demographic rows; a stored table
    crosswalk: DataFrame | None = None

    # -- diagnosis arm -------------------------------------------------------------------
    @cached_property
    def dx_standardized(self) -> DataFrame:
        return diagnosis.dx_standardized(self.spark, self.sources.diagnosis_layouts().values())

    @cached_property
    def dx_events(self) -> DataFrame:
        events = diagnosis.dx_events_from_layouts(self.spark, self.sources.diagnosis_layouts().values(),
                                                  self.maps, self.window)
        return with_crosswalk(events, self.crosswalk)

    @cached_property
    def dx_working(self) -> DataFrame:
        return diagnosis.dx_working(self.dx_events, self.maps)

    @cached_property
    def dx_summary(self) -> DataFrame:
        # lazily composed: straight from the events (one shuffle); ``run`` builds it from the
        # stored dx_working table instead
        return diagnosis.dx_summary_from_events(self.dx_events, self.maps)

    # -- medication arm ------------------------------------------------------------------
    @cached_property
    def med_standardized(self) -> DataFrame:
        return standardized_medication(self.spark, self.sources.medication_layouts().values())

    @cached_property
    def med_union(self) -> DataFrame:
        return medication_union(self.spark, self.sources.medication_layouts().values())

    @cached_property
    def med_working(self) -> DataFrame:
        working = medication.med_working_from_layouts(self.spark, self.sources.medication_layouts().values(),
                                                      self.maps, self.window)
        return with_crosswalk(working, self.crosswalk)

    @cached_property
    def med_summary(self) -> DataFrame:
        return medication.med_summary(self.med_working)

    # -- procedure arm -------------------------------------------------------------------
    @cached_property
    def proc_standardized(self) -> DataFrame:
        return standardized_procedure(self.spark, self.sources.procedure_layouts().values())

    @cached_property
    def proc_union(self) -> DataFrame:
        return procedure_union(self.spark, self.sources.procedure_layouts().values())

    @cached_property
    def rt_working(self) -> DataFrame:
        if self.rt_method not in ("icd9", "billing", "both"):
            raise ValueError(f"rt_method must be icd9, billing or both, not {self.rt_method!r}")
        icd9 = radiotherapy.rt_working_from_layouts(self.spark, self.sources.procedure_layouts().values(),
                                                    self.maps, self.window)
        icd9 = with_crosswalk(icd9, self.crosswalk)
        if self.rt_method == "icd9":
            return icd9
        billing = self.rt_billing_working.select(
            "ENC_HN", F.col("REC_DATE").alias("PROC_DATE"), F.col("CODE").alias("PROC_CODE"))
        return billing if self.rt_method == "billing" else icd9.unionByName(billing)

    @cached_property
    def rt_summary(self) -> DataFrame:
        return radiotherapy.rt_summary(self.rt_working)

    @cached_property
    def rt_billing_working(self) -> DataFrame:
        billing = radiotherapy.rt_billing_from_layouts(self.spark, self.sources.medication_layouts().values(),
                                                       self.maps, self.window)
        return with_crosswalk(billing, self.crosswalk)

    @cached_property
    def rt_billing_summary(self) -> DataFrame:
        return radiotherapy.rt_billing_summary(self.rt_billing_working)

    @cached_property
    def memantine_during_rt(self) -> DataFrame:
        return radiotherapy.memantine_during_rt(self.med_working, self.rt_summary)

    # -- exact criteria ------------------------------------------------------------------
    @cached_property
    def exact_base(self) -> DataFrame:
        """Lazily composed: one aggregate over the union of the three filtered event streams
        (one shuffle); ``run`` uses the join form over the stored summaries (J2, J3)."""
        merged = criteria.merged_summaries_from_events(self.dx_events, self.med_working, self.rt_working, self.maps)
        return criteria.apply_criteria(merged)

    @cached_property
    def final_cohort(self) -> DataFrame:
        return criteria.final_cohort(self.exact_base)

    # -- index, age, labels --------------------------------------------------------------
    @cached_property
    def demographic_rows(self) -> DataFrame:
        rows = self.sources.demographic()
        return rows if self.crosswalk is None else with_crosswalk(rows.withColumn("ENC_HN", patient_id(rows)), self.crosswalk)

    @cached_property
    def demographics(self) -> DataFrame:
        return index.demographics_dedup(self.demographic_rows, self.final_cohort)

    def cohort_birth_dates(self, cohort: DataFrame) -> DataFrame:
        """``demographics`` for a stored cohort: a Bloom filter of its ids keeps most other patients out of the shuffle."""
        rows = self.demographic_rows
        return index.demographics_dedup(prefilter.possible_rows(rows.withColumn("ENC_HN", patient_id(rows)), cohort), cohort)

    @cached_property
    def indexed(self) -> DataFrame:
        """All final-cohort patients with age at index (before the adult filter).

        Birth dates are deduplicated over the demographic table and joined once, so the
        cohort sub-plan is evaluated once (a semi-join on the cohort would evaluate it twice).
        """
        return index.index_with_age(self.final_cohort, index.birth_dates(self.demographic_rows))

    @cached_property
    def dementia_index(self) -> DataFrame:
        return index.dementia_index(self.indexed)

    @cached_property
    def age_exceptions(self) -> DataFrame:
        return index.age_exceptions(self.indexed)

    @cached_property
    def labelled(self) -> DataFrame:
        return index.label_subtypes(self.dementia_index)

    # -- reports -------------------------------------------------------------------------
    def flow_by_availability(self) -> DataFrame:
        return reports.flow_report(self.exact_base, by="availability")

    def flow_by_index(self) -> DataFrame:
        return reports.flow_report(self.exact_base, by="index")

    def subtype_distribution(self) -> DataFrame:
        return reports.subtype_distribution(self.labelled)

    def subtype_transition(self) -> DataFrame:
        return reports.subtype_transition(self.labelled)

    # -- materialization -----------------------------------------------------------------
    def run(self, out_dir: str) -> dict[str, str]:
        """Write the published tables under ``out_dir`` (a shared folder on a cluster) and publish
        them together (``sinks.published``); a run that fails leaves the set published before.

        Working tables are written first and read back, so the summaries, the exact base and
        the reports are computed from stored tables, not from the raw sources again. They are clustered by
        patient and date; the summaries are bucketed by patient, so the exact base joins them without a shuffle.
        """
        from cohortkit.sources.sinks import Publication

        publication = Publication(
            self.spark, out_dir,
            clustered={"dx_working": ["ENC_HN", "D001KEY"], "med_working": ["ENC_HN", "REC_DATE"], "rt_working": ["ENC_HN", "PROC_DATE"]},
            bucketed=dict.fromkeys(("dx_summary", "med_summary", "rt_summary"), "ENC_HN"))
        try:
            self._write_tables(publication.write)
            return publication.commit()
        finally:
            publication.release()

    def _write_tables(self, save) -> None:
        # FIXED VALUES: the table names below are the published ones (or say what was added)
        dxw = save("dx_working", self.dx_working)
        dxs = save("dx_summary", diagnosis.dx_summary(dxw, self.maps))
        mdw = save("med_working", self.med_working)
        mds = save("med_summary", medication.med_summary(mdw))
        rtw = save("rt_working", self.rt_working)
        rts = save("rt_summary", radiotherapy.rt_summary(rtw))
        base = save("exact_criteria_base", criteria.exact_criteria_base(dxs, mds, rts))
        save("exact_med_evaluated", criteria.exact_med_evaluated(base))
        save("inferred_unspecified", criteria.inferred_unspecified(base))
        fc = save("final_cohort_exact_step", criteria.final_cohort(base))
        save("exact_criteria_counts", criteria.exact_criteria_counts(base))
        dob = self.cohort_birth_dates(fc)
        indexed = save("index_with_age", index.index_with_age(fc, dob))
        save("potential_age_issues", index.age_exceptions(indexed))
        di = save("dementia_index", index.dementia_index(indexed))
        lab = save("dementia_index_labelled", index.label_subtypes(di))
        save("subtype_distribution", reports.subtype_distribution_display(lab))
        save("subtype_transition", reports.subtype_transition_display(lab))
        # the unrounded forms, for checks
        save("subtype_distribution_exact", reports.subtype_distribution(lab))
        save("subtype_transition_exact", reports.subtype_transition(lab))
        save("flow_by_availability", reports.flow_report(base, by="availability"))
        save("flow_by_index", reports.flow_report(base, by="index"))
        save("exclusion_steps", reports.exclusion_steps(base))
        save("age_exception_stats", reports.age_exception_stats(indexed))
        save("age_filter_counts", reports.age_filter_counts(indexed))
        # codes under review from the stored working table: its distinct codes per
        # (patient, time) give the same distinct-patient counts as the events
        dx_codes = dxw.select("ENC_HN", F.explode(F.split("D035KEY", ", ")).alias("code"))
        save("review_code_counts", reports.review_code_counts(dx_codes, self.maps))
        save("memantine_during_rt_events", radiotherapy.memantine_during_rt(mdw, rts))
        save("stage_counts", reports.stage_counts(dxw, mdw, rtw))
        save("null_id_counts", reports.null_id_counts(self))
        profile = getattr(self.sources, "profile", None)
        if profile:
            save("source_profile", profile())
