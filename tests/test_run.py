"""End to end: CohortPlan.run writes every published table; stored results equal the lazy plan."""

from cohortkit.checks.compare import rows_of
from cohortkit.plans.cli import main
from tests.conftest import SF_SMALL


def test_run_writes_tables_equal_to_lazy_plan(spark, tmp_dir):
    from cohortkit.plans.queries import QUERIES

    written = main(["--out", f"{tmp_dir}/out", "--derived-from", SF_SMALL])
    expected = {"dx_working", "dx_summary", "med_working", "med_summary", "rt_working", "rt_summary",
                "exact_criteria_base", "exact_med_evaluated", "inferred_unspecified", "final_cohort_exact_step",
                "exact_criteria_counts", "potential_age_issues", "dementia_index", "dementia_index_labelled",
                "subtype_distribution", "subtype_transition", "flow_by_availability", "flow_by_index",
                "exclusion_steps", "index_with_age", "age_exception_stats", "age_filter_counts",
                "review_code_counts", "memantine_during_rt_events"}
    assert expected <= set(written)
    published = spark.read.parquet(written["subtype_distribution"]).columns
    assert set(published) >= {"Subtype", "Index n", "Index %", "Index n (%)", "Final n", "Final %", "Final n (%)"}
    for table, query in [("dx_summary", "dx_summary"), ("exact_criteria_base", "exact_criteria_base"),
                         ("dementia_index_labelled", "dementia_index_labelled"),
                         ("subtype_transition", "formatted_transition"), ("subtype_distribution", "formatted_percentages"),
                         ("subtype_transition_exact", "subtype_transition"), ("stage_counts", "stage_counts"),
                         ("null_id_counts", "null_id_counts"), ("potential_age_issues", "age_exceptions"),
                         ("review_code_counts", "review_code_counts"), ("age_exception_stats", "age_exception_stats"),
                         ("memantine_during_rt_events", "memantine_during_rt_events")]:
        stored = spark.read.parquet(written[table]).toPandas()
        lazy = QUERIES[query](spark, SF_SMALL).toPandas()
        assert rows_of(stored) == rows_of(lazy), table


def test_union_aggregate_equals_join_form(spark):
    """The single-aggregate merge equals the full-outer/left join of the three summaries."""
    from cohortkit.operators import criteria
    from cohortkit.plans.queries import derived_plan

    plan = derived_plan(spark, "/root/testdata/sf0.01")
    joined = criteria.exact_criteria_base(plan.dx_summary, plan.med_summary, plan.rt_summary)
    assert rows_of(joined.toPandas()) == rows_of(plan.exact_base.toPandas())


def test_cli_over_a_file_lake(spark, tmp_dir):
    """The CLI on a Parquet lake (file arguments) writes the same labelled cohort as the
    lazy plan over the derived sources."""
    from cohortkit.plans.queries import QUERIES
    from cohortkit.sources.files import materialize_derived_lake

    lake = materialize_derived_lake(spark, SF_SMALL, root=f"{tmp_dir}/lake")
    written = main(["--out", f"{tmp_dir}/out2", "--diagnosis-dir", f"{lake}/diagnosis", "--order-dir", f"{lake}/order",
                    "--medication-dir", f"{lake}/medication", "--procedure-dir", f"{lake}/operation",
                    "--procedure-dir", f"{lake}/surgery", "--demographic", f"{lake}/demographic",
                    "--pattern", "*.parquet", "--start", "1996-01-01", "--end", "2001-06-30"])
    assert {r["columns"] for r in spark.read.parquet(written["source_profile"]).collect()} == {
        "ENC_HN, D001KEY, D036KEY", "ENC_HN, D001KEY, OPR_1, OPR_2"}
    stored = spark.read.parquet(written["dementia_index_labelled"]).toPandas()
    assert rows_of(stored) == rows_of(QUERIES["dementia_index_labelled"](spark, SF_SMALL).toPandas())


def test_working_tables_are_sorted_within_files_o1(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from cohortkit.plans.queries import derived_plan
    from cohortkit.sources.sinks import write_table

    path = write_table(derived_plan(spark, SF_SMALL).dx_working, f"{tmp_dir}/sorted", sort_within=["ENC_HN", "D001KEY"])
    files = glob.glob(f"{path}/part-*.parquet")
    assert files
    for f in files:
        t = pq.read_table(f, columns=["ENC_HN", "D001KEY"]).to_pylist()
        keys = [(r["ENC_HN"], r["D001KEY"]) for r in t]
        assert keys == sorted(keys)
