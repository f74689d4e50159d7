"""Physical-plan properties of the registered queries (what must hold at 100 TB)."""

import os

import pytest

from cohortkit.plans.cohort import CohortPlan
from cohortkit.plans.queries import QUERIES
from cohortkit.sources.files import FileSources
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"source_profile", "refresh_exact_base"}))
def test_no_nested_loop_or_python_in_plan(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_summaries_aggregate_map_side(spark):
    from cohortkit.plans.queries import derived_plan

    p = derived_plan(spark, SF_SMALL)
    for df in (p.dx_summary, p.med_summary, p.rt_summary, p.exact_base):
        plan = physical(df)
        assert "partial_min" in plan and "Exchange hashpartitioning(ENC_HN" in plan


def test_scan_reads_only_needed_columns(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    d = os.path.join(tmp_dir, "diagnosis")
    os.makedirs(d)
    pq.write_table(pa.table({"ENC_HN": ["p"], "D001KEY": ["20150101"], "D035KEY": ["F03"], "WARD": ["x"],
                             "NOTE": ["long text"]}), f"{d}/a.parquet")
    plan = physical(CohortPlan(spark, FileSources(spark, diagnosis_dir=d)).dx_summary)
    assert "ReadSchema: struct<ENC_HN:string,D001KEY:string,D035KEY:string>" in plan
    assert "WARD" not in plan and "NOTE" not in plan


def test_labelled_cohort_needs_two_patient_shuffles(spark):
    """Without broadcasts (large-scale sizes): the merged arms (one aggregate) and the birth dates
    (one aggregate) are the only shuffles on the patient id; their join adds none."""
    from cohortkit.plans.queries import derived_plan

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = physical(derived_plan(spark, SF_SMALL).labelled)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert plan.count("Exchange hashpartitioning(ENC_HN") == 2


def test_typed_dates_push_the_window_to_parquet(spark, tmp_dir):
    """A typed event date gets the study window as a pushed Parquet filter (row-group skipping);
    the result is the same as the text-date path."""
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    d = os.path.join(tmp_dir, "dx")
    os.makedirs(d)
    ts = [dt.datetime(2009, 12, 31, 23, 0), dt.datetime(2010, 1, 1), dt.datetime(2025, 12, 31),
          dt.datetime(2025, 12, 31, 0, 0, 1)]
    pq.write_table(pa.table({"ENC_HN": ["a", "b", "c", "d"], "D001KEY": pa.array(ts, pa.timestamp("us")),
                             "D035KEY": ["F03"] * 4}), f"{d}/ts.parquet")
    pq.write_table(pa.table({"ENC_HN": ["e", "f"], "D001KEY": pa.array([dt.date(2009, 12, 31), dt.date(2025, 12, 31)]),
                             "D035KEY": ["F03", "F03"]}), f"{d}/date.parquet")
    pq.write_table(pa.table({"ENC_HN": ["g", "h"], "D001KEY": ["20091231", "20251231"], "D035KEY": ["F03", "F03"]}),
                   f"{d}/text.parquet")
    events = CohortPlan(spark, FileSources(spark, diagnosis_dir=d)).dx_events
    assert sorted(r["ENC_HN"] for r in events.collect()) == ["b", "c", "f", "h"]
    plan = physical(events)
    assert "PushedFilters: [IsNotNull(D001KEY), GreaterThanOrEqual(D001KEY,2010-01-01T00:00)" in plan
    assert "GreaterThanOrEqual(D001KEY,2010-01-01)" in plan  # the date-typed layout


def test_derivation_join_runs_once(spark):
    """Without broadcasts the derivation's join is shuffled once for all seven branches of the
    cohort: the other branches reuse its exchanges."""
    from cohortkit.plans.queries import derived_plan

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = physical(derived_plan(spark, SF_SMALL).exact_base)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 3  # lineitem, orders, patients


def test_each_code_is_looked_up_once(spark):
    """The flags of a code come from one mask, computed below the aggregate; only the diagnosis filter has a pattern."""
    from cohortkit.plans.queries import derived_plan

    p = derived_plan(spark, SF_SMALL)
    for df in (p.dx_working, p.dx_summary):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RLIKE") == 1 and plan.count("substring(code") <= 8, plan
