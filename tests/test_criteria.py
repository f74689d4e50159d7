
import datetime as dt

from cohortkit.plans.cohort import CohortPlan
from cohortkit.operators import reports
from tests.helpers import MemSources, med

BORN = 19400101.0


def base_of(spark, **kw):
    plan = CohortPlan(spark, MemSources(spark, **kw))
    return plan, {r["ENC_HN"]: r for r in plan.exact_base.collect()}


def test_t1_mci_prefix_excludes_achei(spark):
    _, b = base_of(spark, dx=[("p1", "20150101", "R41.0")], med=[med("p1", "20150201", "ARIP-T-")])
    assert b["p1"]["exclude_mci_achei"] is True
    assert b["p1"]["is_final_cohort"] is False  # T20: MCI + AChEI only -> base, not cohort


def test_t12_memantine_without_rt_is_left(spark):
    _, b = base_of(spark, med=[med("p1", "20150201", "EBIX-T-")])
    r = b["p1"]
    assert r["memantine_left"] is True and r["exclude_radiotherapy_memantine"] is False
    assert r["is_inferred_unspecified"] is True


def test_t14_excluded_med_and_qualifying_independent(spark):
    _, b = base_of(spark, dx=[("p1", "20140101", "F06.7")],
                   med=[med("p1", "20150101", "ARIP-T-"), med("p1", "20150301", "EBIX-T-")])
    r = b["p1"]
    assert r["excluded_med"] is True and r["is_med_qualifying"] is True
    assert r["medication_date"] == dt.datetime(2015, 3, 1)  # qualified = memantine date (T13)


def test_t15_first_memantine_inside_course_removes_drug(spark):
    _, b = base_of(spark, med=[med("p1", "20150210", "EBIX-T-"), med("p1", "20160101", "EBIX-T-")],
                   operation=[("p1", "20150201", "92.24"), ("p1", "20150301", "92.24")])
    assert b["p1"]["exclude_radiotherapy_memantine"] is True
    assert b["p1"]["is_final_cohort"] is False
    _, b2 = base_of(spark, med=[med("p2", "20150101", "EBIX-T-"), med("p2", "20150210", "EBIX-T-")],
                    operation=[("p2", "20150201", "92.24"), ("p2", "20150301", "92.24")])
    assert b2["p2"]["memantine_left"] is True  # first date before the course: kept


def test_t15_j8_reports_each_event_in_course(spark):
    plan = CohortPlan(spark, MemSources(spark, med=[med("p2", "20150101", "EBIX-T-"), med("p2", "20150210", "EBIX-T-")],
                                        operation=[("p2", "20150201", "92.24"), ("p2", "20150301", "92.24")]))
    rows = plan.memantine_during_rt.collect()
    assert [r["REC_DATE"] for r in rows] == [dt.datetime(2015, 2, 10)]


def test_t18_schizophrenia_before_radiotherapy(spark):
    _, b = base_of(spark, med=[med("p1", "20150210", "CLOZ1T-"), med("p1", "20150210", "EBIX-T-")],
                   operation=[("p1", "20150201", "9223"), ("p1", "20150301", "9223")])
    r = b["p1"]
    assert r["exclude_schizophrenia_memantine"] is True and r["exclude_radiotherapy_memantine"] is False


def test_t20_radiotherapy_only_and_clozapine_only(spark):
    _, b = base_of(spark, med=[med("c1", "20150101", "CLOZ1T-")], operation=[("r1", "20150101", "92.24")])
    assert "r1" not in b
    assert b["c1"]["is_final_cohort"] is False


def test_t6_window_end_is_midnight(spark):
    _, b = base_of(spark, dx=[("p1", "2025-12-31 00:00:00", "F03"), ("p2", "2025-12-31 00:00:01", "F03")])
    assert "p1" in b and "p2" not in b


def test_t7_two_times_one_day(spark):
    plan = CohortPlan(spark, MemSources(spark, dx=[("p1", "2015-01-01 08:00:00", "F03"),
                                                   ("p1", "2015-01-01 09:00:00", "G30.9")]))
    assert plan.dx_working.count() == 2


def test_t2_comma_list_is_one_code(spark):
    plan = CohortPlan(spark, MemSources(spark, dx=[("p1", "20150101", "F03, G30.9")]))
    r = plan.dx_summary.collect()[0]
    assert r["unspecified_date"] == dt.datetime(2015, 1, 1) and r["ad_date"] is None
    assert plan.dx_working.collect()[0]["D035KEY"] == "F03G309"


def test_e23_same_day_tie_counts_both(spark):
    plan = CohortPlan(spark, MemSources(spark, dx=[("p1", "20150101", "F03")],
                                        med=[med("p1", "20150101", "ARIP-T-")], demo=[("p1", BORN)]))
    flow = {r["step_order"]: r["Patients"] for r in reports.flow_report(plan.exact_base, by="index").collect()}
    assert flow[11] == 1 and flow[9] == 0 and flow[10] == 0


def test_e26_labels(spark):
    plan = CohortPlan(spark, MemSources(spark, dx=[("m", "20150101", "G30.9"), ("m", "20150101", "F01.9"),
                                                   ("a", "20150101", "G30.9"), ("a", "20150101", "F03")],
                                        demo=[("m", BORN), ("a", BORN)]))
    lab = {r["ENC_HN"]: r["Initial Label"] for r in plan.labelled.collect()}
    assert lab == {"m": "Mixed", "a": "AD"}


def test_t16_t17_age_and_birth_dates(spark):
    plan = CohortPlan(spark, MemSources(
        spark,
        dx=[("n", "20150101", "F03"), ("l", "20150101", "F03"), ("u", "20150101", "F03"), ("y", "20150101", "F03")],
        demo=[("n", 19500101.0), ("n", None), ("l", 19500101.0), ("l", 19510101.0), ("y", 20100101.0)]))
    dob = {r["ENC_HN"]: r["D020AT3"] for r in plan.demographics.collect()}
    assert dob["n"] is None and dob["l"] == dt.datetime(1951, 1, 1)
    ages = {r["ENC_HN"]: r["age_at_index"] for r in plan.indexed.collect()}
    assert ages["u"] is None and ages["n"] is None
    assert ages["l"] == (dt.date(2015, 1, 1) - dt.date(1951, 1, 1)).days / 365
    assert {r["ENC_HN"] for r in plan.dementia_index.collect()} == {"l"}
    assert {r["ENC_HN"] for r in plan.age_exceptions.collect()} == {"y"}


def test_a16_empty_label_row_is_zero(spark):
    plan = CohortPlan(spark, MemSources(spark, dx=[("a", "20150101", "G30.9")], demo=[("a", BORN)]))
    t = {r["Index \\ Final"]: r for r in reports.subtype_transition(plan.labelled).collect()}
    assert t["VaD"]["Row Total"] == 0 and t["VaD"]["VaD %"] == 0.0
    assert t["AD"]["AD"] == 1 and t["AD"]["AD %"] == 100.0
    d = {r["Subtype"]: r for r in reports.subtype_distribution(plan.labelled).collect()}
    assert d["Mixed Dementia"]["Index n"] == 0 and d["Total"]["Index n"] == 1


def test_s14_empty_inputs_give_typed_empty_tables(spark):
    plan = CohortPlan(spark, MemSources(spark))
    for name in ("dx_working", "dx_summary", "med_working", "med_summary", "rt_summary", "exact_base", "labelled"):
        df = getattr(plan, name)
        assert df.count() == 0 and len(df.columns) > 2, name
    dist = reports.subtype_distribution(plan.labelled).collect()
    assert [r["Index n"] for r in dist] == [0] * 6 and all(r["Index %"] == 0.0 for r in dist[:5])


def test_t10_null_ids_dropped_and_counted(spark):
    plan = CohortPlan(spark, MemSources(spark, dx=[(None, "20150101", "F03"), ("p1", "20150101", "F03")],
                                        demo=[("p1", BORN)]))
    assert [r["ENC_HN"] for r in plan.exact_base.collect()] == ["p1"]
    counts = {r["metric"]: r["value"] for r in reports.null_id_counts(plan).collect()}
    assert counts["diagnosis_null_id_rows"] == 1 and counts["medication_null_id_rows"] == 0


def test_e31_billing_course_as_exclusion(spark):
    src = MemSources(spark, med=[med("p1", "20150210", "EBIX-T-"), med("p1", "20150201", "X00825"),
                                 med("p1", "20150301", "X01376")],
                     operation=[("p2", "20150201", "92.24")])
    icd9 = {r["ENC_HN"]: r for r in CohortPlan(spark, src).exact_base.collect()}
    assert icd9["p1"]["memantine_left"] is True  # no ICD-9 course for p1
    billing = {r["ENC_HN"]: r for r in CohortPlan(spark, src, rt_method="billing").exact_base.collect()}
    assert billing["p1"]["exclude_radiotherapy_memantine"] is True
    assert billing["p1"]["rt_first_date"] == dt.datetime(2015, 2, 1)
    both = {r["ENC_HN"]: r for r in CohortPlan(spark, src, rt_method="both").rt_summary.collect()}
    assert set(both) == {"p1", "p2"}
    b = CohortPlan(spark, src).rt_billing_summary.collect()[0]
    assert b["has_brain_spine_code"] is True and b["n_billing_events"] == 2
