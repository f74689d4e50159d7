"""Property tests: the Spark plan against the plain-Python rules on random small fixtures,
plus the published identities on the driver data."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortkit.plans.cohort import CohortPlan
from tests.bruteforce import cohort
from tests.helpers import MemSources, med

PATIENTS = [f"{i:07d}" for i in range(1, 7)]
DAYS = [dt.date(2009, 12, 31), dt.date(2010, 1, 1), dt.date(2012, 5, 3), dt.date(2014, 2, 28),
        dt.date(2016, 7, 9), dt.date(2016, 7, 10), dt.date(2020, 1, 1), dt.date(2025, 12, 31), dt.date(2026, 1, 1)]
DX_CODES = ["G30.9", "F00.1", "F01.9", "G31.8", "F03", "f03.9", "F06.7", "R41", "R41.0", "F20.0", "G31.2",
            "R44.1", "F03, G30.9", "Z00.0", None]
MED_CODES = ["DONT-T-", "EXEL1C-", "EBIX-T-", "MEMA-T-", "CLOZ1T-", "PARA-T-", None]
OP_CODES = ["92.24", "9223", "9241", "8751", None]


def date_text(d: dt.date, fmt: int, junk: int) -> str:
    if junk == 1:
        return "n/a"
    if junk == 2:
        return f"{d.year}"
    return [d.strftime("%Y%m%d"), d.isoformat(), d.isoformat() + " 00:00:00"][fmt]


rowdate = st.tuples(st.sampled_from(DAYS), st.integers(0, 2), st.sampled_from([0, 0, 0, 0, 1, 2])).map(
    lambda t: date_text(*t))
dx_row = st.tuples(st.sampled_from(PATIENTS), rowdate, st.sampled_from(DX_CODES))
med_row = st.tuples(st.sampled_from(PATIENTS), rowdate, st.sampled_from(MED_CODES))
op_row = st.tuples(st.sampled_from(PATIENTS), rowdate, st.sampled_from(OP_CODES))
demo_row = st.tuples(st.sampled_from(PATIENTS),
                     st.sampled_from([19400101.0, 19501231.0, 20000101.0, 20050615.0, None, 19990231.0]))


@settings(max_examples=int(os.environ.get("COHORTKIT_PROPERTY_EXAMPLES", "12")), deadline=None,
          suppress_health_check=list(HealthCheck))
@given(st.lists(dx_row, max_size=14), st.lists(med_row, max_size=10), st.lists(op_row, max_size=6),
       st.lists(demo_row, max_size=8))
def test_plan_matches_rules(spark, dx, meds, ops, demo):
    plan = CohortPlan(spark, MemSources(spark, dx=dx, med=[med(*r) for r in meds], operation=ops, demo=demo))
    want_base, want_lab = cohort(dx, meds, ops, demo)
    got_base = {r["ENC_HN"]: r.asDict() for r in plan.exact_base.collect()}
    assert set(got_base) == set(want_base)
    for hn, w in want_base.items():
        for k, v in w.items():
            assert got_base[hn][k] == v, (hn, k)
    got_lab = {r["ENC_HN"]: r.asDict() for r in plan.labelled.collect()}
    assert set(got_lab) == set(want_lab)
    for hn, w in want_lab.items():
        for k, v in w.items():
            assert got_lab[hn][k] == v, (hn, k)


def test_published_identities_on_driver_data(spark):
    """Identities that hold for any data, checked on the sf0.01 derived sources."""
    from cohortkit.operators import reports
    from cohortkit.plans.queries import derived_plan

    plan = derived_plan(spark, "/root/testdata/sf0.01")
    base = plan.exact_base.cache()
    avail = {r["step_order"]: r["Patients"] for r in reports.flow_report(base, "availability").collect()}
    index = {r["step_order"]: r["Patients"] for r in reports.flow_report(base, "index").collect()}
    excl = {r["Step"]: r["Patients"] for r in reports.exclusion_steps(base).collect()}
    assert avail[3] + avail[4] + avail[5] == avail[6]
    assert avail[9] + avail[10] + avail[11] == avail[12] == index[12]
    assert index[9] + index[10] + index[11] == index[12]
    assert avail[1] + avail[10] == avail[12]
    assert excl["AChEI patients"] - excl["AChEI excluded by MCI"] == excl["AChEI left"]
    assert excl["Memantine patients"] - excl["Memantine excluded by schizophrenia/clozapine"] == \
        excl["Memantine remaining after schizo"]
    assert excl["Memantine remaining after schizo"] - excl["Memantine excluded by radiotherapy"] == \
        excl["Memantine left"]
    assert excl["Medication patients evaluated"] - excl["Medication excluded patients (total)"] == \
        excl["Medication qualifying patients"]
    lab = plan.labelled.cache()
    n = lab.count()
    dist = {r["Subtype"]: r for r in reports.subtype_distribution(lab).collect()}
    assert sum(r["Index n"] for k, r in dist.items() if k != "Total") == n
    assert sum(r["Final n"] for k, r in dist.items() if k != "Total") == n
    trans = {r["Index \\ Final"]: r for r in reports.subtype_transition(lab).collect()}
    for a in ("AD", "VaD", "Other"):
        assert trans[a]["Unspecified"] == 0  # specific subtypes never move to Unspecified
        assert trans[a]["Row Total"] == trans[a][a] + trans[a]["Mixed"]
    assert trans["Mixed"]["Row Total"] == trans["Mixed"]["Mixed"]
    assert trans["Column Total"]["Row Total"] == n
    base.unpersist()
    lab.unpersist()
