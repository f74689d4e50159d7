"""Golden end-to-end test: the published 7-patient worked example (FIXTURES.md 2.1)."""

import datetime as dt

from cohortkit.operators.index import label_with_arm
from cohortkit.plans.cohort import CohortPlan
from tests.helpers import MemSources, med

SUBTYPE_CODE = {"AD": "G30.9", "VaD": "F01.9", "Other": "G31.8", "Unspecified": "F03"}

# HN, index, diagnosis, medication, AD, VaD, Other, Unspecified, initial, final
EXAMPLE = [
    ("001", "2016-08-24", "2016-08-24", "2016-08-24", "2016-08-24", None, None, None, "Both / AD", "Both / AD"),
    ("002", "2022-10-17", "2022-10-17", None, None, None, "2022-10-17", None, "Diagnosis / Other", "Diagnosis / Other"),
    ("003", "2023-02-02", None, "2023-02-02", None, None, None, None, "Medication / Unspecified",
     "Medication / Unspecified"),
    ("004", "2010-03-06", "2012-09-01", "2010-03-06", None, "2012-09-01", None, None, "Medication / Unspecified",
     "Both / VaD"),
    ("005", "2018-05-10", "2019-03-01", "2018-05-10", None, None, None, "2019-03-01", "Medication / Unspecified",
     "Both / Unspecified"),
    ("006", "2014-11-03", "2017-06-15", "2014-11-03", "2017-06-15", None, None, "2017-06-15",
     "Medication / Unspecified", "Both / AD"),
    ("007", "2012-09-12", "2012-09-12", None, "2012-09-12", None, "2015-04-20", None, "Diagnosis / AD",
     "Diagnosis / Mixed"),
]


def _d(s):
    return None if s is None else dt.datetime.strptime(s, "%Y-%m-%d")


def example_sources(spark):
    dx, meds, demo = [], [], []
    for hn, _idx, _dx, mdate, ad, vad, other, unspec, *_ in EXAMPLE:
        for sub, d in (("AD", ad), ("VaD", vad), ("Other", other), ("Unspecified", unspec)):
            if d:
                dx.append((hn, d, SUBTYPE_CODE[sub]))
        if mdate:
            meds.append(med(hn, mdate.replace("-", ""), "ARIP-T-"))
        demo.append((hn, 19400101.0))
    return MemSources(spark, dx=dx, med=meds, demo=demo)


def test_worked_example(spark):
    plan = CohortPlan(spark, example_sources(spark))
    lab = {r["ENC_HN"]: r for r in plan.labelled.collect()}
    arms = {r["ENC_HN"]: r for r in label_with_arm(plan.labelled).collect()}
    assert sorted(lab) == [e[0] for e in EXAMPLE]
    for hn, idx, dxd, mdate, ad, vad, other, unspec, initial, final in EXAMPLE:
        r = lab[hn]
        assert r["Index Date"] == _d(idx)
        assert r["Diagnosis Date"] == _d(dxd)
        assert r["Medication Date"] == _d(mdate)
        assert (r["AD Date"], r["VaD Date"], r["Other Date"], r["Unspecified Date"]) == (
            _d(ad), _d(vad), _d(other), _d(unspec))
        assert arms[hn]["Initial Arm Label"] == initial, hn
        assert arms[hn]["Final Arm Label"] == final, hn
