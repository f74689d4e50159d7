"""A hot patient (most of the rows) in J8: equal events meet before the join; results exact."""

import datetime as dt

from cohortkit.plans.cohort import CohortPlan
from tests.helpers import MemSources, med


def test_hot_patient_memantine_in_course_is_counted_before_the_join(spark):
    base = dt.date(2015, 1, 1)
    meds = [med("hot", (base + dt.timedelta(days=i % 400)).strftime("%Y%m%d"), "EBIX-T-") for i in range(6000)]
    meds += [med(f"p{i}", "20150301", "EBIX-T-") for i in range(200)]
    ops = [("hot", "20150201", "92.24"), ("hot", "20150901", "92.24")]
    ops += [(f"p{i}", "20150201", "9223") for i in range(0, 200, 2)] + [(f"p{i}", "20150401", "9223") for i in range(0, 200, 2)]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = CohortPlan(spark, MemSources(spark, med=meds, operation=ops))
        df = plan.memantine_during_rt
        rows = df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    want_hot = sum(1 for i in range(6000) if dt.date(2015, 2, 1) <= base + dt.timedelta(days=i % 400) <= dt.date(2015, 9, 1))
    assert sum(1 for r in rows if r["ENC_HN"] == "hot") == want_hot
    assert sum(1 for r in rows if r["ENC_HN"] != "hot") == 100
    assert "SortMergeJoin [ENC_HN" in final and "partial_count(1)" in final
