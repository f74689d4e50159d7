"""Patient ids of several widths (U1, T25) and the Bloom filter in front of the demographic aggregate."""

import pytest

from cohortkit.operators import index, prefilter
from cohortkit.plans.cohort import CohortPlan
from cohortkit.plans.queries import derived_plan
from cohortkit.sources import crosswalk
from tests.conftest import SF_CHECK
from tests.helpers import MemSources, med


def frames(spark):
    text = lambda *ids: spark.createDataFrame([(i,) for i in ids], "ENC_HN string")
    numbers = spark.createDataFrame([(123,), (123,), (12345678,), (None,), (77,), (0,)], "ENC_HN bigint")
    return {"a": text("0000123", "0000123", "0012345678", "A12", None, "", "077", "77", "000"), "b": numbers,
            "c": text("00000000000123", "٣"), "d": spark.createDataFrame([(1,)], "x int")}


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_profile_conflicts_and_crosswalk(spark):
    forms = crosswalk.id_forms(frames(spark))
    assert as_rows(crosswalk.id_conflicts(forms)) == [("a", "077", "77", 2, 1), ("a", "77", "77", 2, 1)]
    assert dict(as_rows(crosswalk.id_crosswalk(forms))) == {
        "123": "0000123", "00000000000123": "0000123", "0012345678": "12345678", "0": "0000000", "000": "0000000"}
    got = {tuple(r)[:3]: tuple(r)[3:] for r in crosswalk.id_profile(forms).collect()}
    assert got["a", "leading zeros", 7] == (1, 2) and got["b", "digits", 3] == (1, 2) and got["c", "other", 1] == (1, 1)
    assert got["a", "other", 0] == (1, 1) and got["a", "leading zeros", 3] == (2, 2) and sum(n for n, _ in got.values()) == forms.count()


def test_rows_keep_their_number_and_conflicts_their_ids(spark):
    layouts = frames(spark)
    table = crosswalk.id_crosswalk(crosswalk.id_forms(layouts))
    rows = layouts["a"].selectExpr("ENC_HN", "monotonically_increasing_id() AS n")
    got = crosswalk.with_crosswalk(rows, table)
    assert got.columns == rows.columns and sorted(str(r[0]) for r in got.collect()) == sorted(
        ["0000123", "0000123", "12345678", "A12", "None", "", "077", "77", "0000000"])
    assert crosswalk.with_crosswalk(rows, None) is rows
    assert crosswalk.with_crosswalk(rows.limit(0), table).count() == 0 and crosswalk.id_conflicts(crosswalk.id_forms({"a": rows.limit(0)})).count() == 0
    with pytest.raises(ValueError):
        crosswalk.id_forms({"d": layouts["d"]})


def test_mixed_widths_are_two_patients_without_and_one_with_a_crosswalk(spark):
    src = MemSources(spark, dx=[("0000123", "20150102", "G300")], med=[med("123", "20150101", "DON5")], demo=[("00123", 19400101.0)])
    plain = CohortPlan(spark, src).exact_base
    table = crosswalk.id_crosswalk(crosswalk.id_forms({**src.diagnosis_layouts(), **src.medication_layouts(), "demographic": src.demographic()}))
    plan = CohortPlan(spark, src, crosswalk=table)
    assert "0000123" in {r["ENC_HN"] for r in plain.collect()} and {r["ENC_HN"] for r in plan.exact_base.collect()} == {"0000123"}
    assert [(r["ENC_HN"], r["age_at_index"] is not None) for r in plan.indexed.collect()] == [("0000123", True)]


def test_prefilter_loses_no_row_of_the_cohort(spark):
    ids = spark.range(0, 300_000, 30).selectExpr("CAST(id AS STRING) AS ENC_HN").unionByName(spark.createDataFrame([(None,)], "ENC_HN string"))
    rows = spark.range(300_000).selectExpr("CAST(id AS STRING) AS ENC_HN", "id AS __set_like").unionByName(
        spark.createDataFrame([(None, 1)], "ENC_HN string, __set_like long"))
    got = prefilter.possible_rows(rows, ids)
    assert got.columns == rows.columns
    assert got.join(ids, "ENC_HN", "left_semi").count() == 10_000
    assert 10_000 <= got.count() <= 10_000 + 0.05 * 300_000
    assert prefilter.possible_rows(rows, ids.limit(0)).count() == 0


def test_a_cohort_too_large_is_not_filtered(spark, monkeypatch):
    monkeypatch.setattr(prefilter, "MAX_BITMAPS", 1)
    rows, ids = spark.range(9).selectExpr("CAST(id AS STRING) AS ENC_HN"), spark.range(3_000).selectExpr("CAST(id AS STRING) AS ENC_HN")
    assert prefilter.possible_rows(rows, ids) is rows


def test_rows_shuffled_fall_to_the_cohort(spark):
    plan = derived_plan(spark, SF_CHECK)
    cohort = spark.createDataFrame(plan.final_cohort.select("ENC_HN").collect(), "ENC_HN string")
    demo = plan.demographic_rows
    passed, n, everyone = prefilter.possible_rows(demo, cohort).count(), cohort.count(), demo.count()
    exact = demo.join(cohort, "ENC_HN", "left_semi").count()
    assert n and exact <= passed <= exact + 0.05 * everyone and passed < everyone
    same = lambda df: sorted(map(str, df.collect()))
    assert same(plan.cohort_birth_dates(cohort)) == same(index.demographics_dedup(demo, cohort))
