"""Publication: all tables of a run or none, numbered manifests, removal of old runs."""

import os

import pytest

from cohortkit.plans.cohort import CohortPlan
from cohortkit.plans.queries import derived_plan
from cohortkit.sources.sinks import Publication, drop_old, published, read_published
from tests.conftest import SF_SMALL


def _numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x long")


def _values(spark, out, name):
    return sorted(r["x"] for r in read_published(spark, out, name).collect())


def test_tables_appear_together(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    assert published(spark, out) == {}
    first = Publication(spark, out)
    first.write("a", _numbers(spark, 1))
    first.write("b", _numbers(spark, 2))
    assert published(spark, out) == {}  # nothing is visible before the commit
    with pytest.raises(ValueError):
        first.write("a", _numbers(spark, 3))
    first.commit()
    second = Publication(spark, out)
    second.write("a", _numbers(spark, 10))
    assert _values(spark, out, "a") == [1]
    second.commit()  # the new set has no table b
    assert _values(spark, out, "a") == [10]
    with pytest.raises(FileNotFoundError):
        read_published(spark, out, "b")


def test_reader_of_the_old_set_goes_on_until_it_is_dropped(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    for v in (1, 2, 3):
        p = Publication(spark, out)
        p.write("a", _numbers(spark, v))
        p.commit()
        if v == 1:
            old = read_published(spark, out, "a")
    assert [r["x"] for r in old.collect()] == [1]
    assert len(os.listdir(f"{out}/runs")) == 3
    assert len(drop_old(spark, out, keep=2)) == 1 and len(os.listdir(f"{out}/runs")) == 2
    assert len(drop_old(spark, out)) == 1 and _values(spark, out, "a") == [3] and drop_old(spark, out) == []


def test_two_runs_at_once_get_a_number_each(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    runs = [Publication(spark, out) for _ in range(2)]
    for i, p in enumerate(runs):
        p.write("a", _numbers(spark, i))
    runs[1].commit()
    runs[0].commit()
    assert _values(spark, out, "a") == [0] and sorted(n for n in os.listdir(f"{out}/manifests") if n.endswith(".json")) == ["000000000001.json", "000000000002.json"]


def test_a_run_that_dies_halfway_leaves_the_old_set(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/out"
    old = Publication(spark, out)
    old.write("dx_working", _numbers(spark, 7))
    old.commit()

    def dies(self, name, df, sort_within=None, write=Publication.write):
        if name == "rt_summary":
            raise RuntimeError("executor lost for good")
        return write(self, name, df, sort_within)

    monkeypatch.setattr(Publication, "write", dies)
    plan = derived_plan(spark, SF_SMALL)
    with pytest.raises(RuntimeError):
        CohortPlan(spark, plan.sources, plan.maps, plan.window).run(out)
    assert set(published(spark, out)) == {"dx_working"} and _values(spark, out, "dx_working") == [7]
    assert len(os.listdir(f"{out}/runs")) == 2  # the failed run's tables are there, unseen, until they are dropped
    assert len(drop_old(spark, out)) == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_files_do_not_overlap_and_split_a_hot_patient(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    rows = [(f"p{i % 97:03d}", i) for i in range(3000)] + [("p050", 10_000 + i) for i in range(3000)]
    events = spark.createDataFrame(rows, "ENC_HN string, day long")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        p = Publication(spark, f"{tmp_dir}/out")
        stored = p.write_clustered("events", events, ["ENC_HN", "day"])
        p.commit()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    spans = []
    for f in glob.glob(f"{p.tables['events']}/part-*.parquet"):
        keys = [(r["ENC_HN"], r["day"]) for r in pq.read_table(f).to_pylist()]
        assert keys == sorted(keys)
        if keys:
            spans.append((keys[0], keys[-1]))
    spans.sort()
    assert len(spans) > 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(a[0][0] <= "p050" <= a[1][0] for a in [(s[0], s[1]) for s in spans]) >= 3  # the patient with half of the rows
    assert sum(s[0][0] <= "p007" <= s[1][0] for s in spans) <= 2
    assert sorted(map(tuple, stored.collect())) == sorted(rows)
    assert os.listdir(f"{tmp_dir}/out/runs/{p.run}") == ["events"]


def test_bucketed_summaries_join_without_a_shuffle(spark, tmp_dir):
    from cohortkit.checks.compare import rows_of
    from cohortkit.operators import criteria

    plan = derived_plan(spark, SF_SMALL)
    p = Publication(spark, f"{tmp_dir}/out")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stored = [p.write_bucketed(n, getattr(plan, n), "ENC_HN") for n in ("dx_summary", "med_summary", "rt_summary")]
        base = criteria.exact_criteria_base(*stored)
        assert "SortMergeJoin" in _plan(base) and "Exchange" not in _plan(base)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert rows_of(base.toPandas()) == rows_of(plan.exact_base.toPandas())
    names = list(p.tables)
    p.commit()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"run_{p.run}")]
    assert read_published(spark, f"{tmp_dir}/out", names[0]).count() == plan.dx_summary.count()
