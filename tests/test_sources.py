"""File sources: per-file column resolution, order-year exclusion, CSV text, hidden files."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cohortkit.operators.standardize import resolve_medication_columns
from cohortkit.plans.cohort import CohortPlan
from cohortkit.sources.codemaps import CodeMaps
from cohortkit.sources.files import FileSources, list_files, profile_sources
from tests.conftest import ROOT, SF_SMALL


def _pq(path, cols: dict):
    pq.write_table(pa.table(cols), path)


def required_maps(m):
    with open(f"{m}/dementia_icd10_map.csv", "w") as fh:
        fh.write("code,match_type,subtype\nG30.9,exact,AD\n")
    with open(f"{m}/medication_map.csv", "w") as fh:
        fh.write("drug_code,drug_name_normalized,drug_class,include_in_cohort\nARIP-T-,Donepezil,AChEI,1\n")


def test_resolution_rules_s8_s9():
    assert resolve_medication_columns(["ENC_HN", "REC_DATE", "PROP_HELP", "CODE"]) == ("REC_DATE", "CODE")
    assert resolve_medication_columns(["ENC_HN", "BillDate", "freetext", "Drugcode"]) == ("BillDate", "Drugcode")
    assert resolve_medication_columns(["ENC_HN", "D001KEY", "Comment", "DSPCode", "CODE"]) == ("D001KEY", "DSPCode")
    assert resolve_medication_columns(["ENC_HN", "PerformDate", "BillDate", "D403KEY"]) == ("PerformDate", "D403KEY")
    assert resolve_medication_columns(["REC_DATE", "CODE"]) is None
    assert resolve_medication_columns(["ENC_HN", "CODE"]) is None


def test_medication_files_t8_t9(spark, tmp_dir):
    order, meds = os.path.join(tmp_dir, "order"), os.path.join(tmp_dir, "medication")
    os.makedirs(order), os.makedirs(meds)
    # REC_DATE present (but null) wins over D001KEY -> row dropped
    _pq(f"{order}/order_2022_a.parquet.gzip", {"ENC_HN": ["p1", "p2"], "REC_DATE": [None, "20150101"],
                                               "D001KEY": ["20150101", "20150101"], "PROP_HELP": ["x", "x"],
                                               "CODE": ["ARIP-T-", "ARIP-T-"]})
    _pq(f"{order}/order_2023_a.parquet.gzip", {"ENC_HN": ["p3"], "REC_DATE": ["20150101"],
                                               "PROP_HELP": ["x"], "CODE": ["ARIP-T-"]})
    _pq(f"{meds}/medication_2023_a.parquet.gzip", {"ENC_HN": ["p4"], "BillDate": ["2015-01-01"],
                                                   "freetext": ["x"], "Drugcode": ["EBIX-T-"]})
    _pq(f"{meds}/skip.parquet", {"ENC_HN": ["p5"], "BillDate": ["2015-01-01"], "Drugcode": ["EBIX-T-"]})
    src = FileSources(spark, order_dir=order, medication_dir=meds)
    files = [os.path.basename(p) for p in src.medication_files()]
    assert files == ["order_2022_a.parquet.gzip", "medication_2023_a.parquet.gzip"]
    plan = CohortPlan(spark, src)
    got = sorted((r["ENC_HN"], r["CODE"]) for r in plan.med_standardized.collect())
    assert got == [("p2", "ARIPT"), ("p4", "EBIXT")]


def test_diagnosis_csv_and_parquet_t25_t26(spark, tmp_dir):
    d = os.path.join(tmp_dir, "diagnosis")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as fh:
        fh.write("ENC_HN,D001KEY,D035KEY\n0000123,20150101,F03\n")
    _pq(f"{d}/b.parquet", {"ENC_HN": ["0000456"], "D001KEY": pa.array([20150102], pa.int64()), "D035KEY": ["G30.9"]})
    _pq(f"{d}/c.parquet", {"ENC_HN": ["0000789"], "D001KEY": pa.array([dt.datetime(2015, 1, 3)]), "D035KEY": ["F01.9"]})
    open(f"{d}/_SUCCESS", "w").close()  # an empty commit marker is no data file
    src = FileSources(spark, diagnosis_dir=d)
    plan = CohortPlan(spark, src)
    got = sorted((r["ENC_HN"], r["D001KEY"]) for r in plan.dx_events.collect())
    assert got == [("0000123", dt.datetime(2015, 1, 1)), ("0000456", dt.datetime(2015, 1, 2)),
                   ("0000789", dt.datetime(2015, 1, 3))]


def test_surgery_unpivot_s12(spark, tmp_dir):
    s = os.path.join(tmp_dir, "surgery")
    os.makedirs(s)
    _pq(f"{s}/s.parquet.gzip", {"ENC_HN": ["p1", "p2"], "D001KEY": ["20150101", "20150105"],
                                "OPR_1": ["92.24", None], "OPR_2": [None, "9241"], "OPR_3": ["", ""]})
    plan = CohortPlan(spark, FileSources(spark, procedure_dirs=(s,)))
    got = sorted((r["ENC_HN"], r["PROC_CODE"]) for r in plan.proc_standardized.collect())
    assert got == [("p1", "9224"), ("p2", "9241")]
    rt = {r["ENC_HN"]: (r["rt_first_date"], r["rt_last_date"]) for r in plan.rt_summary.collect()}
    assert rt["p2"] == (dt.datetime(2015, 1, 5), dt.datetime(2015, 1, 5))


def test_profile_s13(spark, tmp_dir):
    s = os.path.join(tmp_dir, "op")
    os.makedirs(s)
    for i in range(5):
        _pq(f"{s}/f{i}.parquet.gzip", {"ENC_HN": ["p"], "D001KEY": ["20150101"], "D036KEY": ["9224"]})
    with open(f"{s}/f9.parquet.gzip", "w") as fh:
        fh.write("not parquet")
    rows = profile_sources(spark, [s], max_files_per_dir=3).collect()
    assert {r["file_count"] for r in rows} == {6}
    assert [r["file_name"] for r in sorted(rows, key=lambda r: r["sample_rank"])] == [
        "f0.parquet.gzip", "f1.parquet.gzip", "f2.parquet.gzip"]
    assert rows[0]["columns"] == "ENC_HN, D001KEY, D036KEY"
    assert list_files(spark, os.path.join(tmp_dir, "missing")) == []


def test_maps_from_dir_s5_s6_t22(spark, tmp_dir):
    m = os.path.join(tmp_dir, "maps")
    os.makedirs(m)
    with open(f"{m}/dementia_icd10_map.csv", "w") as fh:
        fh.write("code,match_type,subtype\nG30.9,exact,AD\nF03,exact,Unspecified\n")
    with open(f"{m}/review_code_map.csv", "w") as fh:
        fh.write("code,match_type,domain,review_group,include_in_cohort,exclude_codes,note\n"
                 "G31,prefix,diagnosis,Deg,0,G318,note\n"
                 "G312,exact,diagnosis,Deg,0,Explicitly reported separately\n")
    with open(f"{m}/medication_map.csv", "w") as fh:
        fh.write("drug_code,drug_name_normalized,drug_class,include_in_cohort\n"
                 "ARIP-T-,Donepezil,AChEI,1\nXXX-T-,Other,AChEI,bad\n")
    maps = CodeMaps.from_dir(spark, m)
    assert maps.dementia == (("G309", "AD"), ("F03", "Unspecified"))
    assert maps.mci == () and maps.clozapine == ()  # S6: missing optional files are empty maps
    assert [r.exclude_codes for r in maps.review] == [("G318",), ()]  # T22
    assert maps.medication == (("ARIPT", "AChEI"),)  # bad include flag -> 0
    assert CodeMaps.default().diagnosis_prefixes == sorted(set(CodeMaps.default().diagnosis_prefixes))


def test_profile_reports_unreadable_footer(spark, tmp_dir):
    s = os.path.join(tmp_dir, "op2")
    os.makedirs(s)
    with open(f"{s}/a_bad.parquet.gzip", "w") as fh:
        fh.write("not parquet")
    _pq(f"{s}/b_ok.parquet.gzip", {"ENC_HN": ["p"], "D001KEY": ["20150101"], "D036KEY": ["9224"]})
    rows = {r["file_name"]: r["columns"] for r in profile_sources(spark, [s]).collect()}
    assert rows["a_bad.parquet.gzip"].startswith("SCHEMA_ERROR: ")
    assert rows["b_ok.parquet.gzip"] == "ENC_HN, D001KEY, D036KEY"


def test_file_lake_pipeline_equals_derived_pipeline(spark, tmp_dir):
    """The derived sources written as a Parquet lake (medication folder holding two layouts)
    and read back through FileSources give the same cohort as the in-memory derivation."""
    from cohortkit.checks.compare import rows_of
    from cohortkit.plans.queries import DERIVED_STUDY_WINDOW, derived_plan
    from cohortkit.sources.files import materialize_derived_lake
    from tests.conftest import SF_SMALL

    lake = materialize_derived_lake(spark, SF_SMALL, root=f"{tmp_dir}/lake")
    src = FileSources(spark, diagnosis_dir=f"{lake}/diagnosis", order_dir=f"{lake}/order",
                      medication_dir=f"{lake}/medication",
                      procedure_dirs=(f"{lake}/operation", f"{lake}/surgery"),
                      demographic_path=f"{lake}/demographic", pattern="*.parquet")
    assert len(src.medication_layouts()) == 3  # order layout + two layouts in one folder
    files = CohortPlan(spark, src, window=DERIVED_STUDY_WINDOW)
    derived = derived_plan(spark, SF_SMALL)
    for name in ("med_standardized", "exact_base", "labelled"):
        assert rows_of(getattr(files, name).toPandas()) == rows_of(getattr(derived, name).toPandas()), name


def test_maps_round_trip_through_csv(spark, tmp_dir):
    """The built-in code lists written as map CSVs (published column layout, review lines
    without exclude codes one field short) load back to the same CodeMaps."""
    import csv

    from cohortkit.sources import codemaps as M

    m = os.path.join(tmp_dir, "maps_rt")
    os.makedirs(m)

    def write(name, header, rows):
        with open(f"{m}/{name}", "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(header)
            w.writerows(rows)

    write("dementia_icd10_map.csv", ["code", "match_type", "subtype", "group_name"],
          [(c, "exact", s, "g") for c, s in M.DEMENTIA_ICD10])
    write("mci_icd10_map.csv", ["code", "match_type", "group_name"], [(c, "exact", "MCI") for c in M.MCI_ICD10])
    write("schizophrenia_icd10_map.csv", ["code", "match_type"], [(c, "prefix") for c in M.SCHIZOPHRENIA_ICD10])
    write("review_code_map.csv",
          ["code", "match_type", "domain", "review_group", "include_in_cohort", "exclude_codes", "note"],
          [(c, mt, "diagnosis", g, "0", x, "note") if x else (c, mt, "diagnosis", g, "0", "a note")
           for c, mt, g, x in M.REVIEW_CODES])
    write("medication_map.csv", ["drug_code", "drug_name_normalized", "drug_class", "include_in_cohort"],
          [(c, "n", k, "1") for c, k in M.MEDICATION])
    write("clozapine_map.csv", ["drug_code", "drug_name_normalized"], [(c, "Clozapine") for c in M.CLOZAPINE])
    write("radiotherapy_icd9_map.csv", ["code", "match_type"], [(c, "exact") for c in M.RADIOTHERAPY_ICD9])
    assert CodeMaps.from_dir(spark, m) == CodeMaps.default()


def test_map_csv_with_byte_order_mark(spark, tmp_dir):
    m = os.path.join(tmp_dir, "maps_bom")
    os.makedirs(m)
    with open(f"{m}/mci_icd10_map.csv", "w", encoding="utf-8-sig") as fh:
        fh.write("code,match_type\nF06.7,exact\nR41,exact\n")
    required_maps(m)
    assert CodeMaps.from_dir(spark, m).mci == ("F067", "R41")


def test_diagnosis_csv_with_byte_order_mark(spark, tmp_dir):
    d = os.path.join(tmp_dir, "dx_bom")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w", encoding="utf-8-sig") as fh:
        fh.write("ENC_HN,D001KEY,D035KEY\n0000123,20150101,F03\n")
    rows = CohortPlan(spark, FileSources(spark, diagnosis_dir=d)).dx_events.collect()
    assert [(r["ENC_HN"], r["code"]) for r in rows] == [("0000123", "F03")]


@pytest.mark.parametrize("kind", ["diagnosis", "order", "medication", "procedure"])
def test_underscore_files_are_named_t26(spark, tmp_dir, kind):
    """Spark's readers skip names that start with ``_``: such a file must not be lost silently."""
    d = os.path.join(tmp_dir, kind)
    os.makedirs(d)
    _pq(f"{d}/_x.parquet.gzip", {"ENC_HN": ["p"], "D001KEY": ["20150101"], "D035KEY": ["F03"]})
    src = FileSources(spark, diagnosis_dir=d, order_dir=d, medication_dir=d, procedure_dirs=(d,))
    with pytest.raises(ValueError, match="_x.parquet.gzip"):
        getattr(src, {"diagnosis": "diagnosis_layouts", "procedure": "procedure_layouts"}.get(kind, "medication_layouts"))()


def test_only_plain_files_of_the_folder(spark, tmp_dir):
    d = os.path.join(tmp_dir, "dx[1]")
    os.makedirs(f"{d}/old=1")
    _pq(f"{d}/d1.parquet", {"ENC_HN": ["p1"], "D001KEY": ["20150101"], "D035KEY": ["F03"]})
    _pq(f"{d}/old=1/d2.parquet", {"ENC_HN": ["p9"], "D001KEY": ["20150101"], "D035KEY": ["F03"]})
    _pq(f"{d}/.hidden.parquet", {"ENC_HN": ["p8"], "D001KEY": ["20150101"], "D035KEY": ["F03"]})
    rows = CohortPlan(spark, FileSources(spark, diagnosis_dir=d)).dx_events.collect()
    assert [r["ENC_HN"] for r in rows] == ["p1"]


@pytest.mark.parametrize("dx_type", ["int64", "float64", "decimal", "string"])
@pytest.mark.parametrize("med_type", ["int32", "float64", "decimal", "string"])
def test_one_patient_across_id_types(spark, tmp_dir, dx_type, med_type):
    from decimal import Decimal

    def ids(kind):
        if kind == "string":
            return pa.array(["1234567", "77"])
        if kind == "decimal":
            return pa.array([Decimal("1234567"), Decimal("77")], pa.decimal128(20, 2))
        return pa.array([1234567, 77], getattr(pa, kind)())

    dx, md = os.path.join(tmp_dir, "dx"), os.path.join(tmp_dir, "md")
    os.makedirs(dx), os.makedirs(md)
    _pq(f"{dx}/a.parquet", {"ENC_HN": ids(dx_type), "D001KEY": ["20150101", "20140101"], "D035KEY": ["F03", "R41"]})
    _pq(f"{md}/m.parquet.gzip", {"ENC_HN": ids(med_type), "BillDate": ["2015-01-01"] * 2, "freetext": ["x"] * 2, "Drugcode": ["ARIP-T-"] * 2})
    base = CohortPlan(spark, FileSources(spark, diagnosis_dir=dx, medication_dir=md)).exact_base.collect()
    assert sorted(r["ENC_HN"] for r in base) == ["1234567", "77"]


def test_large_and_missing_and_broken_ids(spark):
    from cohortkit.operators.standardize import patient_id

    df = spark.createDataFrame([(1234567890.0,), (float("nan"),), (None,)], "ENC_HN double")
    assert [r[0] for r in df.select(patient_id(df)).collect()] == ["1234567890", None, None]
    bad = spark.createDataFrame([(1.5,)], "ENC_HN double")
    with pytest.raises(Exception, match="not a whole number"):
        bad.select(patient_id(bad)).collect()


def test_nanosecond_timestamps(spark, tmp_dir):
    d = os.path.join(tmp_dir, "ns")
    os.makedirs(d)
    ns = pa.array([1420070400000000123, None, 1420156800000000000], pa.timestamp("ns"))
    _pq(f"{d}/a.parquet", {"ENC_HN": pa.array([1, 2, 3], pa.int64()), "D001KEY": ns, "D035KEY": ["F03"] * 3})
    _pq(f"{d}/b.parquet", {"ENC_HN": pa.array([4], pa.int64()), "D001KEY": pa.array([20150103], pa.int64()), "D035KEY": ["F03"]})
    got = sorted((r["ENC_HN"], r["D001KEY"]) for r in CohortPlan(spark, FileSources(spark, diagnosis_dir=d)).dx_events.collect())
    assert got == [("1", dt.datetime(2015, 1, 1)), ("3", dt.datetime(2015, 1, 2)), ("4", dt.datetime(2015, 1, 3))]
    assert {r["columns"] for r in profile_sources(spark, [d]).collect()} == {"ENC_HN, D001KEY, D035KEY"}


def test_nanosecond_birth_date_at_the_epoch(spark, tmp_dir):
    d = os.path.join(tmp_dir, "born")
    os.makedirs(d)
    born = pa.array([0, 999, -1000, 1, None, 86_400_000_000_000], pa.timestamp("ns"))
    _pq(f"{d}/demographic.parquet", {"ENC_HN": pa.array([1, 2, 3, 4, 5, 6], pa.int64()), "D020AT3": born})
    got = {r["ENC_HN"]: r["D020AT3"] for r in FileSources(spark, demographic_path=f"{d}/demographic.parquet").demographic().collect()}
    epoch = dt.datetime(1970, 1, 1)
    assert got == {1: epoch, 2: epoch, 3: epoch - dt.timedelta(microseconds=1), 4: epoch, 5: None, 6: dt.datetime(1970, 1, 2)}


def test_csv_quotes_and_line_breaks(spark, tmp_dir):
    d = os.path.join(tmp_dir, "q")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as fh:
        fh.write('ENC_HN,NOTE,D001KEY,D035KEY\n1,"a\nb",20150101,F03\n2,"said ""x"", y",2015-1-5,G30.9\n')
    src = FileSources(spark, diagnosis_dir=d)
    got = sorted((r["ENC_HN"], r["D001KEY"], r["code"]) for r in CohortPlan(spark, src).dx_events.collect())
    assert got == [("1", dt.datetime(2015, 1, 1), "F03"), ("2", dt.datetime(2015, 1, 5), "G309")]
    assert profile_sources(spark, [d], pattern="*").first()["columns"] == "ENC_HN, NOTE, D001KEY, D035KEY"


def test_event_dates_agree_with_duckdb(spark):
    import duckdb

    from cohortkit.functions.dates import parse_event_ts

    texts = ["2015-1-5", "20150105", "2015-01-05 03:04:05", "2015-1-5 3:4:5", "2015-13-01", "n/a", "", "2015-02-30", "201501", "2015-01-05 25:00:00",
             "2015-12-31 23:59:59", "15-01-05x", "2015/01/05"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["x"] for r in df.select("t", parse_event_ts(df["t"]).alias("x")).collect()}
    for t in texts:
        want = duckdb.execute("SELECT coalesce(try_strptime(?, '%Y%m%d'), try_strptime(?, '%Y-%m-%d'), try_strptime(?, '%Y-%m-%d %H:%M:%S'))", [t] * 3).fetchone()[0]
        assert got[t] == want, t


def test_required_maps_must_exist(spark, tmp_dir):
    from cohortkit.plans.cli import main

    m = os.path.join(tmp_dir, "maps_req")
    os.makedirs(m)
    with pytest.raises(FileNotFoundError, match="dementia_icd10_map"):
        CodeMaps.from_dir(spark, m)
    with pytest.raises(FileNotFoundError):
        main(["--out", f"{tmp_dir}/o", "--derived-from", "/root/testdata/sf0.001", "--map-dir", f"{tmp_dir}/nowhere"])
    required_maps(m)
    assert CodeMaps.from_dir(spark, m).dementia == (("G309", "AD"),)
    with open(f"{m}/medication_map.csv", "w") as fh:
        fh.write("drug_code,drug_class\nARIP-T-,AChEI\n")
    with pytest.raises(ValueError, match="include_in_cohort"):
        CodeMaps.from_dir(spark, m)
    required_maps(m)
    with open(f"{m}/dementia_icd10_map.csv", "w") as fh:
        fh.write("code,match_type,subtype\n,exact,AD\n")
    with pytest.raises(ValueError, match="no diagnosis prefixes"):
        CodeMaps.from_dir(spark, m)


def test_last_row_of_a_drug_code_counts(spark, tmp_dir):
    m = os.path.join(tmp_dir, "maps_dup")
    os.makedirs(m)
    required_maps(m)
    with open(f"{m}/medication_map.csv", "a") as fh:
        fh.write("ARIP-T-,Donepezil,Memantine,1\n")
    assert CodeMaps.from_dir(spark, m).drug_classes() == {"Memantine": ["ARIPT"]}


def test_file_sources_from_another_directory(tmp_dir):
    """Schemas are read by Spark itself, so executors need no copy of the package."""
    import subprocess
    import sys

    d = os.path.join(tmp_dir, "dx_cwd")
    os.makedirs(d)
    _pq(f"{d}/a.parquet", {"ENC_HN": ["p1"], "D001KEY": ["20150101"], "D035KEY": ["F03"]})
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\nfrom cohortkit.session import local_session\n"
            "from cohortkit.plans.cohort import CohortPlan\nfrom cohortkit.sources.files import FileSources\n"
            f"s = local_session(1)\nprint('ROWS', CohortPlan(s, FileSources(s, diagnosis_dir={d!r})).dx_events.count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]


# ---- schema census, footer types, CSV rejects ---------------------------------------------------

def _jobs(spark, action):
    """Number of Spark jobs that ``action`` starts, and its result."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = action()
        return len(tracker.getJobIdsForGroup(group)), out
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_census_takes_the_same_number_of_jobs_for_any_number_of_files(spark, tmp_dir):
    from cohortkit.sources.census import group_by_signature

    shapes = [{"ENC_HN": ["a"], "X": [1]}, {"ENC_HN": ["a"], "X": ["1"]}, {"ENC_HN": ["a"], "Y": [1.5]}]
    counts = []
    for n in (9, 600):
        d = os.path.join(tmp_dir, f"many {n}%")
        os.makedirs(d)
        for i in range(n):
            _pq(f"{d}/f{i:05d}.parquet", shapes[i % 3])
        jobs, groups = _jobs(spark, lambda: group_by_signature(spark, list_files(spark, d)))
        assert sorted(map(len, groups.values())) == [n // 3] * 3
        assert [p for g in groups.values() for p in g][0].endswith("f00000.parquet")
        counts.append(jobs)
    assert counts[0] == counts[1] <= 4


def test_census_through_hadoop_agrees(spark, tmp_dir):
    """Files that only Hadoop's file systems reach: same kinds, names and groups."""
    from cohortkit.sources import census

    now = dt.datetime(2015, 1, 2)
    _pq(f"{tmp_dir}/a.parquet", {"ENC_HN": ["a"], "D001KEY": pa.array([now], pa.timestamp("us"))})
    pq.write_table(pa.table({"ENC_HN": ["a"], "D001KEY": pa.array([now], pa.timestamp("ns"))}), f"{tmp_dir}/b.parquet", version="2.6")
    with open(f"{tmp_dir}/c.csv", "w") as fh:
        fh.write("﻿ENC_HN,D001KEY\n1,2\n")
    paths = list_files(spark, tmp_dir)
    near = census.signatures(spark, paths)
    far = {p: census._through_hadoop(spark, p) for p in paths}
    for p in paths:
        assert near[p][0] == far[p][0] and [n for n, _ in near[p][1]] == [n for n, _ in far[p][1]]
    assert [near[p][0] for p in paths] == ["parquet", "nanos", "csv"]
    assert dict(near[paths[1]][1])["D001KEY"] == dict(far[paths[1]][1])["D001KEY"] == census.NANOS


def test_nanoseconds_by_type_not_by_value(spark, tmp_dir):
    """A nanosecond column beside an int64 yyyyMMdd column: small instants stay instants, wrong dates become null."""
    d = os.path.join(tmp_dir, "med")
    os.makedirs(d)
    pq.write_table(pa.table({
        "ENC_HN": ["a", "b", "c"], "PerformDate": pa.array([20_150_101, 0, None], pa.timestamp("ns")),
        "BillDate": pa.array([20_150_101, 99_999_999, 5], pa.int64()), "D403KEY": ["ARIP-T-"] * 3}), f"{d}/m.parquet", version="2.6")
    frame = FileSources(spark, medication_dir=d, pattern="*.parquet").medication_layouts()["medication_0"]
    got = {r["ENC_HN"]: (r["PerformDate"], r["BillDate"]) for r in frame.collect()}
    epoch = dt.datetime(1970, 1, 1)
    assert got == {"a": (epoch + dt.timedelta(microseconds=20_150), 20_150_101), "b": (epoch, 99_999_999), "c": (None, 5)}


def test_unreadable_file_is_named(spark, tmp_dir):
    with open(f"{tmp_dir}/broken.parquet", "wb") as fh:
        fh.write(b"not parquet")
    with pytest.raises(ValueError, match="broken.parquet"):
        FileSources(spark, diagnosis_dir=tmp_dir).diagnosis_layouts()


def test_plain_csv_is_split_and_rejects_are_listed(spark, tmp_dir):
    from cohortkit.sources.files import csv_rejects

    d = os.path.join(tmp_dir, "dx csv")
    os.makedirs(d)
    head = "ENC_HN,D001KEY,D035KEY\n"
    with open(f"{d}/plain.csv", "w") as fh:
        fh.write(head + "".join(f"p{i},20150101,F03\n" for i in range(60_000)) + "short,20150101\nlong,20150101,F03,x\n\n")
    with open(f"{d}/breaks.csv", "w") as fh:
        fh.write(head + 'q1,20150101,"F03\nG30.9"\nq2,20150101\n')
    with open(f"{d}/open.csv", "w") as fh:
        fh.write(head + 'r1,20150101,F03\nr2,20150101,"F03\n')
    paths = list_files(spark, d)
    bad = {(r["file_name"], r["first_field"], r["reason"]) for r in csv_rejects(spark, paths).collect()}
    assert bad >= {("plain.csv", "short", "fewer fields"), ("plain.csv", "long", "more fields"), ("breaks.csv", "q2", "fewer fields")}
    assert not {b for b in bad if b[1] in ("q1", "r1") or (b[1] or "").startswith("p")}
    layouts = FileSources(spark, diagnosis_dir=d).diagnosis_layouts()
    rows = {r["ENC_HN"]: r["D035KEY"] for f in layouts.values() for r in f.filter("ENC_HN NOT LIKE 'p%'").collect()}
    assert rows["q1"] == "F03\nG30.9" and rows["short"] is None and rows["long"] == "F03" and rows["r1"] == "F03"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert max(f.rdd.getNumPartitions() for f in FileSources(spark, diagnosis_dir=d).diagnosis_layouts().values()) > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_demographic_folder_of_several_types(spark, tmp_dir):
    from cohortkit.operators import index

    d = os.path.join(tmp_dir, "demo")
    os.makedirs(d)
    _pq(f"{d}/a.parquet", {"ENC_HN": [12345678, 12345679], "D020AT3": [19500101.0, None]})
    _pq(f"{d}/b.parquet", {"ENC_HN": ["x"], "D020AT3": ["19600202"]})
    got = {r["ENC_HN"]: str(r[1])[:10] for r in index.birth_dates(FileSources(spark, demographic_path=d).demographic()).collect()}
    assert got == {"12345678": "1950-01-01", "12345679": "None", "x": "1960-02-02"}


def test_ids_of_eight_digits_stay_apart(spark, tmp_dir):
    """Customers beyond 9,999,999 keep their own ids in the derived sources and in the files."""
    from cohortkit.functions.codes import padded_id
    from cohortkit.sources.derived import DerivedSources

    keys = [1, 1_000_000, 9_999_999, 10_000_000, 10_000_001, 123_456_789_012]
    _pq(f"{tmp_dir}/customer.parquet", {"c_custkey": keys})
    ids = {r["ENC_HN"] for r in DerivedSources(spark, tmp_dir).demographic().collect()}
    assert ids == {f"{k:07d}" for k in keys if k % 50 != 2 or k % 50 in (0, 1)}
    frame = spark.createDataFrame([(k,) for k in keys], "k long").select(padded_id("k").alias("id"))
    assert [r["id"] for r in frame.collect()] == [f"{k:07d}" for k in keys]


@pytest.mark.parametrize("name", [
    "file_dx_summary",
    "refresh_exact_base",
    "stored_exact_base",
    "crosswalk_exact_base",
])
def test_lines_are_joined_once_for_all_jobs(spark, monkeypatch, name):
    from cohortkit.plans import queries
    from cohortkit.sources import derived

    seen = spark.sparkContext.accumulator(0)

    def counted(self, lines=derived.DerivedSources._lines):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        df = lines(self)
        return df.mapInArrow(run, df.schema)

    monkeypatch.setattr(derived.DerivedSources, "_lines", counted)
    folder = f"{SF_SMALL}/./{name}/.."  # a path of its own: definitions are kept for each
    monkeypatch.setattr(derived.DerivedSources, "_table", lambda self, t: self.spark.read.parquet(f"{SF_SMALL}/{t}.parquet"))
    monkeypatch.setattr("cohortkit.sources.files._stamp", lambda spark, sf_dir: folder)
    assert queries.QUERIES[name](spark, folder).count()
    assert seen.value == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
