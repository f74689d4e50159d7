"""DuckDB oracle SQL for every registered query that SQL can express.

Each statement is ``WITH <derived sources and stages> SELECT ...`` over the driver's views
(``lineitem``, ``orders``, ``customer``). The SQL is an independent formulation: prefix
tests are ``EXISTS (.. starts_with ..)`` against ``VALUES`` maps, dates use ``try_strptime``,
aggregates use ``FILTER``; only the fixed code lists are shared with the Spark side.
"""

from __future__ import annotations

from cohortkit.operators.criteria import EXACT_COUNTERS
from cohortkit.operators.reports import EXCLUSION_STEPS, FLOW_STEPS, TRANSITION_KEY, review_rows
from cohortkit.sources import derived as D
from cohortkit.sources.codemaps import (
    DISTRIBUTION_ORDER, SUBTYPE_DISPLAY, TRANSITION_ORDER, UNSPECIFIED_DATE_PREFIX, CodeMaps,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        return _q(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def _range_case(key: str, table, default: str) -> str:
    parts = [f"WHEN {key} BETWEEN {lo} AND {hi} THEN {_q(code)}" for lo, hi, code in table]
    return f"CASE {' '.join(parts)} ELSE {_q(default)} END"


def _text(ts: str) -> str:
    return (f"CASE ln % 3 WHEN 0 THEN strftime({ts}, '%Y%m%d') WHEN 1 THEN strftime({ts}, '%Y-%m-%d') "
            f"ELSE strftime({ts}, '%Y-%m-%d %H:%M:%S') END")


def _parse(s: str) -> str:
    return (f"coalesce(try_strptime({s}, '%Y%m%d'), try_strptime({s}, '%Y-%m-%d'), "
            f"try_strptime({s}, '%Y-%m-%d %H:%M:%S'))")


def _norm(s: str) -> str:
    return f"regexp_replace(upper(CAST({s} AS VARCHAR)), '[^A-Z0-9]', '', 'g')"


def _ctes(maps: CodeMaps) -> str:
    start, end = (d.strftime("%Y-%m-%d %H:%M:%S") for d in D.DERIVED_WINDOW)
    win = lambda c: f"{c} BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"
    groups = maps.diagnosis_groups()
    dxmap_rows = [(g, p) for g, ps in groups.items() for p in ps]
    med_rows = list(maps.medication)
    relevant = ", ".join(_q(c) for c in maps.relevant_drug_codes)
    cloz = ", ".join(_q(c) for c in maps.clozapine)
    billing = list(maps.billing)
    flag_cols = ",\n    ".join(
        f"EXISTS (SELECT 1 FROM dxmap m WHERE m.grp = {_q(g)} AND starts_with(e.code, m.prefix)) AS {g}"
        for g in groups)
    return f"""
lines AS (
  SELECT printf('%07d', o.o_custkey) AS hn, o.o_orderdate AS od, l.l_shipdate AS sd,
         l.l_linenumber AS ln,
         (l.l_partkey*31 + l.l_suppkey*7 + l.l_linenumber*101 + o.o_orderkey*3) % 1000 AS kd,
         (l.l_partkey*17 + l.l_suppkey*13 + l.l_linenumber*211 + o.o_orderkey*5) % 1000 AS km,
         (l.l_partkey*11 + l.l_suppkey*29 + l.l_linenumber*307 + o.o_orderkey*7) % 1000 AS kp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
dx_src AS (
  SELECT CASE WHEN kd <> 999 THEN hn END AS ENC_HN,
         CASE WHEN kd = 4 AND ln = 7 THEN 'n/a' WHEN kd = 998 THEN concat_ws('-', year(od), month(od), day(od)) ELSE {_text('od')} END AS D001KEY,
         {_range_case('kd', D.DX_CODE_BY_KD, D.DX_CODE_DEFAULT)} AS D035KEY
  FROM lines),
dxmap AS (SELECT * FROM {_values(dxmap_rows, ['grp', 'prefix'])}),
dx_prefix AS (SELECT * FROM {_values([(p,) for p in maps.diagnosis_prefixes], ['prefix'])}),
dx_std AS (SELECT ENC_HN, {_parse('D001KEY')} AS D001KEY, {_norm('D035KEY')} AS code FROM dx_src),
dx_ev AS (
  SELECT e.ENC_HN, e.D001KEY, e.code FROM dx_std e
  WHERE e.ENC_HN IS NOT NULL AND e.D001KEY IS NOT NULL AND e.code IS NOT NULL
    AND EXISTS (SELECT 1 FROM dx_prefix p WHERE starts_with(e.code, p.prefix))
    AND {win('e.D001KEY')}),
dx_flag AS (
  SELECT e.*,
    {flag_cols},
    starts_with(e.code, {_q(UNSPECIFIED_DATE_PREFIX)}) AS is_f03
  FROM dx_ev e),
dx_working AS (
  SELECT ENC_HN, D001KEY, array_to_string(list_sort(list_distinct(list(code))), ', ') AS D035KEY,
    {', '.join(f'bool_or({g}) AS {g}' for g in groups)}
  FROM dx_flag GROUP BY ENC_HN, D001KEY),
dx_summary AS (
  SELECT ENC_HN,
    min(D001KEY) FILTER (WHERE is_dementia) AS diagnosis_date,
    min(D001KEY) FILTER (WHERE is_ad) AS ad_date,
    min(D001KEY) FILTER (WHERE is_vad) AS vad_date,
    min(D001KEY) FILTER (WHERE is_other) AS other_date,
    min(D001KEY) FILTER (WHERE is_f03) AS unspecified_date,
    min(D001KEY) FILTER (WHERE is_mci) AS mci_date,
    min(D001KEY) FILTER (WHERE is_schizophrenia) AS schizophrenia_date,
    bool_or(is_mci) AS has_mci_history, bool_or(is_schizophrenia) AS has_schizophrenia_history
  FROM dx_flag GROUP BY ENC_HN),
med_raw AS (
  SELECT CASE WHEN km <> 999 THEN hn END AS ENC_HN, {_text('sd')} AS date_text, {_range_case('km', D.MED_CODE_BY_KM, D.MED_CODE_DEFAULT)} AS raw_code,
         CASE ln % 3 WHEN 0 THEN 'order_a' WHEN 1 THEN 'medication_b' ELSE 'medication_c' END AS layout
  FROM lines
  UNION ALL
  SELECT hn, strftime(od, '%Y%m%d'), {_q(D.CO_PRESCRIPTION_CODE)}, 'order_a' FROM lines WHERE kd = 0),
med_std AS (
  SELECT ENC_HN, {_parse('date_text')} AS REC_DATE, {_norm('raw_code')} AS CODE FROM med_raw
  WHERE ENC_HN IS NOT NULL AND {_parse('date_text')} IS NOT NULL AND raw_code IS NOT NULL),
medmap AS (SELECT * FROM {_values(med_rows, ['code', 'drug_class'])}),
med_working AS (
  SELECT s.ENC_HN, s.REC_DATE, s.CODE, m.drug_class, m.drug_class IS NOT NULL AS is_dementia_med,
         s.CODE IN ({cloz}) AS is_clozapine
  FROM med_std s LEFT JOIN medmap m ON m.code = s.CODE
  WHERE {win('s.REC_DATE')} AND s.CODE IN ({relevant})),
med_summary AS (
  SELECT ENC_HN,
    min(REC_DATE) FILTER (WHERE is_dementia_med) AS medication_date,
    min(REC_DATE) FILTER (WHERE drug_class = 'AChEI') AS achei_date,
    min(REC_DATE) FILTER (WHERE drug_class = 'Memantine') AS memantine_date,
    min(REC_DATE) FILTER (WHERE is_clozapine) AS clozapine_date,
    bool_or(is_clozapine) AS has_clozapine_history
  FROM med_working GROUP BY ENC_HN),
proc_code AS (
  SELECT CASE WHEN kp <> 999 THEN hn END AS ENC_HN, {_text('sd')} AS D001KEY, {_range_case('kp', D.PROC_CODE_BY_KP, D.PROC_CODE_DEFAULT)} AS code,
         ln, kp FROM lines),
operation AS (SELECT ENC_HN, D001KEY, code AS D036KEY FROM proc_code WHERE ln % 2 = 1),
surgery AS (
  SELECT ENC_HN, D001KEY, CASE WHEN kp % 2 = 0 THEN code END AS OPR_1, CASE WHEN kp % 2 = 1 THEN code END AS OPR_2
  FROM proc_code WHERE ln % 2 = 0),
surgery_long AS (UNPIVOT surgery ON OPR_1, OPR_2 INTO NAME OPR_COL VALUE RAW_CODE),
proc_std AS (
  SELECT ENC_HN, {_parse('D001KEY')} AS PROC_DATE, {_norm('D036KEY')} AS PROC_CODE FROM operation
  WHERE ENC_HN IS NOT NULL AND {_parse('D001KEY')} IS NOT NULL AND D036KEY IS NOT NULL
  UNION ALL
  SELECT ENC_HN, {_parse('D001KEY')}, {_norm('RAW_CODE')} FROM surgery_long
  WHERE ENC_HN IS NOT NULL AND {_parse('D001KEY')} IS NOT NULL AND RAW_CODE IS NOT NULL AND {_norm('RAW_CODE')} <> ''),
rtmap AS (SELECT * FROM {_values([(c,) for c in maps.radiotherapy], ['code'])}),
rt_working AS (
  SELECT p.* FROM proc_std p
  WHERE {win('p.PROC_DATE')} AND EXISTS (SELECT 1 FROM rtmap r WHERE starts_with(p.PROC_CODE, r.code))),
rt_summary AS (
  SELECT ENC_HN, min(PROC_DATE) AS rt_first_date, max(PROC_DATE) AS rt_last_date FROM rt_working GROUP BY ENC_HN),
billmap AS (SELECT * FROM {_values(billing, ['code', 'brain'])}),
merged AS (
  SELECT coalesce(d.ENC_HN, m.ENC_HN) AS ENC_HN,
    d.diagnosis_date, d.ad_date, d.vad_date, d.other_date, d.unspecified_date, d.mci_date, d.schizophrenia_date,
    coalesce(d.has_mci_history, false) AS has_mci_history,
    coalesce(d.has_schizophrenia_history, false) AS has_schizophrenia_history,
    m.medication_date AS raw_medication_date, m.achei_date, m.memantine_date, m.clozapine_date,
    coalesce(m.has_clozapine_history, false) AS has_clozapine_history
  FROM dx_summary d FULL OUTER JOIN med_summary m ON d.ENC_HN = m.ENC_HN),
flags1 AS (
  SELECT mg.*, r.rt_first_date, r.rt_last_date,
    mg.diagnosis_date IS NOT NULL AS is_dx_confirmed,
    mg.raw_medication_date IS NOT NULL AS is_med_candidate,
    mg.raw_medication_date IS NOT NULL AND mg.achei_date IS NOT NULL AS is_achei_candidate,
    mg.raw_medication_date IS NOT NULL AND mg.memantine_date IS NOT NULL AS is_memantine_candidate
  FROM merged mg LEFT JOIN rt_summary r ON mg.ENC_HN = r.ENC_HN),
flags2 AS (
  SELECT *,
    is_achei_candidate AND has_mci_history AS exclude_mci_achei,
    is_memantine_candidate AND (has_schizophrenia_history OR has_clozapine_history) AS exclude_schizophrenia_memantine
  FROM flags1),
flags3 AS (
  SELECT *,
    is_achei_candidate AND NOT exclude_mci_achei AS achei_left,
    is_memantine_candidate AND NOT exclude_schizophrenia_memantine AS memantine_after_schizo
  FROM flags2),
flags4 AS (
  SELECT *,
    memantine_after_schizo AND coalesce(rt_first_date IS NOT NULL AND rt_last_date IS NOT NULL
      AND memantine_date >= rt_first_date AND memantine_date <= rt_last_date, false) AS exclude_radiotherapy_memantine
  FROM flags3),
flags5 AS (
  SELECT *, memantine_after_schizo AND NOT exclude_radiotherapy_memantine AS memantine_left FROM flags4),
flags6 AS (
  SELECT *,
    exclude_mci_achei OR exclude_schizophrenia_memantine OR exclude_radiotherapy_memantine AS excluded_med,
    achei_left OR memantine_left AS is_med_qualifying,
    CASE WHEN achei_left THEN achei_date END AS qualified_achei_date,
    CASE WHEN memantine_left THEN memantine_date END AS qualified_memantine_date
  FROM flags5),
exact_base AS (
  SELECT ENC_HN, diagnosis_date, ad_date, vad_date, other_date, unspecified_date, mci_date, schizophrenia_date,
    has_mci_history, has_schizophrenia_history,
    least(qualified_achei_date, qualified_memantine_date) AS medication_date,
    achei_date, memantine_date, clozapine_date, has_clozapine_history, rt_first_date, rt_last_date,
    is_dx_confirmed, is_med_candidate, is_achei_candidate, exclude_mci_achei, achei_left, is_memantine_candidate,
    exclude_schizophrenia_memantine, memantine_after_schizo, exclude_radiotherapy_memantine, memantine_left,
    excluded_med, is_med_qualifying, qualified_achei_date, qualified_memantine_date,
    least(qualified_achei_date, qualified_memantine_date) AS qualified_medication_date,
    is_med_qualifying AND NOT is_dx_confirmed AS is_inferred_unspecified,
    is_dx_confirmed OR is_med_qualifying AS is_final_cohort
  FROM flags6),
final_cohort AS (SELECT * FROM exact_base WHERE is_final_cohort),
demo AS (
  SELECT printf('%07d', c_custkey) AS ENC_HN,
    CAST(strftime(DATE '{D.BIRTH_BASE.isoformat()}' + CAST((c_custkey * {D.BIRTH_MULTIPLIER}) % {D.BIRTH_SPAN_DAYS} AS INTEGER), '%Y%m%d') AS DOUBLE) AS D020AT3
  FROM customer WHERE c_custkey % 50 <> 2
  UNION ALL
  SELECT printf('%07d', c_custkey), CAST(NULL AS DOUBLE) FROM customer WHERE c_custkey % 50 = 0
  UNION ALL
  SELECT printf('%07d', c_custkey),
    CAST(strftime(DATE '{D.BIRTH_BASE.isoformat()}' + CAST((c_custkey * {D.BIRTH_MULTIPLIER}) % {D.BIRTH_SPAN_DAYS} + 365 AS INTEGER), '%Y%m%d') AS DOUBLE)
  FROM customer WHERE c_custkey % 50 = 1),
demo_parsed AS (
  SELECT ENC_HN, try_strptime(replace(CAST(CAST(D020AT3 AS BIGINT) AS VARCHAR), '.0', ''), '%Y%m%d') AS dob
  FROM demo WHERE ENC_HN IN (SELECT ENC_HN FROM final_cohort)),
demographics AS (
  SELECT ENC_HN, CASE WHEN count(*) FILTER (WHERE dob IS NULL) > 0 THEN NULL ELSE max(dob) END AS D020AT3
  FROM demo_parsed GROUP BY ENC_HN),
indexed AS (
  SELECT f.ENC_HN, least(f.diagnosis_date, f.medication_date) AS "Index Date", f.diagnosis_date AS "Diagnosis Date",
    f.medication_date AS "Medication Date", f.ad_date AS "AD Date", f.vad_date AS "VaD Date",
    f.other_date AS "Other Date", f.unspecified_date AS "Unspecified Date", g.D020AT3,
    date_diff('day', CAST(g.D020AT3 AS DATE), CAST(least(f.diagnosis_date, f.medication_date) AS DATE)) / 365.0::DOUBLE AS age_at_index
  FROM final_cohort f LEFT JOIN demographics g ON f.ENC_HN = g.ENC_HN),
dementia_index AS (SELECT * FROM indexed WHERE age_at_index >= 18),
lab0 AS (
  SELECT *,
    CAST(coalesce("AD Date" <= "Index Date", false) AS INTEGER) AS a_i,
    CAST(coalesce("VaD Date" <= "Index Date", false) AS INTEGER) AS v_i,
    CAST(coalesce("Other Date" <= "Index Date", false) AS INTEGER) AS o_i,
    CAST("AD Date" IS NOT NULL AS INTEGER) AS a_f, CAST("VaD Date" IS NOT NULL AS INTEGER) AS v_f,
    CAST("Other Date" IS NOT NULL AS INTEGER) AS o_f
  FROM dementia_index),
labelled AS (
  SELECT ENC_HN, "Index Date", "Diagnosis Date", "Medication Date", "AD Date", "VaD Date", "Other Date",
    "Unspecified Date", D020AT3, age_at_index,
    CASE WHEN a_i + v_i + o_i >= 2 THEN 'Mixed' WHEN a_i = 1 THEN 'AD' WHEN v_i = 1 THEN 'VaD'
         WHEN o_i = 1 THEN 'Other' ELSE 'Unspecified' END AS "Initial Label",
    CASE WHEN a_f + v_f + o_f >= 2 THEN 'Mixed' WHEN a_f = 1 THEN 'AD' WHEN v_f = 1 THEN 'VaD'
         WHEN o_f = 1 THEN 'Other' ELSE 'Unspecified' END AS "Final Label"
  FROM lab0)
"""


def _with(maps: CodeMaps, body: str) -> str:
    return "WITH " + _ctes(maps).strip() + "\n" + body


def _pct(n: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN {n} / {total} * 100.0::DOUBLE ELSE 0.0::DOUBLE END"


def oracle_sql() -> dict[str, str]:
    maps = CodeMaps.default()
    w = lambda body: _with(maps, body)
    out: dict[str, str] = {}

    out["normalize_codes"] = w(f"""
, raw AS (
  SELECT 'diagnosis' AS source, D035KEY AS raw_code FROM dx_src
  UNION ALL SELECT 'medication', raw_code FROM med_raw)
SELECT source, raw_code, {_norm('raw_code')} AS code, count(*) AS n_rows FROM raw GROUP BY source, raw_code""")

    out["parse_dates"] = w(f"""
, raw AS (
  SELECT 'diagnosis' AS source, D001KEY AS raw_date FROM dx_src
  UNION ALL SELECT 'medication', date_text FROM med_raw
  UNION ALL SELECT 'procedure', D001KEY FROM proc_code)
SELECT source, raw_date, {_parse('raw_date')} AS event_ts, count(*) AS n_rows FROM raw GROUP BY source, raw_date""")

    map_rows = sorted({(c, "dementia") for c in maps.dementia_codes} | {(c, "mci") for c in maps.mci}
                      | {(c, "schizophrenia") for c in maps.schizophrenia} | {(r.code, "review") for r in maps.review})
    out["prefix_match"] = w(f"""
, codes AS (SELECT DISTINCT code FROM dx_std),
mp AS (SELECT * FROM {_values(map_rows, ['prefix', 'map_name'])})
SELECT DISTINCT c.code, mp.prefix, mp.map_name FROM codes c JOIN mp ON starts_with(c.code, mp.prefix)""")

    out["dx_events_filtered"] = w("SELECT ENC_HN, D001KEY, code FROM dx_ev")
    out["dx_working"] = w("SELECT * FROM dx_working")
    out["dx_summary"] = w("SELECT * FROM dx_summary")
    out["med_standardized"] = w("SELECT * FROM med_std")
    out["med_working"] = w("SELECT * FROM med_working")
    out["med_summary"] = w("SELECT * FROM med_summary")
    out["proc_standardized"] = w("SELECT * FROM proc_std")
    out["rt_working"] = w("SELECT * FROM rt_working")
    out["rt_summary"] = w("SELECT * FROM rt_summary")

    out["stage_counts"] = w("""
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'dx_working_rows' AS metric, count(*) AS value FROM dx_working
  UNION ALL SELECT 'dx_working_patients', count(DISTINCT ENC_HN) FROM dx_working
  UNION ALL SELECT 'dx_summary_patients', count(*) FROM dx_summary
  UNION ALL SELECT 'icd10_dementia_patients', count(*) FILTER (WHERE diagnosis_date IS NOT NULL) FROM dx_summary
  UNION ALL SELECT 'med_working_rows', count(*) FROM med_working
  UNION ALL SELECT 'med_working_patients', count(DISTINCT ENC_HN) FROM med_working
  UNION ALL SELECT 'med_summary_patients', count(*) FROM med_summary
  UNION ALL SELECT 'medication_dementia_patients', count(*) FILTER (WHERE medication_date IS NOT NULL) FROM med_summary
  UNION ALL SELECT 'rt_working_rows', count(*) FROM rt_working
  UNION ALL SELECT 'rt_working_patients', count(DISTINCT ENC_HN) FROM rt_working
  UNION ALL SELECT 'rt_summary_patients', count(*) FROM rt_summary)""")

    out["exact_criteria_base"] = w("SELECT * FROM exact_base")
    out["refresh_exact_base"] = out["exact_criteria_base"]
    out["exact_criteria_base_joined"] = out["exact_criteria_base"]
    out["file_exact_base"] = out["exact_criteria_base"]
    for name in ("dx_summary", "med_working", "rt_summary"):
        out[f"file_{name}"] = out[name]
    # records that the lake writes with a field missing: the rows of the default code whose id is a multiple of ten
    out["file_csv_rejects"] = w(f"""SELECT 'fewer fields' AS reason, count(*) AS n_rows,
      count(DISTINCT CAST(CAST(ENC_HN AS BIGINT) AS VARCHAR) || ',' || D001KEY) AS n_records
    FROM dx_src WHERE D035KEY = '{D.DX_CODE_DEFAULT}' AND CAST(ENC_HN AS BIGINT) % 10 = 0""")
    # the folders' own column names
    out["source_profile"] = """SELECT * FROM (VALUES
  ('operation', true, 'ENC_HN, D001KEY, D036KEY'), ('surgery', true, 'ENC_HN, D001KEY, OPR_1, OPR_2'),
  ('order', true, 'ENC_HN, REC_DATE, PROP_HELP, CODE'), ('none', false, NULL)) AS t(folder, has_files, columns)"""
    out["exact_med_evaluated"] = w("SELECT * FROM exact_base WHERE is_med_candidate")
    out["inferred_unspecified"] = w("SELECT * FROM exact_base WHERE is_inferred_unspecified")
    out["final_cohort"] = w("SELECT * FROM final_cohort")

    counter_sql = {
        "medication_patients_evaluated": "is_med_candidate",
        "achei_patients": "is_achei_candidate",
        "memantine_patients": "is_memantine_candidate",
        "achei_excluded_mci": "exclude_mci_achei",
        "achei_left": "achei_left",
        "memantine_excluded_schizo": "exclude_schizophrenia_memantine",
        "memantine_after_schizo": "memantine_after_schizo",
        "memantine_excluded_radio": "exclude_radiotherapy_memantine",
        "memantine_left": "memantine_left",
        "medication_qualifying_patients": "is_med_qualifying",
        "medication_excluded_patients": "is_med_candidate AND NOT is_med_qualifying",
        "inferred_unspecified_patients": "is_inferred_unspecified",
    }
    out["exact_criteria_counts"] = w("SELECT metric, CAST(value AS BIGINT) AS value FROM (" + " UNION ALL ".join(
        f"SELECT {_q(m)} AS metric, count(*) FILTER (WHERE {counter_sql[m]}) AS value FROM exact_base"
        for m in EXACT_COUNTERS) + ")")
    out["exclusion_steps"] = w("SELECT step_order, Step, CAST(Patients AS BIGINT) AS Patients FROM (" + " UNION ALL ".join(
        f"SELECT {i + 1} AS step_order, {_q(step)} AS Step, count(*) FILTER (WHERE {counter_sql[m]}) AS Patients FROM exact_base"
        for i, (step, m) in enumerate(EXCLUSION_STEPS)) + ")")

    def flow(dx_cond: str, med_cond: str) -> str:
        vals = [
            "count(*) FILTER (WHERE is_dx_confirmed)",
            "count(*) FILTER (WHERE is_med_candidate)",
            "count(*) FILTER (WHERE is_dx_confirmed AND NOT is_med_candidate)",
            "count(*) FILTER (WHERE NOT is_dx_confirmed AND is_med_candidate)",
            "count(*) FILTER (WHERE is_dx_confirmed AND is_med_candidate)",
            "count(*) FILTER (WHERE is_dx_confirmed) + count(*) FILTER (WHERE is_med_candidate)"
            " - count(*) FILTER (WHERE is_dx_confirmed AND is_med_candidate)",
            f"count(*) FILTER (WHERE is_final_cohort AND ({dx_cond}))",
            f"count(*) FILTER (WHERE is_final_cohort AND ({med_cond}))",
            f"count(*) FILTER (WHERE is_final_cohort AND ({dx_cond}) AND NOT ({med_cond}))",
            f"count(*) FILTER (WHERE is_final_cohort AND NOT ({dx_cond}) AND ({med_cond}))",
            f"count(*) FILTER (WHERE is_final_cohort AND ({dx_cond}) AND ({med_cond}))",
            "count(*) FILTER (WHERE is_final_cohort)",
        ]
        return w("SELECT step_order, Step, CAST(Patients AS BIGINT) AS Patients FROM (" + " UNION ALL ".join(
            f"SELECT {i + 1} AS step_order, {_q(s)} AS Step, {v} AS Patients FROM exact_base"
            for i, (s, v) in enumerate(zip(FLOW_STEPS, vals))) + ")")

    out["flow_by_availability"] = flow("diagnosis_date IS NOT NULL", "qualified_medication_date IS NOT NULL")
    dx_at = ("diagnosis_date IS NOT NULL AND (qualified_medication_date IS NULL OR "
             "diagnosis_date <= qualified_medication_date)")
    med_at = ("qualified_medication_date IS NOT NULL AND (diagnosis_date IS NULL OR "
              "qualified_medication_date <= diagnosis_date)")
    out["flow_by_index"] = flow(dx_at, med_at)

    out["demographics_dedup"] = w("SELECT * FROM demographics")
    out["dementia_index"] = w("SELECT * FROM dementia_index")
    out["age_exceptions"] = w("SELECT * FROM indexed WHERE age_at_index < 18")
    out["age_exception_stats"] = w("""
, young AS (SELECT CAST(date_diff('day', CAST(D020AT3 AS DATE), CAST("Index Date" AS DATE)) AS BIGINT) AS d
            FROM indexed WHERE age_at_index < 18),
a AS (SELECT count(d) AS n, sum(CAST(d AS HUGEINT)) AS s1, sum(CAST(d AS HUGEINT) * d) AS s2, min(d) AS dmin,
             max(d) AS dmax, quantile_cont(d, 0.25) AS q1, quantile_cont(d, 0.5) AS q2, quantile_cont(d, 0.75) AS q3
      FROM young)
SELECT n AS count, CAST(s1 AS DOUBLE) / n / 365.0::DOUBLE AS mean,
  CASE WHEN n > 1 THEN sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / 365.0::DOUBLE END AS std,
  dmin / 365.0::DOUBLE AS min, q1 / 365.0::DOUBLE AS p25, q2 / 365.0::DOUBLE AS p50, q3 / 365.0::DOUBLE AS p75,
  dmax / 365.0::DOUBLE AS max
FROM a""")
    out["age_filter_counts"] = w("""
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'n_final_cohort' AS metric, count(*) AS value FROM indexed
  UNION ALL SELECT 'n_adult', count(*) FILTER (WHERE age_at_index >= 18) FROM indexed
  UNION ALL SELECT 'n_under_18', count(*) FILTER (WHERE age_at_index < 18) FROM indexed
  UNION ALL SELECT 'n_unknown_age', count(*) FILTER (WHERE age_at_index IS NULL) FROM indexed
  UNION ALL SELECT 'n_flagged_not_adult', count(*) FILTER (WHERE age_at_index < 18 OR age_at_index IS NULL)
    FROM indexed)""")
    out["null_id_counts"] = w("""
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'diagnosis_null_id_rows' AS metric, count(*) FILTER (WHERE ENC_HN IS NULL) AS value FROM dx_src
  UNION ALL SELECT 'medication_null_id_rows', count(*) FILTER (WHERE ENC_HN IS NULL) FROM med_raw
  UNION ALL SELECT 'procedure_null_id_rows', count(*) FILTER (WHERE ENC_HN IS NULL) FROM proc_code)""")
    out["dementia_index_labelled"] = w("SELECT * FROM labelled")
    out["label_with_arm"] = w("""
, arms AS (
  SELECT *,
    "Diagnosis Date" IS NOT NULL AND ("Medication Date" IS NULL OR "Diagnosis Date" <= "Medication Date") AS dx_at,
    "Medication Date" IS NOT NULL AND ("Diagnosis Date" IS NULL OR "Medication Date" <= "Diagnosis Date") AS med_at
  FROM labelled)
SELECT ENC_HN, "Index Date", "Initial Label", "Final Label",
  CASE WHEN dx_at AND med_at THEN 'Both' WHEN dx_at THEN 'Diagnosis' WHEN med_at THEN 'Medication' END
    || ' / ' || "Initial Label" AS "Initial Arm Label",
  CASE WHEN "Diagnosis Date" IS NOT NULL AND "Medication Date" IS NOT NULL THEN 'Both'
       WHEN "Diagnosis Date" IS NOT NULL THEN 'Diagnosis' WHEN "Medication Date" IS NOT NULL THEN 'Medication' END
    || ' / ' || "Final Label" AS "Final Arm Label"
FROM arms""")

    display = dict(SUBTYPE_DISPLAY)
    dist_rows = " UNION ALL ".join(
        f"""SELECT {i + 1} AS row_order, {_q(display[lab])} AS Subtype,
  count(*) FILTER (WHERE "Initial Label" = {_q(lab)}) AS i_n, count(*) FILTER (WHERE "Final Label" = {_q(lab)}) AS f_n,
  count(*) AS total FROM labelled"""
        for i, lab in enumerate(DISTRIBUTION_ORDER))
    out["subtype_distribution"] = w(f"""
, d AS ({dist_rows})
SELECT row_order, Subtype, CAST(i_n AS BIGINT) AS "Index n", {_pct('i_n', 'total')} AS "Index %",
  CAST(f_n AS BIGINT) AS "Final n", {_pct('f_n', 'total')} AS "Final %" FROM d
UNION ALL
SELECT {len(DISTRIBUTION_ORDER) + 1}, 'Total', CAST(count(*) AS BIGINT), 100.0::DOUBLE, CAST(count(*) AS BIGINT), 100.0::DOUBLE
FROM labelled""")
    out["formatted_percentages"] = w(f"""
, d AS ({dist_rows}),
p AS (SELECT row_order, Subtype, CAST(i_n AS BIGINT) AS i_n, {_pct('i_n', 'total')} AS i_p,
             CAST(f_n AS BIGINT) AS f_n, {_pct('f_n', 'total')} AS f_p FROM d
      UNION ALL SELECT {len(DISTRIBUTION_ORDER) + 1}, 'Total', CAST(count(*) AS BIGINT), 100.0::DOUBLE,
             CAST(count(*) AS BIGINT), 100.0::DOUBLE FROM labelled)
SELECT row_order, Subtype, i_n AS "Index n", CAST(printf('%.2f', i_p) AS DOUBLE) AS "Index %",
  CAST(i_n AS VARCHAR) || ' (' || printf('%.2f', i_p) || '%)' AS "Index n (%)",
  f_n AS "Final n", CAST(printf('%.2f', f_p) AS DOUBLE) AS "Final %",
  CAST(f_n AS VARCHAR) || ' (' || printf('%.2f', f_p) || '%)' AS "Final n (%)"
FROM p""")

    cells = ", ".join(
        f"""count(*) FILTER (WHERE "Initial Label" = i.lab AND "Final Label" = {_q(b)}) AS "{b}\""""
        for b in TRANSITION_ORDER)
    dim = _values([(i + 1, a) for i, a in enumerate(TRANSITION_ORDER)], ["row_order", "lab"])
    tot = " + ".join(f'"{b}"' for b in TRANSITION_ORDER)
    pcts = ", ".join(f'{_pct(chr(34) + b + chr(34), "row_total")} AS "{b} %"' for b in TRANSITION_ORDER)
    out["subtype_transition"] = w(f"""
, dim AS (SELECT * FROM {dim}),
grid AS (SELECT i.row_order, i.lab, {cells} FROM dim i LEFT JOIN labelled l ON l."Initial Label" = i.lab
         GROUP BY i.row_order, i.lab),
g2 AS (SELECT *, {tot} AS row_total FROM grid)
SELECT row_order, lab AS "{TRANSITION_KEY}", {', '.join(f'CAST("{b}" AS BIGINT) AS "{b}"' for b in TRANSITION_ORDER)},
  CAST(row_total AS BIGINT) AS "Row Total", {pcts} FROM g2
UNION ALL
SELECT {len(TRANSITION_ORDER) + 1}, 'Column Total',
  {', '.join(f'CAST(count(*) FILTER (WHERE "Final Label" = {_q(b)}) AS BIGINT)' for b in TRANSITION_ORDER)},
  CAST(count(*) AS BIGINT), {', '.join('CAST(NULL AS DOUBLE)' for _ in TRANSITION_ORDER)}
FROM labelled""")

    text_cells = ", ".join(
        f"CASE WHEN \"{TRANSITION_KEY}\" = 'Column Total' THEN CAST(\"{b}\" AS VARCHAR) "
        f"ELSE CAST(\"{b}\" AS VARCHAR) || ' (' || printf('%.2f', \"{b} %\") || '%)' END AS \"{b}\""
        for b in TRANSITION_ORDER)
    out["formatted_transition"] = out["subtype_transition"].replace("WITH ", "WITH tr AS (WITH ", 1) + f"""
)
SELECT row_order, "{TRANSITION_KEY}", "Row Total", {text_cells} FROM tr"""
    rrows = review_rows(maps)
    conds = []
    for r in rrows:
        if r["kind"] == "exact":
            c = f"code = {_q(r['code'])}"
        else:
            c = f"starts_with(code, {_q(r['code'])})"
            for x in r["exclude"]:
                c += f" AND NOT starts_with(code, {_q(x)})"
        conds.append((r, c))
    per_row = " UNION ALL ".join(
        f"SELECT {r['row_order']} AS row_order, {_q(r['review_group'])} AS review_group, {_q(r['code_group'])} AS code_group, "
        f"{_q(', '.join(r['exclude'])) if r['exclude'] else 'CAST(NULL AS VARCHAR)'} AS exclusion_note, "
        f"(SELECT count(DISTINCT ENC_HN) FROM dx_ev WHERE {c}) AS n"
        for r, c in conds)
    groups = sorted({r["review_group"] for r in rrows})
    per_group = " UNION ALL ".join(
        f"SELECT {_q(g)} AS review_group, (SELECT count(DISTINCT ENC_HN) FROM dx_ev WHERE "
        + " OR ".join(f"({c})" for r, c in conds if r["review_group"] == g and not r["exclude"]) + ") AS group_n"
        for g in groups)
    out["review_code_counts"] = w(f"""
, rr AS ({per_row}), gg AS ({per_group})
SELECT rr.row_order, rr.review_group, rr.code_group, rr.exclusion_note, CAST(rr.n AS BIGINT) AS n,
  CAST(gg.group_n AS BIGINT) AS group_n, {_pct('rr.n', 'gg.group_n')} AS pct
FROM rr JOIN gg ON rr.review_group = gg.review_group""")

    out["rt_billing_summary"] = w(f"""
, bw AS (SELECT s.ENC_HN, s.REC_DATE, b.brain FROM med_std s JOIN billmap b ON b.code = s.CODE
         WHERE {'s.REC_DATE BETWEEN TIMESTAMP ' + repr(D.DERIVED_WINDOW[0].strftime('%Y-%m-%d %H:%M:%S'))} AND TIMESTAMP {repr(D.DERIVED_WINDOW[1].strftime('%Y-%m-%d %H:%M:%S'))})
SELECT ENC_HN, min(REC_DATE) AS rt_first_date, max(REC_DATE) AS rt_last_date, count(*) AS n_billing_events,
  bool_or(brain) AS has_brain_spine_code FROM bw GROUP BY ENC_HN""")

    out["memantine_during_rt_events"] = w("""
SELECT m.ENC_HN, m.REC_DATE, m.CODE, r.rt_first_date, r.rt_last_date
FROM med_working m JOIN rt_summary r ON m.ENC_HN = r.ENC_HN
WHERE m.drug_class = 'Memantine' AND m.REC_DATE BETWEEN r.rt_first_date AND r.rt_last_date""")
    out["file_dementia_index_labelled"] = out["dementia_index_labelled"]
    number = "CAST(CAST(ENC_HN AS BIGINT) AS VARCHAR)"
    ids = f"""SELECT source, raw_id, {number.replace('ENC_HN', 'raw_id')} AS number, count(*) AS n_rows FROM (
  SELECT 'diagnosis' AS source, CASE WHEN CAST(ENC_HN AS BIGINT) % 10 = 0 AND D035KEY = {_q(D.DX_CODE_DEFAULT)} THEN {number} ELSE ENC_HN END AS raw_id FROM dx_src
  UNION ALL SELECT layout, {number} FROM med_raw
  UNION ALL SELECT 'operation', printf('%010d', CAST(ENC_HN AS BIGINT)) FROM operation
  UNION ALL SELECT 'surgery', printf('%010d', CAST(ENC_HN AS BIGINT)) FROM surgery
  UNION ALL SELECT 'demographic', {number} FROM demo) WHERE raw_id IS NOT NULL GROUP BY source, raw_id"""
    out["id_profile"] = w(f"""SELECT source, CASE WHEN raw_id = number THEN 'digits' ELSE 'leading zeros' END AS kind, length(raw_id) AS width,
  count(*) AS n_ids, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM ({ids}) GROUP BY ALL""")
    out["id_conflicts"] = w(f"""SELECT * FROM (SELECT source, raw_id, number, count(*) OVER (PARTITION BY source, number) AS n_forms, n_rows
  FROM ({ids})) WHERE n_forms > 1""")
    for name, of in (("published_dx_summary", "dx_summary"), ("published_age_issues", "age_exceptions"),
                     ("published_dx_working", "dx_working"), ("stored_exact_base", "exact_criteria_base"),
                     ("mapped_dx_summary", "dx_summary"), ("mapped_med_working", "med_working"),
                     ("stored_demographics", "demographics_dedup"), ("crosswalk_exact_base", "exact_criteria_base")):
        out[name] = out[of]
    return out
