"""Reports (A6-A19, E28, E29, O4, U3).

Every report is one global (or tiny grouped) aggregate over a per-patient table followed by
a shuffle-free unpivot (``inline`` of an array of structs) into a fixed row order, so the
fixed report grid exists even where a label has no patient (A13, A16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.codes import prefix_match
from cohortkit.functions.format import n_pct_text, with_fixed2
from cohortkit.operators.index import at_index_flags
from cohortkit.sources.codemaps import DISTRIBUTION_ORDER, SUBTYPE_DISPLAY, TRANSITION_ORDER, CodeMaps

# FIXED VALUES: flow report step names (spacer rows are not published)
FLOW_STEPS = (
    "ICD10 patients", "Medication patients", "ICD10 only (tentative)", "Medication only (tentative)",
    "Both (tentative)", "Total tentative dementia", "ICD10 patients", "Medication patients",
    "ICD10 only (final)", "Medication only (final)", "Both (final)", "Total dementia",
)
# FIXED VALUES: exclusion report step names and their counters
EXCLUSION_STEPS = (
    ("Medication patients evaluated", "medication_patients_evaluated"),
    ("AChEI patients", "achei_patients"),
    ("AChEI excluded by MCI", "achei_excluded_mci"),
    ("AChEI left", "achei_left"),
    ("Memantine patients", "memantine_patients"),
    ("Memantine excluded by schizophrenia/clozapine", "memantine_excluded_schizo"),
    ("Memantine remaining after schizo", "memantine_after_schizo"),
    ("Memantine excluded by radiotherapy", "memantine_excluded_radio"),
    ("Memantine left", "memantine_left"),
    ("Medication excluded patients (total)", "medication_excluded_patients"),
    ("Medication qualifying patients", "medication_qualifying_patients"),
    ("Inferred diagnosis patients", "inferred_unspecified_patients"),
)
TRANSITION_KEY = "Index \\ Final"


def _rows(agg_one_row: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    """Unpivot a one-row aggregate into fixed rows: ``inline(array(struct(..), ..))``."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]
    return agg_one_row.select(F.inline(F.array(*structs)))


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rows_sql(agg_one_row: DataFrame, rows: list[list[str]], names: list[str]) -> DataFrame:
    """``_rows`` with SQL cell expressions: the whole fixed grid is one expression, built by
    the JVM in a single call instead of one call per cell."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"{_sql_str(n)}, {e}" for n, e in zip(names, r)) + ")" for r in rows)
    return agg_one_row.selectExpr(f"inline(array({structs}))")


def _pct_sql(n: str, total: str) -> str:
    """SQL of ``_pct`` (same operation order; ``100.0D`` is a double literal)."""
    return f"CASE WHEN {total} > 0 THEN {n} / {total} * 100.0D ELSE 0.0D END"


def _pct(n: Column, total: Column) -> Column:
    """n / total * 100 in double, 0.0 when the total is 0 (same operation order as published)."""
    return F.when(total > 0, n / total * F.lit(100.0)).otherwise(F.lit(0.0))


# -- flow reports (A8-A11) -----------------------------------------------------------------
def flow_report(base: DataFrame, by: str = "availability") -> DataFrame:
    c = F.col
    dx, med_c = c("is_dx_confirmed"), c("is_med_candidate")
    fc = c("is_final_cohort")
    dx_d, med_d = c("diagnosis_date"), c("qualified_medication_date")
    if by == "availability":
        f_dx, f_med = dx_d.isNotNull(), med_d.isNotNull()
    elif by == "index":
        f_dx, f_med = at_index_flags(dx_d, med_d)
    else:
        raise ValueError(by)
    agg = base.agg(
        F.count_if(dx).alias("icd"), F.count_if(med_c).alias("med"),
        F.count_if(dx & ~med_c).alias("icd_only"), F.count_if(~dx & med_c).alias("med_only"),
        F.count_if(dx & med_c).alias("both"),
        F.count_if(fc & f_dx).alias("f_icd"), F.count_if(fc & f_med).alias("f_med"),
        F.count_if(fc & f_dx & ~f_med).alias("f_icd_only"), F.count_if(fc & ~f_dx & f_med).alias("f_med_only"),
        F.count_if(fc & f_dx & f_med).alias("f_both"), F.count_if(fc).alias("total"),
    )
    vals = [c("icd"), c("med"), c("icd_only"), c("med_only"), c("both"), c("icd") + c("med") - c("both"),
            c("f_icd"), c("f_med"), c("f_icd_only"), c("f_med_only"), c("f_both"), c("total")]
    rows = [[F.lit(i + 1), F.lit(step), v.cast("bigint")] for i, (step, v) in enumerate(zip(FLOW_STEPS, vals))]
    return _rows(agg, rows, ["step_order", "Step", "Patients"])


def exclusion_steps(base: DataFrame) -> DataFrame:
    """The medication exclusion steps (spacers dropped, T24 row kept)."""
    from cohortkit.operators.criteria import exact_criteria_counts_wide

    wide = exact_criteria_counts_wide(base)  # one aggregate; unpivoted in place below
    rows = [[F.lit(i + 1), F.lit(step), F.col(m).cast("bigint")] for i, (step, m) in enumerate(EXCLUSION_STEPS)]
    return _rows(wide, rows, ["step_order", "Step", "Patients"])


# -- subtype distribution and transition (A13-A17) ----------------------------------------
def subtype_distribution(labelled: DataFrame) -> DataFrame:
    """N and unrounded % at index and final per subtype, plus a Total row (T19: the
    rounded text is a display step, see ``subtype_distribution_display``)."""
    agg = labelled.selectExpr(
        "count(1) AS n_total",
        *[f"count_if(`Initial Label` = {_sql_str(lab)}) AS i_{lab}" for lab in DISTRIBUTION_ORDER],
        *[f"count_if(`Final Label` = {_sql_str(lab)}) AS f_{lab}" for lab in DISTRIBUTION_ORDER],
    )
    display = dict(SUBTYPE_DISPLAY)
    rows = [[str(i + 1), _sql_str(display[lab]), f"i_{lab}", _pct_sql(f"i_{lab}", "n_total"),
             f"f_{lab}", _pct_sql(f"f_{lab}", "n_total")] for i, lab in enumerate(DISTRIBUTION_ORDER)]
    rows.append([str(len(DISTRIBUTION_ORDER) + 1), "'Total'", "n_total", "100.0D", "n_total", "100.0D"])
    return _rows_sql(agg, rows, ["row_order", "Subtype", "Index n", "Index %", "Final n", "Final %"])


def subtype_distribution_display(labelled: DataFrame) -> DataFrame:
    """Published display form with "n (p.pp%)" text and % rounded to 2 places."""
    d = with_fixed2(subtype_distribution(labelled),
                    [("Index %", "_it", "_ir"), ("Final %", "_ft", "_fr")])
    return d.select(
        "row_order", "Subtype", "Index n", F.col("_ir").alias("Index %"),
        n_pct_text(F.col("Index n"), F.col("_it")).alias("Index n (%)"),
        "Final n", F.col("_fr").alias("Final %"),
        n_pct_text(F.col("Final n"), F.col("_ft")).alias("Final n (%)"),
    )


def subtype_transition(labelled: DataFrame) -> DataFrame:
    """Initial x final counts on the fixed grid, row totals, unrounded row %,
    and a column-total row."""
    agg = labelled.selectExpr(*[
        f"count_if(`Initial Label` = {_sql_str(a)} AND `Final Label` = {_sql_str(b)}) AS t_{a}_{b}"
        for a in TRANSITION_ORDER for b in TRANSITION_ORDER
    ])
    rows = []
    for i, a in enumerate(TRANSITION_ORDER):
        cells = [f"t_{a}_{b}" for b in TRANSITION_ORDER]
        total = "(" + " + ".join(cells) + ")"
        rows.append([str(i + 1), _sql_str(a), *cells, total, *[_pct_sql(x, total) for x in cells]])
    col_tot = ["(" + " + ".join(f"t_{a}_{b}" for a in TRANSITION_ORDER) + ")" for b in TRANSITION_ORDER]
    grand = "(" + " + ".join(col_tot) + ")"
    rows.append([str(len(TRANSITION_ORDER) + 1), "'Column Total'", *col_tot, grand,
                 *["CAST(NULL AS DOUBLE)" for _ in TRANSITION_ORDER]])
    names = ["row_order", TRANSITION_KEY, *TRANSITION_ORDER, "Row Total", *[f"{b} %" for b in TRANSITION_ORDER]]
    return _rows_sql(agg, rows, names)


def subtype_transition_display(labelled: DataFrame) -> DataFrame:
    """Published display form: "n (p.pp%)" cells, Row Total, Column Total row."""
    t = with_fixed2(subtype_transition(labelled), [(f"{b} %", f"_t{i}", None) for i, b in enumerate(TRANSITION_ORDER)])
    is_total = F.col(TRANSITION_KEY) == "Column Total"
    cells = [
        F.when(is_total, F.col(b).cast("string")).otherwise(n_pct_text(F.col(b), F.col(f"_t{i}"))).alias(b)
        for i, b in enumerate(TRANSITION_ORDER)
    ]
    return t.select("row_order", TRANSITION_KEY, "Row Total", *cells)


# -- age exceptions (A18) ------------------------------------------------------------------
def age_exception_stats(indexed: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles, max of age at index below 18.

    Computed on whole days and divided by 365 at the end. Sums are exact integers, the
    variance is formed from exact integer sums, and quartiles are exact (interpolated)
    percentiles of the integer days, whose buffer is bounded by the number of distinct day
    counts, not by the number of patients.
    """
    from cohortkit.functions.dates import DAYS_PER_YEAR, days_between

    days = days_between(F.col("Index Date"), F.col("D020AT3"))
    young = indexed.filter(F.col("age_at_index") < 18).select(days.cast("long").alias("d"))
    dec = F.col("d").cast("decimal(38,0)")
    agg = young.agg(
        F.count("d").alias("n"), F.sum(dec).alias("s1"), F.sum(dec * dec).alias("s2"),
        F.min("d").alias("dmin"), F.max("d").alias("dmax"),
        F.percentile(F.col("d"), [0.25, 0.5, 0.75]).alias("q"),
    )
    y = F.lit(float(DAYS_PER_YEAR))
    n = F.col("n")
    var_num = (n.cast("decimal(38,0)") * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    var_den = (n * (n - 1)).cast("double")
    return agg.select(
        n.alias("count"),
        (F.col("s1").cast("double") / n / y).alias("mean"),
        F.when(n > 1, F.sqrt(var_num / var_den) / y).alias("std"),
        (F.col("dmin") / y).alias("min"),
        (F.col("q")[0] / y).alias("p25"),
        (F.col("q")[1] / y).alias("p50"),
        (F.col("q")[2] / y).alias("p75"),
        (F.col("dmax") / y).alias("max"),
    )


# -- stage counts (A7, F8) -----------------------------------------------------------------
def stage_counts(dx_working: DataFrame, med_working: DataFrame, rt_working: DataFrame) -> DataFrame:
    """Rows and distinct patients per stage, as (metric, value).

    One scan per arm: the arm's working table is reduced to a row per patient (its number of
    rows and whether it has the arm's dementia signal), and one global aggregate counts those.
    A summary has a row for each patient of its working table.
    """
    from cohortkit.operators.criteria import to_long

    arms = [
        (dx_working, F.col("is_dementia"),
         ("dx_working_rows", "dx_working_patients", "dx_summary_patients", "icd10_dementia_patients")),
        (med_working, F.col("is_dementia_med"),
         ("med_working_rows", "med_working_patients", "med_summary_patients", "medication_dementia_patients")),
        (rt_working, F.lit(False), ("rt_working_rows", "rt_working_patients", "rt_summary_patients")),
    ]
    parts = []
    for df, hit, names in arms:
        per = df.groupBy("ENC_HN").agg(F.count(F.lit(1)).alias("n"), F.bool_or(hit).alias("hit"))
        patients = F.count(F.lit(1))
        values = [F.coalesce(F.sum("n"), F.lit(0)), patients, patients, F.count_if(F.col("hit"))]
        wide = per.agg(*[v.alias(name) for v, name in zip(values, names)])
        parts.append(to_long(wide, wide.columns, "metric", "value"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("metric", F.col("value").cast("bigint").alias("value"))


# -- age filter and dropped ids (T16, T10) -------------------------------------------------------
def age_filter_counts(indexed: DataFrame) -> DataFrame:
    """Cohort patients by age at index: adult, under 18, unknown age (published apart;
    the published "< 18" number is under 18 plus unknown)."""
    age = F.col("age_at_index")
    agg = indexed.agg(F.count(F.lit(1)).alias("n_final_cohort"), F.count_if(age >= 18).alias("n_adult"),
                      F.count_if(age < 18).alias("n_under_18"), F.count_if(age.isNull()).alias("n_unknown_age"))
    agg = agg.withColumn("n_flagged_not_adult", F.col("n_under_18") + F.col("n_unknown_age"))
    from cohortkit.operators.criteria import to_long

    return to_long(agg, agg.columns, "metric", "value")


def null_id_counts(plan) -> DataFrame:
    """Source rows whose patient id is null, per arm (they are dropped, not kept as a
    pseudo-patient)."""
    from cohortkit.operators.criteria import to_long

    parts = [df.agg(F.count_if(F.col("ENC_HN").isNull()).alias(name)) for name, df in (
        ("diagnosis_null_id_rows", plan.dx_standardized), ("medication_null_id_rows", plan.med_union),
        ("procedure_null_id_rows", plan.proc_union))]
    longs = [to_long(p, p.columns, "metric", "value") for p in parts]
    return longs[0].unionByName(longs[1]).unionByName(longs[2])


# -- codes under review (A19) --------------------------------------------------------------
def review_rows(maps: CodeMaps) -> list[dict]:
    """Report rows of the review map: exact code, ``prefix*``, and ``prefix* excluding ..``."""
    rows = []
    for r in maps.review:
        base = {"review_group": r.review_group, "code": r.code}
        if r.match_type == "prefix":
            rows.append({**base, "code_group": f"{r.code}*", "kind": "prefix", "exclude": ()})
            if r.exclude_codes:
                rows.append({**base, "code_group": f"{r.code}* excluding {', '.join(r.exclude_codes)}",
                             "kind": "prefix", "exclude": tuple(r.exclude_codes)})
        else:
            rows.append({**base, "code_group": r.code, "kind": "exact", "exclude": ()})
    for i, row in enumerate(rows):
        row["row_order"] = i + 1
    return rows


def review_code_counts(dx_events: DataFrame, maps: CodeMaps) -> DataFrame:
    """Distinct patients per review-code row and per review group (rows overlap).

    Each (patient, code) pair is tagged with the report rows and groups it matches (literal
    tests, fan-out bounded by the review map), then (patient, tag) is de-duplicated and
    counted per tag: a two-level aggregate, so a group holding most patients is still
    combined map-side.
    """
    rows = review_rows(maps)
    code = F.col("code")
    tags = []
    groups = []
    for row in rows:
        if row["kind"] == "exact":
            cond = code == F.lit(row["code"])
        else:
            cond = code.startswith(row["code"])
            if row["exclude"]:
                cond = cond & ~prefix_match("code", row["exclude"])
        tags.append(F.when(cond, F.lit(f"r{row['row_order']}")))
        if not row["exclude"]:
            groups.append(F.when(cond, F.lit("g" + row["review_group"])))
    pairs = dx_events.select("ENC_HN", "code").filter(F.col("ENC_HN").isNotNull())
    tagged = pairs.select("ENC_HN", F.explode(F.array_compact(F.array(*tags, *groups))).alias("tag"))
    counts = tagged.groupBy("tag").agg(F.count_distinct("ENC_HN").alias("n"))
    cells = [(r["row_order"], r["review_group"], r["code_group"], ", ".join(r["exclude"]) or None, kind, tag) for r in rows
             for kind, tag in (("n", f"r{r['row_order']}"), ("group_n", "g" + r["review_group"]))]
    dim = dx_events.sparkSession.createDataFrame(
        cells, "row_order int, review_group string, code_group string, exclusion_note string, kind string, tag string")
    # both numbers of a row are looked up in the same counts: one aggregate over the events
    found = dim.join(F.broadcast(counts), "tag", "left")

    def of(kind: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint").alias(kind)

    out = found.groupBy("row_order", "review_group", "code_group", "exclusion_note").agg(of("n"), of("group_n"))
    return out.withColumn("pct", _pct(F.col("n"), F.col("group_n")))
