"""A plain-Python statement of the cohort rules, for property tests on small fixtures.

Row-by-row over Python lists; it only exists to cross-check the Spark plan.
"""

from __future__ import annotations

import datetime as dt
import re

from cohortkit.sources.codemaps import CodeMaps

START, END = dt.datetime(2010, 1, 1), dt.datetime(2025, 12, 31)


def norm(code):
    return None if code is None else re.sub(r"[^A-Z0-9]", "", str(code).upper())


def parse(text):
    if text is None:
        return None
    for fmt, width in (("%Y%m%d", 8), ("%Y-%m-%d", 10), ("%Y-%m-%d %H:%M:%S", 19)):
        if len(text) == width:
            try:
                return dt.datetime.strptime(text, fmt)
            except ValueError:
                pass
    return None


def starts(code, prefixes):
    return any(code.startswith(p) for p in prefixes)


def cohort(dx_rows, med_rows, op_rows, demo_rows, maps: CodeMaps | None = None):
    maps = maps or CodeMaps.default()
    g = maps.diagnosis_groups()
    dx = {}
    for hn, text, raw in dx_rows:
        ts, code = parse(text), norm(raw)
        if hn is None or ts is None or not code or not starts(code, maps.diagnosis_prefixes) or not (START <= ts <= END):
            continue
        s = dx.setdefault(hn, {"dates": {}, "mci": False, "scz": False})
        for key, pref in (("diagnosis_date", g["is_dementia"]), ("ad_date", g["is_ad"]), ("vad_date", g["is_vad"]),
                          ("other_date", g["is_other"]), ("unspecified_date", ["F03"]), ("mci_date", g["is_mci"]),
                          ("schizophrenia_date", g["is_schizophrenia"])):
            if starts(code, pref):
                s["dates"][key] = min(ts, s["dates"].get(key, ts))
        s["mci"] |= starts(code, g["is_mci"])
        s["scz"] |= starts(code, g["is_schizophrenia"])
    cls = dict(maps.medication)
    cloz = set(maps.clozapine)
    med = {}
    for hn, text, raw in med_rows:
        ts, code = parse(text), norm(raw)
        if hn is None or ts is None or code is None or code not in set(cls) | cloz or not (START <= ts <= END):
            continue
        s = med.setdefault(hn, {"dates": {}, "cloz": False})
        for key, ok in (("medication_date", code in cls), ("achei_date", cls.get(code) == "AChEI"),
                        ("memantine_date", cls.get(code) == "Memantine"), ("clozapine_date", code in cloz)):
            if ok:
                s["dates"][key] = min(ts, s["dates"].get(key, ts))
        s["cloz"] |= code in cloz
    rt = {}
    for hn, text, raw in op_rows:
        ts, code = parse(text), norm(raw)
        if hn is None or ts is None or not code or not starts(code, maps.radiotherapy) or not (START <= ts <= END):
            continue
        lo, hi = rt.get(hn, (ts, ts))
        rt[hn] = (min(lo, ts), max(hi, ts))
    base = {}
    for hn in set(dx) | set(med):
        d = dx.get(hn, {"dates": {}, "mci": False, "scz": False})
        m = med.get(hn, {"dates": {}, "cloz": False})
        dd, md = d["dates"], m["dates"]
        is_dx = "diagnosis_date" in dd
        is_med = "medication_date" in md
        achei_c = is_med and "achei_date" in md
        excl_mci = achei_c and d["mci"]
        achei_left = achei_c and not excl_mci
        mem_c = is_med and "memantine_date" in md
        excl_scz = mem_c and (d["scz"] or m["cloz"])
        mem_after = mem_c and not excl_scz
        course = rt.get(hn)
        excl_rt = bool(mem_after and course and course[0] <= md["memantine_date"] <= course[1])
        mem_left = mem_after and not excl_rt
        q = [x for x in ((md.get("achei_date") if achei_left else None),
                         (md.get("memantine_date") if mem_left else None)) if x is not None]
        qmed = min(q) if q else None
        base[hn] = {
            "is_dx_confirmed": is_dx, "is_med_candidate": is_med, "exclude_mci_achei": excl_mci,
            "exclude_schizophrenia_memantine": excl_scz, "exclude_radiotherapy_memantine": excl_rt,
            "is_med_qualifying": achei_left or mem_left, "medication_date": qmed,
            "is_final_cohort": is_dx or achei_left or mem_left,
            **{k: dd.get(k) for k in ("diagnosis_date", "ad_date", "vad_date", "other_date", "unspecified_date")},
        }
    dobs = {}
    for hn, value in demo_rows:
        if value is None:
            dob = None
        else:
            try:
                dob = dt.datetime.strptime(str(int(value)).replace(".0", ""), "%Y%m%d")
            except ValueError:
                dob = None
        dobs.setdefault(hn, []).append(dob)
    labelled = {}
    for hn, b in base.items():
        if not b["is_final_cohort"]:
            continue
        idx = min(x for x in (b["diagnosis_date"], b["medication_date"]) if x is not None)
        cand = dobs.get(hn)
        dob = None if not cand or any(x is None for x in cand) else max(cand)
        age = None if dob is None else (idx.date() - dob.date()).days / 365
        if age is None or age < 18:
            continue
        spec = [b["ad_date"], b["vad_date"], b["other_date"]]

        def label(flags):
            n = sum(flags)
            if n >= 2:
                return "Mixed"
            if n == 1:
                return ["AD", "VaD", "Other"][flags.index(True)]
            return "Unspecified"

        labelled[hn] = {
            "Index Date": idx, "age_at_index": age,
            "Initial Label": label([x is not None and x <= idx for x in spec]),
            "Final Label": label([x is not None for x in spec]),
        }
    return base, labelled
