"""Code maps: the dimension tables that drive every filter and label.

Two ways in:

* ``CodeMaps.default()`` - the published code lists, stated below as fixed values.
* ``CodeMaps.from_dir(spark, map_dir)`` - a directory of map CSVs with the published column
  names (``code``/``drug_code``, ``subtype``, ``drug_class``, ``include_in_cohort``, ...).

Maps are bounded by the code vocabulary (tens of rows here, a few thousand at most), so they
are brought to the driver once and turned into literal expressions (``InSet`` lookups inside
whole-stage codegen). Codes are normalized with the same rule as event codes (E1).
"""

from __future__ import annotations

import csv
import io
import re
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES - must equal the published code maps for identical results.
# ---------------------------------------------------------------------------

# Dementia ICD-10 codes: (code, subtype)
DEMENTIA_ICD10 = [
    ("F000", "AD"), ("F001", "AD"), ("F002", "AD"), ("F009", "AD"),
    ("G300", "AD"), ("G301", "AD"), ("G308", "AD"), ("G309", "AD"),
    ("F010", "VaD"), ("F011", "VaD"), ("F012", "VaD"), ("F013", "VaD"), ("F018", "VaD"), ("F019", "VaD"),
    ("G318", "Other"), ("F020", "Other"), ("G310", "Other"), ("F023", "Other"), ("G232", "Other"),
    ("G233", "Other"), ("G231", "Other"), ("F021", "Other"), ("F022", "Other"), ("F024", "Other"),
    ("F028", "Other"),
    ("F03", "Unspecified"),
]

# MCI ICD-10 codes (AChEI exclusion)
MCI_ICD10 = ["F067", "R41", "R418"]

# Schizophrenia ICD-10 codes (memantine exclusion)
SCHIZOPHRENIA_ICD10 = ["F20"]

# Codes under review: (code, match_type, review_group, exclude_codes)
REVIEW_CODES = [
    ("G31", "prefix", "Degenerative / Uncertain", "G318"),
    ("G312", "exact", "Degenerative / Uncertain", ""),
    ("G32", "prefix", "Degenerative / Uncertain", "G232|G233"),
    ("G328", "exact", "Degenerative / Uncertain", ""),
    ("F067", "exact", "MCI", ""),
    ("R41", "exact", "MCI", ""),
    ("R418", "exact", "MCI", ""),
    ("R44", "exact", "BPSD / Hallucinations", ""),
    ("R440", "exact", "BPSD / Hallucinations", ""),
    ("R441", "exact", "BPSD / Hallucinations", ""),
    ("R442", "exact", "BPSD / Hallucinations", ""),
    ("R443", "exact", "BPSD / Hallucinations", ""),
    ("R448", "exact", "BPSD / Hallucinations", ""),
    ("F22", "exact", "BPSD / Hallucinations", ""),
    ("F220", "exact", "BPSD / Hallucinations", ""),
    ("F228", "exact", "BPSD / Hallucinations", ""),
]

# Anti-dementia medication codes: (drug_code, drug_class); all have include_in_cohort = 1
MEDICATION = [
    ("ARIP-T-", "AChEI"), ("ARIP1T-", "AChEI"), ("ARIT-T-", "AChEI"), ("DONC-T-", "AChEI"),
    ("DOND-T-", "AChEI"), ("DOND1T-", "AChEI"), ("DONT-T-", "AChEI"), ("DONZ-T-", "AChEI"),
    ("EBIX-S-", "Memantine"), ("EBIX-T-", "Memantine"), ("EBIX1T-", "Memantine"), ("EBXA-S-", "Memantine"),
    ("ELAP-S-", "AChEI"), ("EXEL-S-", "AChEI"), ("EXEL-S1", "AChEI"), ("EXEL1C-", "AChEI"),
    ("EXEL1X-", "AChEI"), ("EXEL2C-", "AChEI"), ("EXEL2X-", "AChEI"), ("EXEL3C-", "AChEI"),
    ("EXEL3X-", "AChEI"), ("EXEL4C-", "AChEI"), ("EXEL5C-", "AChEI"),
    ("MEMA-T-", "Memantine"), ("MEME-T-", "Memantine"),
    ("REMN1T-", "AChEI"), ("REMN2T-", "AChEI"), ("REMN3C-", "AChEI"), ("REMN4C-", "AChEI"),
]

# Clozapine drug codes (memantine exclusion)
CLOZAPINE = ["CLOP1T-", "CLOP2T-", "CLOZ1T-", "N05AH02", "CLOZ2T-"]

# Radiotherapy ICD-9-CM procedure codes (memantine exclusion, method 1)
RADIOTHERAPY_ICD9 = [
    "9221", "9222", "9223", "9224", "9225", "9226", "9227", "9229",
    "9230", "9231", "9232", "9233", "9239", "9241",
]

# Radiotherapy billing codes (method 2): (code, brain_or_spine)
RADIOTHERAPY_BILLING = [
    ("X00568", False), ("X00569", False), ("X00572", False), ("X00576", False), ("X00577", False),
    ("X00579", False), ("X00825", True), ("X00826", True), ("X00827", True), ("X00829", True),
    ("X00833", False), ("X00974", False), ("X01372", False), ("X01374", False), ("X01375", False),
    ("X01376", False), ("X01378", False), ("X01380", False), ("X01557", False), ("X01558", False),
    ("X01561", False), ("X01562", False),
]

# Subtype labels and their display names, in report order
SUBTYPE_DISPLAY = [
    ("AD", "Alzheimer's Disease"),
    ("VaD", "Vascular Dementia"),
    ("Unspecified", "Unspecified"),
    ("Other", "Other Dementia"),
    ("Mixed", "Mixed Dementia"),
]
DISTRIBUTION_ORDER = ["AD", "VaD", "Unspecified", "Other", "Mixed"]
TRANSITION_ORDER = ["AD", "VaD", "Unspecified", "Mixed", "Other"]

# Literal code used for the "unspecified" date (earliest F03 code)
UNSPECIFIED_DATE_PREFIX = "F03"

# ---------------------------------------------------------------------------

_NON_ALNUM = re.compile(r"[^A-Z0-9]")
_EXCLUDE_LIST = re.compile(r"^[A-Z0-9]+(\|[A-Z0-9]+)*$")
SPECIFIC_SUBTYPES = ("AD", "VaD", "Other")


def normalize_code_value(code) -> str:
    """E1 for driver-side map values: upper case, keep [A-Z0-9] only."""
    return _NON_ALNUM.sub("", str(code).upper())


@dataclass(frozen=True)
class ReviewCode:
    code: str
    match_type: str  # "prefix" or "exact"
    review_group: str
    exclude_codes: tuple[str, ...] = ()


@dataclass(frozen=True)
class CodeMaps:
    """Normalized code maps. All codes are already normalized."""

    dementia: tuple[tuple[str, str], ...]  # (code, subtype)
    mci: tuple[str, ...]
    schizophrenia: tuple[str, ...]
    review: tuple[ReviewCode, ...]
    medication: tuple[tuple[str, str], ...]  # (drug_code, drug_class), include_in_cohort == 1
    clozapine: tuple[str, ...]
    radiotherapy: tuple[str, ...]
    billing: tuple[tuple[str, bool], ...] = field(default=())

    # -- groups used by the pipeline --------------------------------------------------------
    def subtype_codes(self, subtype: str) -> list[str]:
        return _dedup(c for c, s in self.dementia if s == subtype)

    @property
    def dementia_codes(self) -> list[str]:
        return _dedup(c for c, _ in self.dementia)

    @property
    def diagnosis_prefixes(self) -> list[str]:
        """every code of the dementia, MCI, review and schizophrenia maps."""
        codes = [c for c, _ in self.dementia] + list(self.mci) + [r.code for r in self.review]
        return sorted(set(c for c in codes + list(self.schizophrenia) if c))

    def diagnosis_groups(self) -> dict[str, list[str]]:
        """Prefix lists per diagnosis flag."""
        return {
            "is_dementia": self.dementia_codes,
            "is_ad": self.subtype_codes("AD"),
            "is_vad": self.subtype_codes("VaD"),
            "is_other": self.subtype_codes("Other"),
            "is_unspecified": self.subtype_codes("Unspecified"),
            "is_mci": list(self.mci),
            "is_schizophrenia": list(self.schizophrenia),
        }

    def drug_classes(self) -> dict[str, list[str]]:
        """Codes by class; of a code that is listed twice the last row counts."""
        out: dict[str, list[str]] = {}
        for code, cls in dict(self.medication).items():
            out.setdefault(cls, []).append(code)
        return out

    @property
    def relevant_drug_codes(self) -> list[str]:
        """Dementia drugs union clozapine."""
        return sorted(set(c for c, _ in self.medication) | set(self.clozapine))

    # -- constructors ------------------------------------------------------------------------
    @classmethod
    def default(cls) -> "CodeMaps":
        return cls(
            dementia=tuple((normalize_code_value(c), s) for c, s in DEMENTIA_ICD10),
            mci=tuple(normalize_code_value(c) for c in MCI_ICD10),
            schizophrenia=tuple(normalize_code_value(c) for c in SCHIZOPHRENIA_ICD10),
            review=tuple(
                ReviewCode(normalize_code_value(c), m, g, _parse_excludes(x)) for c, m, g, x in REVIEW_CODES
            ),
            medication=tuple((normalize_code_value(c), k) for c, k in MEDICATION),
            clozapine=tuple(normalize_code_value(c) for c in CLOZAPINE),
            radiotherapy=tuple(normalize_code_value(c) for c in RADIOTHERAPY_ICD9),
            billing=tuple((normalize_code_value(c), b) for c, b in RADIOTHERAPY_BILLING),
        )

    @classmethod
    def from_dir(cls, spark, map_dir: str) -> "CodeMaps":
        """Read the map CSVs of ``map_dir``. The dementia and medication maps must exist with
        their columns and there must be a diagnosis prefix; another map that is missing is empty.

        Every column is read as text (no inference, T25). The maps are tiny dimension tables,
        so they are collected once to the driver.
        """
        from cohortkit.functions.codes import prefix_regex
        from cohortkit.sources.files import read_map_csv

        dem = read_map_csv(spark, f"{map_dir}/dementia_icd10_map.csv", ["code", "subtype"], required=True)
        mci = read_map_csv(spark, f"{map_dir}/mci_icd10_map.csv", ["code"])
        scz = read_map_csv(spark, f"{map_dir}/schizophrenia_icd10_map.csv", ["code"])
        rev = read_map_csv(spark, f"{map_dir}/review_code_map.csv",
                           ["code", "match_type", "review_group", "exclude_codes"])
        med = read_map_csv(spark, f"{map_dir}/medication_map.csv", ["drug_code", "drug_class", "include_in_cohort"],
                           required=True)
        clz = read_map_csv(spark, f"{map_dir}/clozapine_map.csv", ["drug_code"])
        rt = read_map_csv(spark, f"{map_dir}/radiotherapy_icd9_map.csv", ["code"])

        def codes(rows, key="code"):
            return tuple(normalize_code_value(r[key]) for r in rows if _present(r.get(key)))

        medication = []
        for r in med:
            if not _present(r.get("drug_code")):
                continue
            if _as_int(r.get("include_in_cohort")) != 1:  # bad or null -> 0
                continue
            medication.append((normalize_code_value(r["drug_code"]), r.get("drug_class")))
        maps = cls(
            dementia=tuple((normalize_code_value(r["code"]), r.get("subtype")) for r in dem if _present(r.get("code"))),
            mci=codes(mci),
            schizophrenia=codes(scz),
            review=tuple(
                ReviewCode(normalize_code_value(r["code"]), (r.get("match_type") or "exact").strip().lower(),
                           r.get("review_group") or "", _parse_excludes(r.get("exclude_codes")))
                for r in rev if _present(r.get("code"))
            ),
            medication=tuple(medication),
            clozapine=codes(clz, "drug_code"),
            radiotherapy=codes(rt),
            billing=cls.default().billing,
        )
        prefix_regex(maps.diagnosis_prefixes)  # E4: raises when the maps hold no prefix
        return maps


    def to_dir(self, spark, map_dir: str, left_out_drugs: tuple[str, ...] = ()) -> str:
        """Writes the maps as the CSVs that ``from_dir`` reads (the billing codes have none). ``left_out_drugs``
        are listed as drugs that are not included in the cohort (F7)."""
        from cohortkit.sources.files import write_text

        tables = {
            "dementia_icd10_map": (["code", "subtype"], self.dementia),
            "mci_icd10_map": (["code"], [(c,) for c in self.mci]),
            "schizophrenia_icd10_map": (["code"], [(c,) for c in self.schizophrenia]),
            "review_code_map": (["code", "match_type", "review_group", "exclude_codes"],
                                [(r.code, r.match_type, r.review_group, "|".join(r.exclude_codes)) for r in self.review]),
            "medication_map": (["drug_code", "drug_class", "include_in_cohort"],
                               [*[(c, k, "1") for c, k in self.medication], *[(c, "AChEI", "0") for c in left_out_drugs]]),
            "clozapine_map": (["drug_code"], [(c,) for c in self.clozapine]),
            "radiotherapy_icd9_map": (["code"], [(c,) for c in self.radiotherapy]),
        }
        for name, (header, rows) in tables.items():
            text = io.StringIO()
            csv.writer(text, lineterminator="\n").writerows([header, *rows])
            write_text(spark, f"{map_dir}/{name}.csv", text.getvalue())
        return map_dir


def _present(v) -> bool:
    return v is not None and str(v).strip() != ""


def _as_int(v):
    try:
        return int(str(v).strip())
    except (TypeError, ValueError):
        return None


def _parse_excludes(text) -> tuple[str, ...]:
    """``exclude_codes`` counts only when it is a ``|``-list of codes (a stray note is ignored)."""
    if text is None:
        return ()
    t = str(text).strip()
    if not _EXCLUDE_LIST.match(t):
        return ()
    return tuple(t.split("|"))


def _dedup(values) -> list[str]:
    out: list[str] = []
    for v in values:
        if v and v not in out:
            out.append(v)
    return out
