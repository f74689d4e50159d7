"""Hospital-style sources derived from the driver's TPC-H-like tables.

The driver tables are not clinical, so diagnosis, prescription, procedure and demographic
sources are derived from them by integer arithmetic that Spark and DuckDB compute the same
way (rules in FIXTURES.md section 3). Everything stays lazy: each source is a projection of
``lineitem JOIN orders`` (or of ``customer``), so its size grows with the tables.

Each layout keeps its own native column names, so the standardizers (S8-S12) resolve the
date and code columns exactly as they do for files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.codes import padded_id
from cohortkit.session import checkpoint_dir

# FIXED VALUES: study window of the derived sources (the data spans 1995-01-01 .. 2001-11-04)
DERIVED_WINDOW = (dt.datetime(1996, 1, 1), dt.datetime(2001, 6, 30))

# FIXED VALUES: diagnosis code by kd = (partkey*31 + suppkey*7 + linenumber*101 + orderkey*3) mod 1000
DX_CODE_BY_KD = [
    (0, 4, "G30.9"), (5, 6, "f00.1"), (7, 8, "F01.9"), (9, 9, "F011"), (10, 11, "G31.8"),
    (12, 12, " G23.2"), (13, 16, "F03"), (17, 17, "F06.7"), (18, 18, "R41"), (19, 19, "R41.8"),
    (20, 21, "F20.0"), (22, 22, "G31.2"), (23, 23, "G32.8"), (24, 24, "R44.1"), (25, 25, "F22.0"),
    (26, 26, "F03, G30.9"), (27, 27, "R41.0"),
]
DX_CODE_DEFAULT = "Z00.0"

# FIXED VALUES: drug / billing code by km = (partkey*17 + suppkey*13 + linenumber*211 + orderkey*5) mod 1000
MED_CODE_BY_KM = [
    (0, 4, "DONT-T-"), (5, 7, "EXEL1C-"), (8, 11, "EBIX-T-"), (12, 12, "CLOZ1T-"),
    (20, 21, "X00825"), (22, 23, "X00974"), (24, 25, "X00568"),
]
MED_CODE_DEFAULT = "PARA-T-"
CO_PRESCRIPTION_CODE = "DONT-T-"

# FIXED VALUES: procedure code by kp = (partkey*11 + suppkey*29 + linenumber*307 + orderkey*7) mod 1000
PROC_CODE_BY_KP = [(0, 3, "92.24"), (4, 7, "9223"), (8, 10, "92.30"), (11, 11, "9241")]
PROC_CODE_DEFAULT = "8751"

# FIXED VALUES: demographic rule
# FIXED VALUES: rows of this code key have no patient id; diagnosis rows of the other have a date
# text without leading zeros. Neither key has a map code.
NULL_ID_KEY, SHORT_DATE_KEY = 999, 998
BIRTH_BASE = dt.date(1915, 1, 1)
BIRTH_SPAN_DAYS = 30000
BIRTH_MULTIPLIER = 37


def _range_case(key: Column, table, default: str) -> Column:
    """Code by key range as one array lookup (the key expression is referenced once, so a
    filter pushed through this projection does not repeat it per range)."""
    top = max(hi for _, hi, _ in table)
    by_key = [default] * (top + 1)
    for lo, hi, code in table:
        for k in range(lo, hi + 1):
            by_key[k] = code
    arr = F.array(*[F.lit(c) for c in by_key])
    return F.coalesce(F.try_element_at(arr, (key + 1).cast("int")), F.lit(default))


def _id_unless(key: Column) -> Column:
    """The patient id, null where the code key is 999 (a key without a map code)."""
    return F.when(key != NULL_ID_KEY, F.col("hn")).alias("ENC_HN")


def _as_source(df: DataFrame, *cols: Column, only: Column | None = None) -> DataFrame:
    """Project the layout's columns behind a generator so the layout behaves like a file scan:
    every derived value is computed once per row, and filters of the consumer stay above it
    instead of being inlined (repeatedly) into the derivation.

    Rows that do not meet ``only`` are left out by the generator, and both dates go into it whether the layout
    has them or not: so every layout asks the same of the join below, whose shuffles then run once for all.
    """
    row = F.array(F.struct(*cols, F.col("od").alias("_od"), F.col("sd").alias("_sd")))
    return df.select(F.inline(row if only is None else F.when(only, row))).drop("_od", "_sd")


def _ymd(d: Column) -> Column:
    """yyyyMMdd text of a date or naive timestamp (zone-free cast, no per-row formatter)."""
    return F.translate(F.to_date(d).cast("string"), "-", "")


def _date_text(ts: Column, ln: Column) -> Column:
    """Date text of a timestamp by line number: yyyyMMdd (ln%3=0), yyyy-MM-dd (1), with time (2).

    Built with casts of the naive timestamp, which involve no session time zone (a zone whose
    daylight saving starts at midnight cannot shift the text).
    """
    m = ln % 3
    day = F.to_date(ts).cast("string")
    return (F.when(m == 0, F.translate(day, "-", ""))
            .when(m == 1, day)
            .otherwise(F.substring(ts.cast("string"), 1, 19)))


@dataclass
class DerivedSources:
    """Lazy derived sources over one scale-factor directory."""

    spark: SparkSession
    sf_dir: str
    _frames: dict = field(default_factory=dict, repr=False)

    def _table(self, name: str) -> DataFrame:
        if name not in self._frames:  # one relation per table: identical subtrees, one footer read
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def lines(self) -> DataFrame:
        """``lineitem JOIN orders`` with the patient id, dates and the three code keys."""
        if "lines" not in self._frames:
            self._frames["lines"] = self._lines()
        return self._frames["lines"]

    def stored(self) -> DerivedSources:
        """The same sources over ``lines`` written once to the shared folder, for what runs several jobs over them: each
        job would join, and shuffle, the whole tables again."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/lines-{uuid.uuid4().hex[:12]}"
        lines = self.lines()
        lines.write.parquet(path)
        return DerivedSources(self.spark, self.sf_dir, {"lines": self.spark.read.schema(lines.schema).parquet(path)})

    def _lines(self) -> DataFrame:
        li = self._table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
        o = self._table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
        pk, sk, ln, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("o_orderkey")
        return j.select(
            padded_id(F.col("o_custkey")).alias("hn"),
            F.col("o_orderdate").alias("od"),
            F.col("l_shipdate").alias("sd"),
            ln.alias("ln"),
            ((pk * 31 + sk * 7 + ln * 101 + ok * 3) % 1000).alias("kd"),
            ((pk * 17 + sk * 13 + ln * 211 + ok * 5) % 1000).alias("km"),
            ((pk * 11 + sk * 29 + ln * 307 + ok * 7) % 1000).alias("kp"),
        )

    # -- diagnosis (S2 shape: ENC_HN, D001KEY, D035KEY) -------------------------------------
    def _memo(self, key: str, build):
        if key not in self._frames:
            self._frames[key] = build()
        return self._frames[key]

    def diagnosis(self) -> DataFrame:
        return self._memo("diagnosis", self._diagnosis)

    def _diagnosis(self) -> DataFrame:
        x = self.lines()
        od = F.col("od")
        d001 = (F.when((F.col("kd") == 4) & (F.col("ln") == 7), F.lit("n/a"))
                .when(F.col("kd") == SHORT_DATE_KEY, F.concat_ws("-", F.year(od), F.month(od), F.dayofmonth(od)))
                .otherwise(_date_text(od, F.col("ln"))))
        return _as_source(
            x,
            _id_unless(F.col("kd")),
            d001.alias("D001KEY"),
            _range_case(F.col("kd"), DX_CODE_BY_KD, DX_CODE_DEFAULT).alias("D035KEY"),
        )

    def diagnosis_layouts(self) -> dict[str, DataFrame]:
        return {"diagnosis": self.diagnosis()}

    # -- order / medication, three layouts ---------------------------------------------------
    def medication_layouts(self) -> dict[str, DataFrame]:
        return dict(self._memo("medication", self._medication_layouts))

    def _medication_layouts(self) -> dict[str, DataFrame]:
        """Layout A (order: REC_DATE, PROP_HELP, CODE), B (BillDate, freetext, Drugcode),
        C (D001KEY, Comment, DSPCode); A also carries the same-day co-prescriptions."""
        x = self.lines()
        code = _range_case(F.col("km"), MED_CODE_BY_KM, MED_CODE_DEFAULT)
        date = _date_text(F.col("sd"), F.col("ln"))
        m = F.col("ln") % 3
        note = F.lit(None).cast("string")
        a = _as_source(x, _id_unless(F.col("km")), date.alias("REC_DATE"),
                       note.alias("PROP_HELP"), code.alias("CODE"), only=m == 0)
        co = _as_source(
            x, F.col("hn").alias("ENC_HN"), _ymd(F.col("od")).alias("REC_DATE"),
            note.alias("PROP_HELP"), F.lit(CO_PRESCRIPTION_CODE).alias("CODE"), only=F.col("kd") == 0)
        b = _as_source(x, _id_unless(F.col("km")), date.alias("BillDate"),
                       note.alias("freetext"), code.alias("Drugcode"), only=m == 1)
        c = _as_source(x, _id_unless(F.col("km")), date.alias("D001KEY"),
                       note.alias("Comment"), code.alias("DSPCode"), only=m == 2)
        return {"order_a": a.unionByName(co), "medication_b": b, "medication_c": c}

    # -- procedures: operation (D036KEY) and surgery (OPR_1, OPR_2) --------------------------
    def procedure_layouts(self) -> dict[str, DataFrame]:
        return dict(self._memo("procedure", self._procedure_layouts))

    def _procedure_layouts(self) -> dict[str, DataFrame]:
        x = self.lines()
        code = _range_case(F.col("kp"), PROC_CODE_BY_KP, PROC_CODE_DEFAULT)
        date = _date_text(F.col("sd"), F.col("ln"))
        odd = (F.col("ln") % 2) == 1
        even_kp = (F.col("kp") % 2) == 0
        op = _as_source(x, _id_unless(F.col("kp")), date.alias("D001KEY"), code.alias("D036KEY"), only=odd)
        sg = _as_source(
            x, _id_unless(F.col("kp")), date.alias("D001KEY"),
            F.when(even_kp, code).alias("OPR_1"),
            F.when(~even_kp, code).alias("OPR_2"), only=~odd,
        )
        return {"operation": op, "surgery": sg}

    # -- demographic (S7 shape: ENC_HN, D020AT3 as double yyyymmdd) --------------------------
    def demographic(self) -> DataFrame:
        return self._memo("demographic", self._demographic)

    def _demographic(self) -> DataFrame:
        c = self._table("customer").select("c_custkey")
        key = F.col("c_custkey")
        birth = F.date_add(F.lit(BIRTH_BASE), ((key * BIRTH_MULTIPLIER) % BIRTH_SPAN_DAYS).cast("int"))
        hn = padded_id(key)

        def as_double(d: Column) -> Column:
            return _ymd(d).cast("double")

        base = c.filter((key % 50) != 2).select(hn.alias("ENC_HN"), as_double(birth).alias("D020AT3"))
        nulls = c.filter((key % 50) == 0).select(hn.alias("ENC_HN"), F.lit(None).cast("double").alias("D020AT3"))
        later = c.filter((key % 50) == 1).select(hn.alias("ENC_HN"), as_double(F.date_add(birth, 365)).alias("D020AT3"))
        return base.unionByName(nulls).unionByName(later)


class MixedWidths:
    """Derived sources whose ids have other widths by source: diagnoses seven digits, medications and demographics numbers,
    procedures ten digits. ``twice``: ids that are multiples of ten stand without zeros on diagnosis rows of the default code."""

    def __init__(self, sources: DerivedSources, twice: bool = False):
        self.sources, self.twice = sources, twice

    def diagnosis_layouts(self) -> dict[str, DataFrame]:
        plain = F.col("ENC_HN").cast("bigint")
        short = F.when((plain % 10 == 0) & (F.col("D035KEY") == DX_CODE_DEFAULT), plain.cast("string")).otherwise(F.col("ENC_HN"))
        return {n: d.withColumn("ENC_HN", short) if self.twice else d for n, d in self.sources.diagnosis_layouts().items()}

    def medication_layouts(self) -> dict[str, DataFrame]:
        return {n: d.withColumn("ENC_HN", F.col("ENC_HN").cast("bigint")) for n, d in self.sources.medication_layouts().items()}

    def procedure_layouts(self) -> dict[str, DataFrame]:
        return {n: d.withColumn("ENC_HN", F.lpad("ENC_HN", F.greatest(F.lit(10), F.length("ENC_HN")), F.lit("0"))) for n, d in self.sources.procedure_layouts().items()}

    def demographic(self) -> DataFrame:
        d = self.sources.demographic()
        return d.withColumn("ENC_HN", F.col("ENC_HN").cast("bigint"))

    def id_layouts(self) -> dict[str, DataFrame]:
        return {**self.diagnosis_layouts(), **self.medication_layouts(), **self.procedure_layouts(), "demographic": self.demographic()}
