"""Index date, age and subtype labels (P6, P7 labels part)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.dates import age_in_years, parse_birth_date
from cohortkit.operators.standardize import patient_id

# FIXED VALUES: display names of the index table
INDEX_DISPLAY = (
    ("index_date", "Index Date"), ("diagnosis_date", "Diagnosis Date"), ("medication_date", "Medication Date"),
    ("ad_date", "AD Date"), ("vad_date", "VaD Date"), ("other_date", "Other Date"),
    ("unspecified_date", "Unspecified Date"),
)
ADULT_AGE = 18


def _parsed_dob(demographic: DataFrame) -> DataFrame:
    return demographic.select(
        patient_id(demographic).alias("ENC_HN"),
        parse_birth_date(F.col("D020AT3"), demographic.schema["D020AT3"].dataType).alias("dob"),
    )


def birth_dates(demographic: DataFrame) -> DataFrame:
    """One date of birth per patient of the demographic table (no cohort needed).

    The latest date wins and an unparsable/missing one beats all (T17). Written as an
    aggregate rather than a window so it is combined map-side: a patient with very many
    demographic rows cannot pile up in one task.
    """
    return _dedup(_parsed_dob(demographic))


def demographics_dedup(demographic: DataFrame, cohort_ids: DataFrame) -> DataFrame:
    """One date of birth per cohort patient (semi-join, then ``birth_dates``)."""
    return _dedup(_parsed_dob(demographic).join(cohort_ids.select("ENC_HN"), "ENC_HN", "left_semi"))


def _dedup(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("ENC_HN").agg(
        F.when(F.count_if(F.col("dob").isNull()) > 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.max("dob").cast("timestamp_ntz")).alias("D020AT3")
    )


def with_index_date(final_cohort: DataFrame) -> DataFrame:
    """Index date = earlier of diagnosis date and qualified medication date."""
    return final_cohort.withColumn("index_date", F.least(F.col("diagnosis_date"), F.col("medication_date")))


def index_with_age(final_cohort: DataFrame, dob: DataFrame) -> DataFrame:
    """Index table (display names) with date of birth and age at index.

    ``dob`` is one row per patient (``birth_dates`` or ``demographics_dedup``); a left join
    keeps every cohort patient. Patients without a usable date of birth keep a null age
    (they are dropped by the adult filter and counted apart, T16).
    """
    base = with_index_date(final_cohort).select("ENC_HN", *[F.col(s).alias(d) for s, d in INDEX_DISPLAY])
    return base.join(dob, "ENC_HN", "left").withColumn(
        "age_at_index", age_in_years(F.col("Index Date"), F.col("D020AT3"))
    )


def dementia_index(indexed: DataFrame) -> DataFrame:
    """adults at index (unknown age drops)."""
    return indexed.filter(F.col("age_at_index") >= ADULT_AGE)


def age_exceptions(indexed: DataFrame) -> DataFrame:
    """Patients younger than 18 at index (unknown age excluded)."""
    return indexed.filter(F.col("age_at_index") < ADULT_AGE)


def _label(ad: Column, vad: Column, other: Column) -> Column:
    n = ad.cast("int") + vad.cast("int") + other.cast("int")
    return (F.when(n >= 2, F.lit("Mixed"))
            .when((n == 1) & ad, F.lit("AD"))
            .when((n == 1) & vad, F.lit("VaD"))
            .when((n == 1) & other, F.lit("Other"))
            .otherwise(F.lit("Unspecified")))


def _on_or_before(d: str, idx: str = "Index Date") -> Column:
    return F.col(d).isNotNull() & F.coalesce(F.col(d) <= F.col(idx), F.lit(False))


def label_subtypes(index_df: DataFrame) -> DataFrame:
    """Initial label from subtype dates on or before index; final from any date.

    Two or more specific subtypes -> Mixed, one -> that subtype, none -> Unspecified
    (F03 and medication never make a patient Mixed).
    """
    initial = _label(_on_or_before("AD Date"), _on_or_before("VaD Date"), _on_or_before("Other Date"))
    final = _label(F.col("AD Date").isNotNull(), F.col("VaD Date").isNotNull(), F.col("Other Date").isNotNull())
    return index_df.withColumn("Initial Label", initial).withColumn("Final Label", final)


def at_index_flags(dx_date: Column, med_date: Column) -> tuple[Column, Column]:
    """Which criteria hold at the index date; a same-day tie sets both."""
    dx_at = dx_date.isNotNull() & (med_date.isNull() | F.coalesce(dx_date <= med_date, F.lit(False)))
    med_at = med_date.isNotNull() & (dx_date.isNull() | F.coalesce(med_date <= dx_date, F.lit(False)))
    return dx_at, med_at


def _arm(dx: Column, med: Column) -> Column:
    return (F.when(dx & med, F.lit("Both")).when(dx, F.lit("Diagnosis")).when(med, F.lit("Medication")))


def label_with_arm(labelled: DataFrame) -> DataFrame:
    """E30: "Both / AD" style labels: arm at index from E23, final arm from date presence."""
    dx, med = F.col("Diagnosis Date"), F.col("Medication Date")
    dx_at, med_at = at_index_flags(dx, med)
    return labelled.select(
        "ENC_HN", "Index Date", "Initial Label", "Final Label",
        F.concat_ws(" / ", _arm(dx_at, med_at), F.col("Initial Label")).alias("Initial Arm Label"),
        F.concat_ws(" / ", _arm(dx.isNotNull(), med.isNotNull()), F.col("Final Label")).alias("Final Arm Label"),
    )
