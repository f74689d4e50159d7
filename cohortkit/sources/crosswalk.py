"""Patient ids that sources write in different widths (``0000123``, ``123``), joined by an explicit crosswalk.

Ids are text and taken as they are, so two widths are two patients unless a crosswalk says otherwise. ``id_forms`` counts
the ids of every layout, ``id_profile`` shows the widths and kinds of each, ``id_crosswalk`` maps every form of a number to
one patient id, and ``id_conflicts`` lists the numbers that one layout writes in several forms. Those may be
different patients, so they are in no crosswalk and keep their ids as written. Ids that are not ASCII digits throughout
are no numbers and stay, as do null ids. A table of the same columns (raw_id, ENC_HN) made by hand does as well.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.codes import padded_id
from cohortkit.operators.standardize import ID_COL, patient_id


def id_forms(layouts: Mapping[str, DataFrame]) -> DataFrame:
    """source, raw_id, number (null if the id is none) and n_rows of every id of every layout; layouts without ids have none."""
    parts = [df.select(patient_id(df).alias("raw_id")).filter("raw_id IS NOT NULL").groupBy("raw_id").agg(F.count(F.lit(1)).alias("n_rows"))
             .withColumn("source", F.lit(name)) for name, df in layouts.items() if ID_COL in df.columns]
    if not parts:
        raise ValueError("no layout has patient ids")
    forms = reduce(DataFrame.unionByName, parts)
    number = F.when(F.col("raw_id").rlike("^[0-9]+$"), F.regexp_replace("raw_id", "^0+(?=[0-9])", ""))
    return forms.select("source", "raw_id", number.alias("number"), "n_rows")


def id_profile(forms: DataFrame) -> DataFrame:
    """n_ids and n_rows of each source, kind (digits, leading zeros, other) and width."""
    kind = F.when(F.col("number").isNull(), "other").when(F.col("number") != F.col("raw_id"), "leading zeros").otherwise("digits")
    return forms.groupBy("source", kind.alias("kind"), F.length("raw_id").cast("long").alias("width")) \
        .agg(F.count(F.lit(1)).alias("n_ids"), F.sum("n_rows").alias("n_rows"))


def _several(forms: DataFrame) -> DataFrame:
    """source, number and n_forms of the numbers that a source writes in several forms."""
    return forms.filter("number IS NOT NULL").groupBy("source", "number").agg(F.count(F.lit(1)).alias("n_forms")).filter("n_forms > 1")


def id_conflicts(forms: DataFrame) -> DataFrame:
    """source, raw_id, number, n_forms and n_rows of every form of a number that its source writes in several forms."""
    return forms.join(_several(forms), ["source", "number"]).select("source", "raw_id", "number", "n_forms", "n_rows")


def id_crosswalk(forms: DataFrame) -> DataFrame:
    """raw_id and ENC_HN, the number padded to seven digits, of every form that differs from it; one row a raw_id. Numbers in conflict
    in any source are left out."""
    sure = forms.filter("number IS NOT NULL").select("raw_id", "number").distinct().join(_several(forms), "number", "left_anti")
    return sure.select("raw_id", padded_id("number").alias(ID_COL)).filter(f"raw_id <> {ID_COL}")


def with_crosswalk(rows: DataFrame, crosswalk: DataFrame | None) -> DataFrame:
    """``rows`` with the ids that ``crosswalk`` gives; others stay. The crosswalk has one row a raw_id, so no row is repeated,
    and adaptive execution splits a hot patient on the side of the rows."""
    if crosswalk is None:
        return rows
    names = crosswalk.select(F.col("raw_id").alias("__raw_id"), F.col(ID_COL).alias("__patient"))
    found = rows.join(names, F.col(ID_COL) == F.col("__raw_id"), "left")
    return found.select(*[F.coalesce("__patient", ID_COL).alias(c) if c == ID_COL else F.col(c) for c in rows.columns])
