"""Fixed schemas of the working and summary tables, and the study window."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

TS = T.TimestampNTZType()
STR = T.StringType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DX_STANDARD = _struct(("ENC_HN", STR), ("D001KEY", TS), ("code", STR))
DX_FLAGS = ("is_dementia", "is_ad", "is_vad", "is_other", "is_unspecified", "is_mci", "is_schizophrenia")
MED_STANDARD = _struct(("ENC_HN", STR), ("REC_DATE", TS), ("CODE", STR))
PROC_STANDARD = _struct(("ENC_HN", STR), ("PROC_DATE", TS), ("PROC_CODE", STR))


@dataclass(frozen=True)
class StudyWindow:
    """both ends inclusive, compared as naive datetimes (end is midnight, T6)."""

    start: dt.datetime = dt.datetime(2010, 1, 1)
    end: dt.datetime = dt.datetime(2025, 12, 31)

    def sql_bounds(self) -> tuple[str, str]:
        return (self.start.strftime("%Y-%m-%d %H:%M:%S"), self.end.strftime("%Y-%m-%d %H:%M:%S"))
