"""Small in-memory sources for unit fixtures (tests only)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class MemSources:
    spark: object
    dx: list = field(default_factory=list)          # (ENC_HN, D001KEY text, D035KEY)
    med: list = field(default_factory=list)         # (ENC_HN, REC_DATE text, CODE)
    operation: list = field(default_factory=list)   # (ENC_HN, D001KEY text, D036KEY)
    demo: list = field(default_factory=list)        # (ENC_HN, D020AT3 double)

    def diagnosis_layouts(self):
        return {"dx": self.spark.createDataFrame(self.dx, "ENC_HN string, D001KEY string, D035KEY string")}

    def medication_layouts(self):
        return {"order": self.spark.createDataFrame(
            self.med, "ENC_HN string, REC_DATE string, PROP_HELP string, CODE string")}

    def procedure_layouts(self):
        return {"operation": self.spark.createDataFrame(self.operation, "ENC_HN string, D001KEY string, D036KEY string")}

    def demographic(self):
        return self.spark.createDataFrame(self.demo, "ENC_HN string, D020AT3 double")


def med(hn, date, code):
    return (hn, date, None, code)
