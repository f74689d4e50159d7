"""cohortkit: dementia cohort identification from hospital event tables on Spark.

Typical use::

    from cohortkit import CohortPlan, FileSources, CodeMaps
    plan = CohortPlan(spark, FileSources(spark, diagnosis_dir=..., order_dir=..., medication_dir=...,
                                         procedure_dirs=(...,), demographic_path=...),
                      CodeMaps.from_dir(spark, map_dir))
    plan.labelled          # lazy DataFrame
    plan.run(shared_dir)   # writes every published table
"""

from cohortkit.plans.cohort import CohortPlan
from cohortkit.schemas import StudyWindow
from cohortkit.sources.codemaps import CodeMaps
from cohortkit.sources.derived import DerivedSources
from cohortkit.sources.files import FileSources

__all__ = ["CohortPlan", "CodeMaps", "DerivedSources", "FileSources", "StudyWindow"]
