"""Run the whole cohort pipeline and write its tables (``spark-submit`` friendly).

    python -m cohortkit.plans.cli --out /shared/cohort/251231 \
        --diagnosis-dir .../diagnosis --order-dir .../order --medication-dir .../medication \
        --procedure-dir .../operation --procedure-dir .../surgery \
        --demographic .../demographic/demographic_1_cleaned.parquet.gzip --map-dir .../maplist/cohort

    python -m cohortkit.plans.cli --out /tmp/out --derived-from /root/testdata/sf0.01

The session comes from ``SparkSession.builder.getOrCreate()`` (cluster settings are the
deployment's); the output folder must be shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from cohortkit.plans.cohort import CohortPlan
from cohortkit.schemas import StudyWindow
from cohortkit.session import PIPELINE_CONF
from cohortkit.sources.codemaps import CodeMaps


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--out", required=True)
    ap.add_argument("--derived-from", help="driver-table directory: derive the sources from it")
    ap.add_argument("--diagnosis-dir")
    ap.add_argument("--order-dir")
    ap.add_argument("--medication-dir")
    ap.add_argument("--procedure-dir", action="append", default=[])
    ap.add_argument("--demographic")
    ap.add_argument("--map-dir", help="code-map CSV folder (default: built-in maps)")
    ap.add_argument("--pattern", default="*.parquet.gzip",
                    help="file pattern of the order, medication and procedure folders")
    ap.add_argument("--rt-method", default="icd9", choices=["icd9", "billing", "both"],
                    help="radiotherapy course: ICD-9 procedures, billing codes, or both")
    ap.add_argument("--start", default="2010-01-01")
    ap.add_argument("--end", default="2025-12-31")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("cohortkit")
    for k, v in PIPELINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    maps = CodeMaps.from_dir(spark, args.map_dir) if args.map_dir else CodeMaps.default()
    if args.derived_from:
        from cohortkit.plans.queries import DERIVED_STUDY_WINDOW
        from cohortkit.sources.derived import DerivedSources

        plan = CohortPlan(spark, DerivedSources(spark, args.derived_from), maps, DERIVED_STUDY_WINDOW,
                          rt_method=args.rt_method)
    else:
        from cohortkit.sources.files import FileSources

        window = StudyWindow(dt.datetime.fromisoformat(args.start), dt.datetime.fromisoformat(args.end))
        src = FileSources(spark, args.diagnosis_dir, args.order_dir, args.medication_dir,
                          tuple(args.procedure_dir), args.demographic, pattern=args.pattern)
        plan = CohortPlan(spark, src, maps, window, rt_method=args.rt_method)
    written = plan.run(args.out)
    print(json.dumps(written, indent=1))
    return written


if __name__ == "__main__":
    main()
