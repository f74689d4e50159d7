"""Incremental refresh: two availableNow runs over growing extract folders equal one batch run."""

import glob
import os
import shutil

from cohortkit.checks.compare import rows_of
from cohortkit.operators import criteria
from cohortkit.plans.queries import DERIVED_STUDY_WINDOW, derived_plan
from cohortkit.sources.files import materialize_derived_lake
from cohortkit.streaming.refresh import StreamLayouts, refresh_merged_summaries, refreshed_base, refreshed_labelled
from tests.conftest import SF_SMALL

FOLDERS = {"diagnosis": "diagnosis", "order": "medication", "medication_b": "medication",
           "medication_c": "medication", "operation": "procedure", "surgery": "procedure"}


def test_refresh_in_two_extracts_equals_batch(spark, tmp_dir):
    lake = materialize_derived_lake(spark, SF_SMALL, root=f"{tmp_dir}/lake", split_layouts=True, files_per_layout=4)
    inbox = f"{tmp_dir}/inbox"
    parts = {}
    for folder in FOLDERS:
        os.makedirs(f"{inbox}/{folder}")
        parts[folder] = sorted(glob.glob(f"{lake}/{folder}/part-*.parquet"))
        assert len(parts[folder]) >= 2
    arms = {"diagnosis": {}, "medication": {}, "procedure": {}}
    for folder, arm in FOLDERS.items():
        arms[arm][f"{inbox}/{folder}"] = spark.read.parquet(f"{lake}/{folder}").schema
    layouts = StreamLayouts(diagnosis=arms["diagnosis"], medication=arms["medication"],
                            procedure=arms["procedure"], pattern="*.parquet", max_files_per_trigger=3)
    ckpt, out = f"{tmp_dir}/ckpt", f"{tmp_dir}/merged"

    def deliver(half: int) -> None:
        for folder, files in parts.items():
            chosen = files[: len(files) // 2] if half == 1 else files[len(files) // 2:]
            for f in chosen:
                shutil.copy(f, f"{inbox}/{folder}/{os.path.basename(f)}")

    deliver(1)
    first_path = refresh_merged_summaries(spark, layouts, out, ckpt, window=DERIVED_STUDY_WINDOW)
    first = spark.read.parquet(first_path).count()
    deliver(2)
    out = refresh_merged_summaries(spark, layouts, out, ckpt, window=DERIVED_STUDY_WINDOW)
    assert out > first_path and spark.read.parquet(first_path).count() == first  # the older one stays readable
    batch = derived_plan(spark, SF_SMALL).exact_base
    assert first <= batch.count()
    assert rows_of(refreshed_base(spark, out).toPandas()) == rows_of(batch.toPandas())
    assert rows_of(refreshed_base(spark, out).toPandas()) == rows_of(criteria.apply_criteria(
        spark.read.parquet(out)).toPandas())
    plan = derived_plan(spark, SF_SMALL)
    labelled = refreshed_labelled(spark, out, plan.sources.demographic())
    assert rows_of(labelled.toPandas()) == rows_of(plan.labelled.toPandas())
