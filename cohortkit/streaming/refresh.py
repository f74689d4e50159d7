"""Incremental cohort refresh with Structured Streaming.

The published cohort is refreshed by periodic re-extraction (new cases twice a year,
follow-up visits quarterly). Every per-patient summary column is a ``min``, ``max`` or
``bool_or``, so merging a new extract into the summaries is exact and needs no re-read of
older extracts: the three arms' filtered events are a streaming union, aggregated per
patient with Spark's state store (the state is one row per patient), and each trigger writes
the full merged snapshot (``complete`` mode through ``foreachBatch``, an idempotent overwrite,
so a replayed batch after a failure writes the same snapshot).

``trigger(availableNow=True)`` processes whatever extract files are new since the last run and
stops, which is the refresh cadence of a periodic batch job; the checkpoint (under the shared
``spark.checkpoint.dir``) remembers the files and the per-patient state between runs.

Each layout is one folder of files with one schema (a streaming file source has a fixed
schema per folder; per-file resolution of mixed folders is the batch reader's job).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortkit.operators import criteria, diagnosis, medication, radiotherapy
from cohortkit.schemas import StudyWindow
from cohortkit.sources.codemaps import CodeMaps


@dataclass
class StreamLayouts:
    """Folders of each arm, with the schema of each folder's files."""

    diagnosis: dict[str, T.StructType] = field(default_factory=dict)
    medication: dict[str, T.StructType] = field(default_factory=dict)
    procedure: dict[str, T.StructType] = field(default_factory=dict)
    pattern: str | None = None
    max_files_per_trigger: int | None = None


def _stream(spark: SparkSession, folder: str, schema: T.StructType, layouts: StreamLayouts) -> DataFrame:
    r = spark.readStream.schema(schema)
    if layouts.pattern:
        r = r.option("pathGlobFilter", layouts.pattern)
    if layouts.max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(layouts.max_files_per_trigger))
    return r.parquet(folder)


def merged_summary_stream(spark: SparkSession, layouts: StreamLayouts, maps: CodeMaps | None = None,
                          window: StudyWindow | None = None) -> DataFrame:
    """Streaming per-patient merged summaries (the table J2 + J3 produce in batch)."""
    maps = maps or CodeMaps.default()
    window = window or StudyWindow()

    def streams(folders: dict[str, T.StructType]) -> list[DataFrame]:
        return [_stream(spark, f, s, layouts) for f, s in folders.items()]

    # the same per-layout filters as the batch plan, on streaming frames
    return criteria.merged_summaries_from_events(
        diagnosis.dx_events_from_layouts(spark, streams(layouts.diagnosis), maps, window),
        medication.med_working_from_layouts(spark, streams(layouts.medication), maps, window),
        radiotherapy.rt_working_from_layouts(spark, streams(layouts.procedure), maps, window),
        maps,
    )


def refresh_merged_summaries(spark: SparkSession, layouts: StreamLayouts, out_path: str,
                             checkpoint_location: str | None = None, maps: CodeMaps | None = None,
                             window: StudyWindow | None = None) -> str:
    """Process the new extract files once (``availableNow``); returns the newest merged snapshot.

    Every micro-batch writes a snapshot folder of its own under ``out_path`` (named by its number), so
    readers always have a complete one; without new files the last one is still the newest.
    """
    from cohortkit.session import checkpoint_dir

    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/refresh-merged-summaries"

    def write_snapshot(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/snapshot-{epoch:012d}")

    q = (merged_summary_stream(spark, layouts, maps, window).writeStream
         .outputMode("complete")
         .option("checkpointLocation", ckpt)
         .foreachBatch(write_snapshot)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return newest_snapshot(spark, out_path)


def newest_snapshot(spark: SparkSession, out_path: str) -> str:
    """The last complete snapshot folder under ``out_path``."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(out_path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{out_path}/snapshot-*/_SUCCESS"))
    if not found:
        raise FileNotFoundError(f"no snapshot under {out_path}")
    return max(s.getPath().getParent().toString() for s in found)


def refreshed_base(spark: SparkSession, merged_path: str) -> DataFrame:
    """The exact-criteria base (E13-E22) over the refreshed merged snapshot."""
    return criteria.apply_criteria(spark.read.parquet(merged_path))


def refreshed_labelled(spark: SparkSession, merged_path: str, demographic: DataFrame) -> DataFrame:
    """The labelled adult cohort (index date, age filter, initial and final labels) over the
    refreshed snapshot: the batch steps P6/P7 on the per-patient table."""
    from cohortkit.operators import index

    cohort = criteria.final_cohort(refreshed_base(spark, merged_path))
    indexed = index.index_with_age(cohort, index.birth_dates(demographic))
    return index.label_subtypes(index.dementia_index(indexed))
