"""Session helpers: configuration for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run of the pipeline relies on: AQE for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast of sides measured small) and naive timestamps.
PIPELINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None, app: str = "cohortkit",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("COHORTKIT_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or (8 if cpus == "*" else int(cpus)))))
    for k, v in {**PIPELINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is only read here; without it a cluster run
    raises, since executors would write to their own disks. A local run gets a private scratch
    folder, registered for this session.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    master = spark.conf.get("spark.master", "local")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext handle (Spark Connect): the conf is enough
        pass
    return path
