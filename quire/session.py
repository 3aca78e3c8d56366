"""Session construction and the checkpoint folder.

On a cluster the session is supplied by the caller and ``spark.checkpoint.dir``
names a shared folder; we only read it. A private temporary folder is created
only for local sessions (tests, benchmarks) that did not set one.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "quire",
    shuffle_partitions: int = 8,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only when unset.

    ``DataFrame.checkpoint`` and ALS lineage truncation both write there, so a
    lost executor costs a re-read of a checkpoint instead of a replay of the job.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    folder = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def let_go(spark: SparkSession) -> None:
    """Spark deletes the shuffle files and blocks of frames that nothing refers to any more,
    but only after the driver has collected its garbage, which on a large heap may be never.
    To be called where a result has been written and the frames it came from are done with."""
    for _ in range(2):  # what the first pass frees may itself have held frames
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quire-package-"), "quire-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def sizing_conf(
    input_bytes: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    min_partitions: int = 8,
) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``input_bytes``.

    The initial shuffle partition count aims at ``target_partition_bytes`` per
    partition before AQE coalesces small ones, so the largest shuffles of a
    100 TB input start near 400k partitions instead of 200. Scan splits use the
    same target so that a task's input fits comfortably in executor memory.
    """
    partitions = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
