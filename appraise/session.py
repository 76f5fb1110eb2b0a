"""Spark session factory and the shared checkpoint folder.

The library never picks a machine-local folder on a cluster: the checkpoint
folder comes from ``spark.checkpoint.dir`` (set by whoever runs the cluster).
Only a local master without that setting (tests, laptops) gets a scratch
folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(
    app_name: str = "appraise",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session. When it is unset and the
    master is local, a scratch folder is created (tests only); on a cluster an
    unset value is an error, because a local folder is not shared.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session manages its own checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor shares"
            )
        conf_dir = tempfile.mkdtemp(prefix="appraise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)


def materialize(df):
    """Reliable checkpoint into the shared folder, computing the input only once.

    A reliable checkpoint writes its files in a second job that recomputes the
    input; persisting first lets that job read the cached blocks instead. The
    cache is released once the checkpoint files exist; the returned frame reads
    only the checkpoint (short lineage, survives executor loss).
    """
    from pyspark import StorageLevel

    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when a query ends, not when the driver happens to collect its garbage.

    For queries whose result is written or collected: a frame that is run again makes its shuffles again.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def written(df):
    """The frame as a table in the shared folder: computed once, later reads take only the columns they need."""
    path = scratch_path(df.sparkSession, f"frame-{uuid.uuid4().hex}")
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
