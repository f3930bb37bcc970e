"""Session construction and the shared scratch / checkpoint folder.

On a cluster the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant file system). Only when
nothing is configured -- local runs and tests -- do we create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "skydrift",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    * UTC session time zone (oracle parity, no DST surprises in windows)
    * AQE with partition coalescing and skew-join splitting
    * UI off (no server is opened)
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # reliable checkpoints are deleted once their frames are unreachable
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # A broadcast is only ever planned for sides whose size is checked:
        # explicit hints are used solely where a bound is proven (limit n,
        # per-partition counts, per-category statistics); everything else
        # is left to AQE's runtime size check under this threshold.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    The cluster's ``spark.checkpoint.dir`` wins. A private folder is made
    only when a session in one JVM (local runs and tests) has none; on a
    cluster that folder would be on each machine's own disk, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        conf_dir = tempfile.mkdtemp(prefix="skydrift-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names, for what outlives a session (Spark's own
    checkpoint folder lies below it, with a new name each time); without one, the
    session's checkpoint folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return named or checkpoint_dir(spark)


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


#: Folders that :func:`temporaries` will remove, the innermost last.
_open: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table. The
    session's tables lie in one folder, which goes when the driver ends."""
    base = os.path.join(checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)
    fs, place = _fs(spark, base)
    if not fs.exists(place):
        fs.mkdirs(place)
        fs.deleteOnExit(place)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    if _open:
        _open[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _fs(spark, path)
    fs.delete(place, True)


@contextmanager
def temporaries(spark: SparkSession):
    """The scratch tables that are made inside are removed at its end, also after a
    failure. What reads them must have been written elsewhere by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)


def materialize(df):
    """Reliable checkpoint into the shared checkpoint folder: cuts lineage,
    fixes a layout that two branches of a plan must agree on, and survives
    executor loss (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for what is run inside; what it had is set again
    afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def shuffles_removed(spark: SparkSession):
    """The shuffle files of a write that is made inside are removed when it ends,
    not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def written(df, name: str, row_group: int | None = None):
    """``df``, written as parquet to the shared folder and read from there: computed
    once, it is read by column, and takes a fraction of a checkpoint's space. The
    shuffles that made it are gone by then. ``row_group``: bytes of a row group."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        out = df.write.option("compression", "zstd")
        (out.option("parquet.block.size", row_group) if row_group else out).parquet(path)
    return df.sparkSession.read.parquet(path)
