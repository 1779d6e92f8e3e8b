"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app_name: str = "riskloom", **conf: str) -> SparkSession:
    """A local session for tests and timing; a cluster brings its own."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a session whose executor is the driver itself may fall back to a folder
    of this machine; on a cluster other executors could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# Folders written inside the open scopes of staging(), innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/riskloom/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that were staged inside the scope when it ends.

    Results that still read them must be written before. Without a scope the
    folders stay, since a lazy result may read them at any later time.
    """
    _scopes.append([])
    try:
        yield
    finally:
        remove(spark, _scopes.pop())


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged folders that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(target):
            files.delete(target, True)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet on the shared folder and read it back.

    Used before operators that scan their input several times: the joins and
    aggregations below are not repeated, later scans read only the columns
    they need, and a lost executor costs a re-read, not a recomputation. A ``path``
    from outside a scope of staging() outlives the scope.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_finished(spark: SparkSession) -> None:
    """Have executors drop the shuffle files of finished jobs, which they keep until the driver collects its garbage.

    The driver itself lets go of what it sent to finished jobs, and gives back the memory of a heap that is mostly empty then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
