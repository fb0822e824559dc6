"""Session defaults and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "adledger", **extra: str) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the settings results and plans depend on: UTC day boundaries, AQE
    (runtime broadcast decisions from measured sizes, partition coalescing) and
    skew-join splitting.  Shuffle partition counts are left to the cluster.
    Joins may keep to a layout by some of their keys (``search.by_item``)."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a fresh local folder is set, but only when
    driver and executors are one process (``local[...]``, as in tests).  On a
    cluster a machine-local folder would leave each executor's part files on
    its own disk, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        d = _local_folder(spark.sparkContext.master)
        spark.sparkContext.setCheckpointDir(d)
    return d


def _local_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on storage that the "
                           "driver and all executors share")
    return tempfile.mkdtemp(prefix="adledger-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stage_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet (``options``: the writer's) under the shared checkpoint folder and read it back.

    Used for the one reduced intermediate that several consumers read: they
    all scan the written table (columnar, pruned), the expensive lineage above
    it runs once, and a lost executor costs a re-read of shared files rather
    than a recomputation from the raw reports.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _STAGED[id(out)] = (out, path)
    return out


def together(*steps: Callable[[], T]) -> list[T]:
    """Run steps that stage tables at the same time: Spark shares the executors among their jobs."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


# Staged tables not yet dropped: the DataFrame that reads each, and its folder.
_STAGED: dict[int, tuple[DataFrame, str]] = {}


def staged_paths(df: DataFrame | None = None) -> list[str]:
    """The staging folder of a DataFrame returned by ``stage_table``; without one, of all not yet dropped."""
    return sorted(path for key, (_, path) in _STAGED.items() if df is None or key == id(df))


def drop_staged(df: DataFrame) -> None:
    """Delete the staging folder behind ``df`` once every dataset built on it is written."""
    if id(df) in _STAGED:
        delete_folder(df.sparkSession, _STAGED.pop(id(df))[1])


@contextmanager
def staging() -> Iterator[None]:
    """A scope of staging: what is staged inside is dropped at its end, also after a failure; nothing else is.

    ``with staging(): build(...).write...`` leaves no staged table behind.
    Scopes nest.  One scope a process at a time holds, as for the session itself.
    """
    before = set(_STAGED)
    try:
        yield
    finally:
        for key in [k for k in _STAGED if k not in before]:
            drop_staged(_STAGED[key][0])


def release_all() -> None:
    """Drop every staged table: after queries whose results have been written or collected."""
    for df, _ in list(_STAGED.values()):
        drop_staged(df)


def _file_system(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and its path there: PySpark has no public call to move or delete folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever storage it is."""
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``; where there is no source, an empty folder."""
    fs, to = _file_system(spark, target)
    _, src = _file_system(spark, source)
    fs.delete(to, True)
    if not fs.exists(src):
        fs.mkdirs(to)
    elif not fs.rename(src, to):
        raise OSError(f"{source} could not be moved to {target}")
