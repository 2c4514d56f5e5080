"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for.  They are applied only to sessions built
# here; a session handed in by the caller is used as it is.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle later on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tillwright", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, sinks and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir`` so that every
    executor, and a restarted one, sees it.  Only a local-mode session without
    that setting gets a folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tillwright-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_SCOPES: list[list[str]] = []


def stored(df: DataFrame, purpose: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` and read it back, where several results build on it.

    It goes to a new folder in the shared scratch folder, or replaces what is at ``path``.
    """
    own = path is None
    path = path or scratch_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path, compression=compression)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    if own:
        _PATHS[back] = path
        for scope in _SCOPES:
            scope.append(path)
    return back


def released(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` gave, once nothing builds on them any more."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path:
            dropped(df.sparkSession, path)


@contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """The folders of the tables stored meanwhile, for a caller that knows when nothing reads them any more."""
    scope: list[str] = []
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not scope]


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def there(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def collected(spark: SparkSession) -> None:
    """Let the driver's JVM collect garbage: the shuffle files of jobs that are done and read by nothing go with it.

    The scheduler holds on to the job before until it has had another one, so a job of one row comes first.
    """
    gc.collect()
    spark.range(0, 1, 1, 1).collect()
    spark.sparkContext._jvm.System.gc()
