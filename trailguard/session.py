"""Session construction and the shared folder used for checkpoints and derived tables.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared filesystem or object
store).  Only when that setting is absent -- local runs and tests -- do we create one.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

_SUBDIR = "trailguard"


def build_session(master: str | None = None, app: str = "trailguard",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for local runs (tests, bench).  Cluster jobs pass their own builder settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder: ``spark.checkpoint.dir`` when the cluster names one.

    When it is unset (local mode, tests) a fresh folder is created and registered as the
    checkpoint directory so that ``DataFrame.checkpoint()`` works.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("trailguard.shared.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="trailguard-shared-")
        spark.conf.set("trailguard.shared.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base.rstrip("/") + "/checkpoints")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/{_SUBDIR}/{name}-{uuid.uuid4().hex[:12]}"


_SCOPE: ContextVar[list | None] = ContextVar("trailguard-scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes at its end the scratch tables that :func:`materialize` and :func:`stash` write inside it.

    Put a job with its final write (or collect) inside: frames that it made may read these tables and can't be used
    afterwards.  What is kept by design -- tables derived once per session, state and records of streams, files written
    to a path -- isn't scratch and stays.  Scopes nest, each with its own tables."""
    held: list = []
    token = _SCOPE.set(held)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        release(spark, held)


#: Spark 4.1 deletes an execution's shuffle files at its end where this is set; else they stay until the driver happens to
#: collect its garbage.  Frames that run again plan their shuffles anew.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Shuffle files of the writes and other actions inside go when each has ended."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


def _write(df, path: str) -> None:
    with shuffles_released(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def materialize(df, name: str = "stage", keep: bool = False):
    """Cut lineage by writing ``df`` as Parquet under the shared folder and reading it back.

    Survives executor loss (the files are on shared storage) and, unlike an RDD checkpoint,
    keeps column pruning and filter pushdown for the readers.  With ``keep`` the table outlives the
    :func:`scratch_scope` it is written in."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    held = _SCOPE.get()
    if held is not None and not keep:
        held.append(path)
    _write(df, path)
    return spark.read.parquet(path)


def stash(df, name: str, cache: list | None = None):
    """Reuse point for a frame read several times: written to the shared folder (:func:`materialize`), which
    also keeps plans short.  With ``cache`` the table's path is appended to it, for the caller to
    :func:`release` when the work that reads it is done."""
    if cache is None:
        return materialize(df, name)
    path = scratch_path(df.sparkSession, name)
    cache.append(path)
    _write(df, path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession, cache: list) -> None:
    """Delete the scratch tables (paths) and drop the persisted frames that ``cache`` holds."""
    root = f"{shared_dir(spark)}/{_SUBDIR}/"
    for held in cache:
        if not isinstance(held, str):
            held.unpersist()
        elif held.startswith(root):          # only what scratch_path made
            path = spark._jvm.org.apache.hadoop.fs.Path(held)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    cache.clear()


_SHIPPED: set = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``trailguard`` importable in the Python workers (pandas UDFs, applyInPandas and
    the stream state function refer to it): zip the package once per SparkContext and add it
    with ``addPyFile`` -- what ``spark-submit --py-files`` does for a cluster job."""
    sc = spark.sparkContext
    key = sc.applicationId
    conf = sc.getConf()
    submitted = conf.get("spark.submit.pyFiles", "") or ""
    if "trailguard" in submitted or (conf.get("trailguard.ship.package", "true") or "").lower() == "false":
        return                      # already on the executors' path (spark-submit --py-files)
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg = Path(__file__).resolve().parent
        fd, zpath = tempfile.mkstemp(prefix="trailguard-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(f for f in pkg.rglob("*") if f.suffix in (".py", ".txt")):
                z.write(f, str(f.relative_to(pkg.parent)))
        sc.addPyFile(zpath)
        _SHIPPED.add(key)
