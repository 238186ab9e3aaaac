"""Session and shared-storage helpers.

Jobs never pick a scratch folder on their own: durable intermediate data goes
under the folder the cluster names in ``spark.checkpoint.dir``. Where that is
absent they raise; local runs name a folder first (``name_local_folder``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "roadframe", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster, use the provided one."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # delete checkpoint files once nothing references them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The configured checkpoint folder itself (``spark.checkpoint.dir``),
    stable across applications. Spark's own checkpoint dir is a random
    per-application folder below it. Raises if the setting is absent: a folder
    picked here would lie on one machine, and other executors cannot read it."""
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext
        sc = None
    configured = sc.getConf().get(_CHECKPOINT_KEY, None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get(_CHECKPOINT_KEY)
        except Exception:  # not set in the SQL conf either
            configured = None
    if configured:
        return configured
    current = sc.getCheckpointDir() if sc is not None else None
    if current:  # set with sc.setCheckpointDir(dir): Spark adds one folder per application
        return current.rstrip("/").rsplit("/", 1)[0]
    raise RuntimeError(
        "spark.checkpoint.dir is not set: set it to a folder on shared storage "
        "(HDFS, S3, ...) that every executor and the driver can read")


def name_local_folder(spark: SparkSession) -> None:
    """For a local run (one machine, one process) without the setting: use a
    new temporary folder. Does nothing on any cluster or where a folder is set."""
    sc = spark.sparkContext
    unset = not sc.getConf().get(_CHECKPOINT_KEY, None) and not sc.getCheckpointDir()
    if unset and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(os.path.join(tempfile.mkdtemp(prefix="roadframe-"), "checkpoints"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Spark's checkpoint dir for ``DataFrame.checkpoint()`` (registered from
    ``checkpoint_root`` when not yet set)."""
    root = checkpoint_root(spark)
    try:
        sc = spark.sparkContext
    except Exception:
        return root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


#: bytecode of a method from which on HotSpot interprets it instead of compiling it
_JIT_LIMIT = 8000
_METHOD_LIMIT_KEY = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """For wide projections that run within the block: a stage whose generated
    method HotSpot would not compile (three times slower in the crash fixture's
    landing) runs without whole-stage code, as Spark's own setting for that
    does; its projections are then split into small methods. A lower limit of
    the session stays."""
    found = spark.conf.get(_METHOD_LIMIT_KEY)
    spark.conf.set(_METHOD_LIMIT_KEY, str(min(int(found), _JIT_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT_KEY, found)


def default_parallelism(spark: SparkSession) -> int:
    """Number of task slots of the cluster (cores), as Spark reports it."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", str(os.cpu_count() or 1)))


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder; the same for every
    application using that folder."""
    base = checkpoint_root(spark)
    return "/".join([base.rstrip("/"), *parts])


def fresh_shared_path(spark: SparkSession, prefix: str) -> str:
    """A new, unused scratch path in this application's folder below the
    shared checkpoint folder (Spark's per-application checkpoint dir), so
    one application's scratch can be removed as a whole."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/roadframe/{prefix}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
