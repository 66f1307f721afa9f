"""Session helpers: building a local session for tests/bench, and the shared
scratch folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package is written against. AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is small) and
# splits skewed shuffle partitions; they are safe defaults on a cluster too.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ordstar", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's
    own session and only make sure ``spark.checkpoint.dir`` is set."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for written intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session without one gets a fresh temporary folder; a cluster
    session must name a shared folder itself.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        conf_dir = tempfile.mkdtemp(prefix="ordstar-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables written inside the scope when it ends. For jobs
    whose results are written elsewhere by then: nothing lazy may leave the scope."""
    first = len(_MADE)
    try:
        yield
    finally:
        _drop(spark, _MADE[first:])
        del _MADE[first:]


def _drop(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


#: Runtime setting of Spark: the shuffle files of an execution go when it ends.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Each write and action inside deletes its shuffle files when it ends. Without this
    they stay until the driver happens to collect its garbage, so that a job of many
    steps keeps the files of all of them."""
    old = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if old is None else spark.conf.set(_FREE, old)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing a
    shuffle whose partition bounds could change) and pins every derived value
    (partition ids, sequence numbers) so later jobs see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def keep_result(make: Callable[[], DataFrame]) -> DataFrame:
    """``make()``, and the scratch tables written inside it that its result does not read
    are deleted."""
    first = len(_MADE)
    out = make()
    read = {f.rsplit("/", 2)[-2] for f in out.inputFiles()}
    gone = [path for path in _MADE[first:] if path.rsplit("/", 1)[-1] not in read]
    _drop(out.sparkSession, gone)
    _MADE[first:] = [path for path in _MADE[first:] if path not in gone]
    return out


def materialize_only(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``materialize(make())``; the scratch tables written inside ``make`` are deleted."""
    return keep_result(lambda: materialize(make(), name))


def bytes_conf(spark, key: str, default: int) -> int:
    raw = spark.conf.get(key, str(default))
    try:
        return int(raw)
    except ValueError:
        return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw))


def broadcast_limit(spark) -> int:
    return bytes_conf(spark, "spark.sql.autoBroadcastJoinThreshold", 10485760)


def size_in_bytes(df: DataFrame) -> int:
    """The planner's size estimate (file sizes for a written table)."""
    v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return v if isinstance(v, int) else int(v.toString())


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ordstar`` importable in Python workers (needed by the
    ``mapInPandas`` steps): zip the package once and ``addPyFile`` it, so
    executors get it from Spark regardless of their working directory."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="ordstar-py-"), "ordstar.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
