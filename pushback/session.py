"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Session settings this library relies on. AQE re-plans joins at runtime:
# a shuffled side that turns out small becomes a broadcast (the size check is
# the measured shuffle output, with sort-merge as the fallback beyond it), and
# skewed sort-merge partitions are split.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a whole-stage method above HotSpot's limit of 8000 bytecodes is never JIT
    # compiled, and one near it late and badly (a row of 54 columns); such wide
    # stages fall back to per-operator codegen, which splits its methods
    "spark.sql.codegen.hugeMethodLimit": "2000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES_LOCK = Lock()
_WRITES: list[int] = []
_SET_BEFORE: list[str] = []


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pushback") -> SparkSession:
    """Session for tests and local benchmarks (the cluster supplies its own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    make_importable(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; a local folder is only
    set when the setting is absent, which is the case in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="pushback-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose nodes lack that path, ship it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What begins here leaves no shuffle files when it ends; the setting is put back
    once no other thread's write needs it."""
    with _WRITES_LOCK:
        if not _WRITES:
            _SET_BEFORE[:] = [spark.conf.get(SHUFFLE_CLEANUP, "false")]
        _WRITES.append(1)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _WRITES_LOCK:
            _WRITES.pop()
            if not _WRITES:
                spark.conf.set(SHUFFLE_CLEANUP, _SET_BEFORE[0])


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    The lineage is cut (a lost executor re-reads files instead of recomputing
    the stage), and later reads get column pruning and filter pushdown, which
    an RDD checkpoint of serialised rows would not. The shuffle files of the
    write go with its end, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # a table without rows may have no file


def drop_stage(df: DataFrame) -> None:
    """Delete the table that ``cut_lineage`` wrote for ``df``, once nothing reads it any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 2)[-2] == "tables":
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
