"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Rows handed to a Python resolver in one call.
CALL_ROWS = 1000

# Intermediate paths of each session, by application.
_written: dict[str, list[str]] = {}


def _cores(master: str) -> str:
    """Cores of a local master; elsewhere Spark's default of all cores is kept."""
    found = re.match(r"local\[(\d+)", master)
    return found[1] if found else str(os.cpu_count() or 1)


def build_session(master: str = "local[8]", app: str = "tablerich", **conf: str) -> SparkSession:
    """A session with the settings the engine expects; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # A scan of long texts has a task for every core, whatever the number of files.
        "spark.sql.files.minPartitionNum": _cores(master),
        "spark.sql.files.openCostInBytes": "262144",
        # No Python stack trace per column: it takes most of the time of building a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def separate_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Another session of the application: the settings of ``spark`` and, on top, these, which ``spark`` does not see."""
    other = spark.newSession()
    known = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.") and other.conf.isModifiable(k)}
    for key, value in (known | settings).items():
        other.conf.set(key, value)
    return other


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Without the setting, the folder of ``SparkContext.setCheckpointDir``. Only a master of one process (``local[…]``),
    as in tests, may have neither; it then gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="scratch-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.removeprefix("file:") if configured.startswith("file:/") and not configured.startswith("file://") else configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``clear_scratch`` deletes what is written there."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate paths of this session; DataFrames that read them end with it. Returns how many there were."""
    removed = 0
    written = _written.pop(spark.sparkContext.applicationId, [])
    while written:
        path = spark._jvm.org.apache.hadoop.fs.Path(written.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def cut_lineage(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The rows then no longer depend on how or how often they are computed, and survive the loss of any
    executor. ``clear_scratch`` deletes the table when it is no longer needed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
