"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Semantics, not tuning: instants are UTC and arithmetic errors are loud.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Let the runtime choose join strategies, split skewed joins and size partitions.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Plans are built from many small expressions; recording a call site for each of them
# takes longer than building them.
DRIVER = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is for local runs; on a cluster it comes from spark-submit.
    Extra settings are passed with dots written as double underscores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **ADAPTIVE, **DRIVER}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Put a session that was created elsewhere on UTC."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started from; once per session is enough."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parent
    if getattr(context, "_tidewatch_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="tidewatch-package-")) / "tidewatch.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    context._tidewatch_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``checkpoint()``: the cluster's own, else one for local tests.

    A machine-local folder would be lost with its machine, so it is only used
    where the whole session is one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-checkpoint-"))
    return context.getCheckpointDir()


_SCRATCH: ContextVar[str | None] = ContextVar("tidewatch_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for what ``stored`` writes during one run, removed when the run ends or fails.

    It is part of the shared checkpoint folder.  Frames made inside must not be used after the block.
    """
    path = f"{_SCRATCH.get() or ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once to the shared checkpoint folder and read it back.

    For results that several branches use: the branches start from a columnar
    table with known size instead of repeating the scan of the sources, and a
    lost executor costs nothing but its own tasks.  Inside ``scratch`` it goes to the folder of that run.
    """
    spark = frame.sparkSession
    path = f"{_SCRATCH.get() or ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
