"""Session builder for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

from blockpulse.sources.files import delete

_LOCAL_SCRATCH: dict[str, str] = {}
#: Paths handed out and not yet deleted, by application.
_HANDED_OUT: dict[str, list[str]] = {}


def local_session(cores: str = "*", app: str = "blockpulse") -> SparkSession:
    """A single-JVM session for tests and benchmarks. A cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="blockpulse-wh-"))
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees: `spark.checkpoint.dir`, named by the cluster.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="blockpulse-")
    return _LOCAL_SCRATCH[app]


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; `scratch_run` deletes what is written there."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was written to shared paths meanwhile.

    Frames that read those paths end with the run, so collect or write a result inside it.
    """
    handed_out = _HANDED_OUT.setdefault(spark.sparkContext.applicationId, [])
    before = len(handed_out)
    try:
        yield
    finally:
        for path in handed_out[before:]:
            delete(spark, path)
        del handed_out[before:]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, as `--py-files` does, for sessions started without it."""
    home = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="blockpulse-ship-"), "blockpulse.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    spark.sparkContext.addPyFile(archive)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{shared_root(spark)}/checkpoints")
