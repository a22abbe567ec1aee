"""Session settings the operators rely on, and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tributary.sinks.files import delete

_local_folder: str | None = None
_shipped: set[str] = set()
_scopes = threading.local()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the two session options results depend on: UTC, and last-wins for repeated JSON keys."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where driver and executors are one process.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tributary-")
    return _local_folder


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tributary/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, what this thread staged inside; results must be written by then."""
    outer, mine = getattr(_scopes, "paths", None), []
    _scopes.paths = mine
    try:
        yield
    finally:
        _scopes.paths = outer
        for path in mine:
            delete(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, and lets every later reader prune columns.
    """
    path = staging_path(df.sparkSession, label)
    if getattr(_scopes, "paths", None) is not None:
        _scopes.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).parent
    if not package.is_dir():  # imported from an archive the workers have already
        return
    archive = Path(tempfile.mkdtemp(prefix="tributary-")) / "tributary.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
