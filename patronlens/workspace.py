"""Session settings and the shared folder that stage tables are written to."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Exchanges of a finished write are not needed again; without this they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()
_shipping_lock = threading.Lock()
# One entry per write under way: the setting before the first of them.
_writing: list[str | None] = []
_writing_lock = threading.Lock()
# What to forget when the written tables go.
on_clear: list[Callable[[], None]] = []


def build_session(master: str | None = None, app: str = "patronlens", **settings) -> SparkSession:
    """A session with adaptive execution on. On a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session may do without that setting; it gets a folder of its own.
    """
    app = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="patronlens-")
        named = _local_folders[app]
    return f"{named.rstrip('/')}/patronlens/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and go on from the written table.

    The lineage ends at the files, so a lost executor costs a re-read and not a
    recomputation, and rows keep the positions they were written with.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _freeing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def even_tasks(rows: int, parallelism: int, least: int, most: int = 4_000_000) -> int:
    """Tasks for a table that many passes go over: few for a small one, else the same number for every core."""
    if rows < parallelism * least:
        return max(1, -(-rows // least))
    return parallelism * -(-rows // (parallelism * most))


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Writes free their exchanges. Of writes side by side the first sets this and the last takes it back."""
    with _writing_lock:
        if not _writing:
            _writing.append(spark.conf.get(_CLEANUP, None))
            spark.conf.set(_CLEANUP, "true")
        else:
            _writing.append(_writing[0])
    try:
        yield
    finally:
        with _writing_lock:
            before = _writing.pop()
            if not _writing:
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A table of a few driver values as one literal, so that no Python runs on the executors."""
    names = [field.split()[0] for field in schema.split(", ")]
    typed = ",".join(":".join(field.split()) for field in schema.split(", "))
    text = json.dumps([dict(zip(names, row)) for row in rows])
    parsed = F.explode(F.from_json(F.lit(text), f"array<struct<{typed}>>"))
    return spark.range(0, 1, 1, 1).select(parsed.alias("_r")).select("_r.*")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that batch functions can import it there. Once per application.

    Fits may run side by side: Spark refuses a second archive of the same name.
    """
    app = spark.sparkContext.applicationId
    with _shipping_lock:
        if app not in _shipped:
            root = os.path.dirname(os.path.abspath(__file__))
            # Only the driver's file server reads the archive.
            archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{os.path.basename(root)}", "zip", os.path.dirname(root), os.path.basename(root))
            spark.sparkContext.addPyFile(archive)
            _shipped.add(app)


def clear_workspace(spark: SparkSession) -> None:
    """Remove the stage tables this application wrote. Frames read from them end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for forget in on_clear:
        forget()
