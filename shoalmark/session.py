"""Session settings, the shared scratch folder, and tables staged in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_FITTING_BYTES = 4 * 1024 ** 3
_scratch: list[str] = []  # paths this process has made in the shared folder
_shipped: set[str] = set()  # applications whose workers have the package


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results depend on: timestamps are read and shown in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session may fall back to a folder of its own; on a cluster a
    folder of the driver's machine would be invisible to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shoalmark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, until ``release_staged``."""
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner real file
    sizes. Used where one result feeds several later steps.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete what this process has put below the shared folder so far, staged tables and other
    scratch files alike, and return how many paths there were.

    Frames built on them can no longer be read; call it when their results are written.
    """
    jvm, count = spark._jvm, 0
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        count += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers, which import what tasks call.

    Spark hands the archive to the executors itself, so it may lie on the driver alone; it stays
    there until the driver ends, as executors that start later ask for it too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, folder = Path(__file__).resolve().parent, tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes a broadcast side may take: ``spark.shoalmark.broadcastBytes`` if set."""
    return int(spark.conf.get("spark.shoalmark.broadcastBytes", str(DEFAULT_BROADCAST_BYTES)))


def fitting_budget(spark: SparkSession) -> int:
    """Bytes that models fitted side by side may hold in all executors: ``spark.shoalmark.fittingBytes`` if set."""
    return int(spark.conf.get("spark.shoalmark.fittingBytes", str(DEFAULT_FITTING_BYTES)))
