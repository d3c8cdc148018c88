"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

T = TypeVar("T")

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.statistics.fallBackToHdfs": "true",
    # HotSpot never compiles a longer method; past it Spark generates code per operator, in short methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "viagrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots.

    Shuffle width and executor sizes are left to the cluster; AQE coalesces
    whatever initial partition number the cluster sets.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def short_methods(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the limit on generated methods from ``DEFAULTS``.

    Casting a dozen text columns in one stage makes a method over the limit,
    which the JVM would interpret for every row.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, DEFAULTS[name])


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], T]], most: int = 4) -> list[T]:
    """Results of independent Spark jobs, some submitted at a time.

    Tasks of the next job fill the cores that a stage with few or uneven tasks
    leaves idle. The first error, in the order of the jobs, is raised when those
    that run have ended; the others are not begun.
    """
    with ThreadPoolExecutor(most) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        try:
            return [job.result() for job in begun]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies in the shared folder that the cluster names in
    ``spark.checkpoint.dir``, so it outlives any executor. Only a local session
    without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="viagrid-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """A path with its file system, whichever Hadoop knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, system = _located(spark, path)
    return system.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove what a run has written for itself; nothing happens where there is nothing."""
    place, system = _located(spark, path)
    if system.exists(place):
        system.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    place, system = _located(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _located(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False if there is one of that name, which stays as it is."""
    folder, _, name = path.rpartition("/")
    hadoop = spark._jvm.org.apache.hadoop.fs
    place, system = _located(spark, path)
    draft = hadoop.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    context = hadoop.FileContext.getFileContext(system.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration())
    kept = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(place), kept)
        return True
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
