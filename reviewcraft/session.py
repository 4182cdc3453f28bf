"""Session defaults and the shared working folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of one Arrow batch for a Python worker, which holds a few copies of it.
BATCH_BYTES = 8 << 20


def get_session(app_name: str = "reviewcraft", **conf: str) -> SparkSession:
    """A session for the jobs; cluster-wide settings win over what is passed here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Python functions are pickled by reference, so workers must be able to import it even
    if only the driver has it on its path.
    """
    _shipped(spark.sparkContext.applicationId)
    return spark


@functools.cache
def _shipped(application_id: str) -> str:
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="reviewcraft-ship-"), "reviewcraft-package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    SparkSession.active().sparkContext.addPyFile(target)
    return target


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes too: a number of rows alone lets long texts fill a worker."""
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session may do without the setting; it then gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} is not set: no shared folder to write to")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="reviewcraft-")


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    found = _file_system(spark, path).listStatus(_hadoop_path(spark, path))
    return [status.getPath().getName() for status in found]


def list_files(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """Data files in a folder: path, name as in an address, and a mark that changes with the file."""
    if not path_exists(spark, path):
        return []
    found = []
    for status in _file_system(spark, path).listStatus(_hadoop_path(spark, path)):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            mark = f"{name}:{status.getLen()}:{status.getModificationTime()}"
            address = status.getPath().toUri().toASCIIString()
            found.append((status.getPath().toString(), address.rsplit("/", 1)[-1], mark))
    return sorted(found)


def delete_path(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def plain_path(spark: SparkSession, address: str) -> str:
    """The path that an address (``DataFrame.inputFiles``) stands for."""
    return _address(spark, address).toString()


def file_size(spark: SparkSession, path: str) -> int:
    return _file_system(spark, path).getFileStatus(_hadoop_path(spark, path)).getLen()


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; if only the target exists, that was done before."""
    start, end = _hadoop_path(spark, source), _hadoop_path(spark, target)
    system = _file_system(spark, source)
    if not system.exists(start):
        if not system.exists(end):
            raise FileNotFoundError(source)
        return
    system.mkdirs(end.getParent())
    if not system.rename(start, end):
        raise OSError(f"cannot move {source} to {target}")


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    system = _file_system(spark, source)
    if not system.rename(_hadoop_path(spark, source), _hadoop_path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it exists."""
    out = _file_system(spark, path).create(_hadoop_path(spark, path), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_hadoop_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _address(spark: SparkSession, path: str):
    """A path from an address, in which odd characters are escaped."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(_conf(spark))
