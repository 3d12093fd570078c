"""Folders seen through the session's own Hadoop file system: listing, deleting and the
pointer file of a versioned table.  Listings here are of day folders and version folders,
never of data files."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import SparkSession

_DAY = re.compile(r"^dt=(\d{4}-\d{2}-\d{2})$")
POINTER = "_current"


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    jpath, fs = _path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def day_folders(spark: SparkSession, path: str) -> list[date]:
    """Days that have a ``dt=`` folder, in order."""
    days = []
    for name in folders(spark, path):
        match = _DAY.match(name)
        if match:
            days.append(date.fromisoformat(match.group(1)))
    return days


def delete_folder(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.delete(jpath, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    jpath, fs = _path(spark, path)
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def new_version(root: str) -> str:
    """Path of a version folder that does not exist yet."""
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"


def get_text(spark: SparkSession, root: str, name: str) -> str | None:
    """Content of a small text file below ``root``, if there is one."""
    jpath, fs = _path(spark, f"{root.rstrip('/')}/{name}")
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, root: str, name: str, text: str) -> None:
    """Write a small text file by renaming a finished draft over it; readers see the old
    content or the new, never a mix."""
    jvm = spark._jvm
    target, fs = _path(spark, f"{root.rstrip('/')}/{name}")
    draft, _ = _path(spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(draft, target, options)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version folder that the pointer names, if there is one."""
    text = get_text(spark, root, POINTER)
    return f"{root.rstrip('/')}/{text.strip()}" if text is not None else None


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one."""
    put_text(spark, root, POINTER, version.rstrip("/").rsplit("/", 1)[-1])


def folders_by_age(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, oldest first."""
    jpath, fs = _path(spark, path)
    found = [s for s in fs.listStatus(jpath) if s.isDirectory()]
    found.sort(key=lambda s: s.getModificationTime())
    return [s.getPath().getName() for s in found]
