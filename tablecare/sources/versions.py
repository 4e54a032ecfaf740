"""A table that is replaced as a whole and never seen empty or half-written.

Each version is written into a folder of its own; only when all its files are
committed is a pointer made: an empty file ``_current/<number>-<version>`` whose
name says all, so that it is there or not, on any file system that Spark can
write to. Readers take the pointer of the highest number. A write that breaks
leaves the earlier version current; an old one goes only after a grace period,
so that readers who have resolved it can finish.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

POINTERS, VERSIONS = "_current", "versions"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, modification time in seconds) of what lies in a folder; none if it is missing."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)]


def _pointers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    names = [n for n, _ in _children(spark, f"{root}/{POINTERS}") if "-" in n and not n.startswith(".")]
    return sorted((int(n.split("-")[0]), n.split("-", 1)[1]) for n in names)


def write_version(df: DataFrame, root: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                  options: dict | None = None) -> str:
    """Write a version; it is not current before ``commit_version``."""
    version = uuid.uuid4().hex
    df.write.format(fmt).options(**(options or {})).partitionBy(*partition_by).save(
        f"{root}/{VERSIONS}/{version}")
    return version


def commit_version(spark: SparkSession, root: str, version: str) -> None:
    """Make a written version the current one. Of two commits at once, one number has two pointers
    and the greater name counts: readers agree, and the other stays complete."""
    if not exists(spark, f"{root}/{VERSIONS}/{version}/_SUCCESS"):
        raise ValueError(f"version {version} is not complete")
    number = max((n for n, _ in _pointers(spark, root)), default=0) + 1
    fs, p = _path(spark, f"{root}/{POINTERS}/{number:012d}-{version}")
    fs.create(p, False).close()


def current_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the current version; None where nothing has been committed."""
    pointers = _pointers(spark, root)
    return f"{root}/{VERSIONS}/{pointers[-1][1]}" if pointers else None


def remove_old_versions(spark: SparkSession, root: str, grace_seconds: float = 24 * 3600) -> int:
    """Delete versions (broken writes too) older than the grace period; the current one stays."""
    pointers = _pointers(spark, root)
    current = pointers[-1][1] if pointers else None
    limit, removed = time.time() - grace_seconds, 0
    for name, changed in _children(spark, f"{root}/{VERSIONS}"):
        if name == current or changed > limit:
            continue
        for number, version in pointers:       # the pointer first, so that it never points nowhere
            if version == name:
                fs, p = _path(spark, f"{root}/{POINTERS}/{number:012d}-{version}")
                fs.delete(p, False)
        fs, p = _path(spark, f"{root}/{VERSIONS}/{name}")
        fs.delete(p, True)
        removed += 1
    return removed
