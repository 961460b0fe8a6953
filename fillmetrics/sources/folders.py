"""Names of folders and their removal, through the session's own file-system connectors.

Spark's readers list files. Which folders there are, without what is in them, is one request per parent here.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Folder:
    """``modified`` is None where the store keeps no time for folders."""

    name: str
    path: str
    modified: datetime | None


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def subfolders(spark: SparkSession, path: str) -> list[Folder]:
    """Folders directly below ``path``; none where it does not exist."""
    files, place = _opened(spark, path)
    if not files.exists(place):
        return []
    found = []
    for entry in files.listStatus(place):
        if entry.isDirectory():
            millis = entry.getModificationTime()
            changed = datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None) if millis > 0 else None
            found.append(Folder(entry.getPath().getName(), entry.getPath().toString(), changed))
    return sorted(found, key=lambda folder: folder.name)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        files, place = _opened(spark, path)
        files.delete(place, True)
