"""Tables that stay readable while they are replaced.

``<folder>/<table>/data-<id>`` holds the files of one snapshot, and an empty file ``_published-<number>-<id>`` beside it
makes that snapshot the current one: the highest number counts. The data is written and committed first, the marker is
created last, in one step on any file system. A write that fails or is killed leaves a folder without a marker, which no
reader looks at. Readers hold on to the folder they have found, so the last KEPT snapshots are not removed.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Published snapshots that stay for readers that have begun with them.
KEPT = 3
#: Folders without a marker are those of running writes, or of failed ones if they are older.
ABANDONED_SECONDS = 24 * 3600

_MARKER = re.compile(r"_published-(\d{12})-([0-9a-f]{32})$")
_DATA = re.compile(r"data-([0-9a-f]{32})$")


class SnapshotMissing(FileNotFoundError):
    """Nothing has been published under this name."""


class _Folder:
    """The files of a table's folder, on whatever file system it lies."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root, self._path = root, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.files = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def entries(self) -> dict[str, float]:
        """Names with their times of modification, in seconds."""
        root = self._path(self.root)
        if not self.files.exists(root):
            return {}
        return {e.getPath().getName(): e.getModificationTime() / 1000 for e in self.files.listStatus(root)}

    def create(self, name: str) -> None:
        self.files.create(self._path(self.root, name), False).close()

    def remove(self, name: str) -> None:
        self.files.delete(self._path(self.root, name), True)


def _published(names) -> list[tuple[int, str]]:
    """(number, id) of the published snapshots, oldest first."""
    found = [_MARKER.match(name) for name in names]
    return sorted((int(m[1]), m[2]) for m in found if m)


def publish(rows: DataFrame, folder: str, table: str, kept: int = KEPT) -> str:
    """Write the rows as the table's new snapshot and return the folder of its files, which never changes again.

    Of two writers at the same time the one that ends last wins; each snapshot is whole.
    """
    here, own = _Folder(rows.sparkSession, f"{folder}/{table}"), uuid.uuid4().hex
    path = f"{here.root}/data-{own}"
    rows.write.option("compression", "zstd").parquet(path)  # hashed keys shrink by their digits' entropy only
    published = _published(here.entries())
    here.create(f"_published-{published[-1][0] + 1 if published else 1:012d}-{own}")
    _clean(here, kept)
    return path


def _clean(here: _Folder, kept: int) -> None:
    entries = here.entries()
    published = _published(entries)
    for number, own in published[:-kept]:
        here.remove(f"_published-{number:012d}-{own}")  # first, so that no reader finds it any more
        here.remove(f"data-{own}")
    known = {own for _, own in published}
    for name, changed in entries.items():
        data = _DATA.match(name)
        if data and data[1] not in known and changed < time.time() - ABANDONED_SECONDS:
            here.remove(name)


def current(spark: SparkSession, folder: str, table: str) -> str:
    """The folder of the table's current snapshot."""
    published = _published(_Folder(spark, f"{folder}/{table}").entries())
    if not published:
        raise SnapshotMissing(f"no snapshot of {table} in {folder}")
    return f"{folder}/{table}/data-{published[-1][1]}"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The table's current snapshot; later ones don't change what the frame reads."""
    return spark.read.parquet(current(spark, folder, table))
