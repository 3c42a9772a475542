"""A folder tree as a Spark data source, batch and stream.

``spark.read.format("filetree")`` lists the files below a folder,
``spark.readStream.format("filetree")`` those that arrive in it. Rows are
path, length and modification time; register the source once a session with
``register``.
"""

from __future__ import annotations

import os
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition,
                                    StringStartsWith)

FORMAT = "filetree"
SCHEMA = "path string, length bigint, modificationTime timestamp"
PLAN_FOLDERS = 256  # folders at which planning stops opening further ones
LOOKED_AT = 1024     # entries of a local folder that are held at a time


@dataclass
class _Share(InputPartition):
    """A task's part of the tree. Of the entries of ``folder`` it takes those
    whose name falls into ``part`` of ``parts``, folders with all below them
    unless ``deep`` is false, modified in [since, until)."""
    folder: str
    deep: bool = True
    part: int = 0
    parts: int = 1
    since: int = 0
    until: int | None = None


def _entries(folder: str, keep=lambda name: True):
    """Names, kinds, sizes and times of a folder's entries whose name is to be
    kept; none for a folder that is gone since. A local folder is read in runs
    of LOOKED_AT entries, whatever it holds; other stores give theirs at once."""
    from pyarrow import fs
    from vellum.sources.storage import filesystem
    system, at = filesystem(folder)
    if not isinstance(system, fs.LocalFileSystem):
        yield from (e for e in system.get_file_info(fs.FileSelector(at, allow_not_found=True)) if keep(e.base_name))
        return
    try:
        found = os.scandir(at or "/")
    except FileNotFoundError:
        return
    with found:
        names = (e.name for e in found if keep(e.name))
        while run := list(islice(names, LOOKED_AT)):
            # an entry that went meanwhile is of no kind
            yield from (e for e in system.get_file_info([_below(at, n) for n in run]) if e.type != fs.FileType.NotFound)


def _below(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def _may_hold(folder: str, prefix: str) -> bool:
    """Whether a folder can hold paths that start with ``prefix``."""
    inside = folder.rstrip("/") + "/"
    return inside.startswith(prefix) or prefix.startswith(inside)


def plan(root: str, prefix: str = "", limit: int = PLAN_FOLDERS) -> list[_Share]:
    """Shares that cover the tree once. Folders are opened breadth first until
    ``limit`` are known; each further one is a share with all below it. A
    folder with more than ``limit`` folders in it is cut by a hash of its
    entries' names instead, ``limit`` parts in all such folders together (two
    each at least), so that the driver never holds more than ``limit`` squared
    names whatever the tree is."""
    from pyarrow import fs
    ready, wide, waiting = [], [], [root.rstrip("/") or "/"]
    while waiting and len(ready) + len(wide) + len(waiting) < limit:
        folder = waiting.pop(0)
        inner = (_below(folder, e.base_name) for e in _entries(folder) if e.type == fs.FileType.Directory)
        inner = list(islice((f for f in inner if _may_hold(f, prefix)), limit + 1))
        if len(inner) > limit:
            wide.append(folder)
        else:
            ready.append(_Share(folder, False))
            waiting += inner
    parts = max(2, limit // max(1, len(wide)))
    return ready + [_Share(f) for f in waiting] + [_Share(f, True, k, parts) for f in wide for k in range(parts)]


def read_share(share: _Share, ending: str = "", prefix: str = "") -> Iterator[tuple]:
    """The files of a share, folder by folder. A folder's entries are read as
    they are needed: what is held is one run of them for each level."""
    from pyarrow import fs

    def own(name: str) -> bool:
        return zlib.crc32(name.encode("utf-8", "surrogateescape")) % share.parts == share.part
    open_ = [(share.folder, _entries(share.folder, own) if share.parts > 1 else _entries(share.folder))]
    while open_:
        folder, entries = open_[-1]
        e = next(entries, None)
        if e is None:
            open_.pop()
            continue
        path = _below(folder, e.base_name)
        if e.type == fs.FileType.Directory:
            if share.deep and _may_hold(path, prefix):
                open_.append((path, _entries(path)))
        elif e.type == fs.FileType.File and path.startswith(prefix) and path.lower().endswith(ending):
            if share.until is None or share.since <= e.mtime_ns < share.until:
                yield path, e.size, e.mtime


class _TreeReader(DataSourceReader):
    def __init__(self, root: str, ending: str):
        self.root, self.ending, self.prefix = root, ending, ""

    def pushFilters(self, filters):
        """Path filters decide which folders are opened. All filters are
        handed back, so Spark tests the rows as well."""
        for f in filters:
            if isinstance(f, (StringStartsWith, EqualTo)) and f.attribute == ("path",) and isinstance(f.value, str):
                if len(f.value) > len(self.prefix):
                    self.prefix = f.value
            yield f

    def partitions(self):
        return plan(self.root, self.prefix)

    def read(self, partition):
        return read_share(partition, self.ending, self.prefix)


class _TreeStreamReader(DataSourceStreamReader):
    """Offsets are modification times in nanoseconds: a batch holds the files
    modified between two of them."""

    def __init__(self, root: str, ending: str, settle: float):
        self.root, self.ending, self.settle = root, ending, settle

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() - int(self.settle * 1e9)}

    def partitions(self, start: dict, end: dict):
        shares = plan(self.root)
        for share in shares:
            share.since, share.until = start["until"], end["until"]
        return shares

    def read(self, partition):
        return read_share(partition, self.ending)


class FileTree(DataSource):
    """Options: ``path``, the folder (a path or URI that driver and executors
    share); ``ending``, an ending that paths must have in either case (default:
    any); ``settle``, for streams, the seconds after which a file counts as
    written whole (default 1).

    Hidden and empty files count; a folder that does not exist is an empty one;
    names may hold any characters. Filters on the start of ``path`` or its
    value keep other folders shut. The driver lists only the top of the tree
    (``plan``). A stream takes a file when its modification time falls into a
    batch: one that is changed comes again with its new time, and one moved in
    with a time before the last offset does not come; ``unseen`` over a batch
    listing finds those.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _args(self) -> tuple[str, str]:
        root = self.options.get("path")
        if not root:
            raise ValueError("filetree needs a path")
        return root, self.options.get("ending", "").lower()

    def reader(self, schema):
        return _TreeReader(*self._args())

    def streamReader(self, schema):
        return _TreeStreamReader(*self._args(), float(self.options.get("settle", "1")))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let the session hand filters
    to Python sources, without which Spark refuses a reader that takes them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FileTree)


def list_tree(spark: SparkSession, root: str, ending: str = ""):
    """Batch listing of the files below ``root``."""
    register(spark)
    return spark.read.format(FORMAT).option("ending", ending).load(root)


def stream_tree(spark: SparkSession, root: str, ending: str = "", settle: float = 1.0):
    """The files below ``root`` as a stream."""
    register(spark)
    return spark.readStream.format(FORMAT).option("ending", ending).option("settle", str(settle)).load(root)
