"""Object listing as a data source, in batch and as a stream.

    spark.dataSource.register(ObjectListing)
    spark.read.format("sluice_objects").option("root", "s3://bucket").load()
    spark.readStream.format("sluice_objects").option("root", "s3://bucket").load()

Keys are ``prefix/serial/yyyy/mm/dd/name``.  The planner lists the store two levels down (serial and
year, or what stands in their place); each folder found is a partition, whose objects an executor lists.  The stream's
offset is the time up to which modifications have been listed: a batch holds the objects, new or
replaced, that were modified since the last one.  ``lookback_days`` leaves out folders of days that far
before the last offset, which can only hold objects replaced in place.

The store is any file system of ``pyarrow.fs``; its clients run where the listing runs.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import sys
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "sluice_objects"
SCHEMA = "object_key string, version_token string, size long, last_modified timestamp"
# Folder levels the planner lists.
PLANNED_LEVELS = 2
_ROWS = 20_000
_DAY = re.compile(r"^(\d{4})(?:/(\d{2})(?:/(\d{2}))?)?$")


def open_store(root: str):
    """(file system, path) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root.rstrip("/") or "/")


def _entries(store, folder: str):
    from pyarrow import fs

    found = store.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))
    return [f for f in found if f.type == fs.FileType.Directory], [f for f in found if f.type == fs.FileType.File]


def last_day(under: str) -> dt.date | None:
    """Last day a folder can hold, by its path below the serial (``2026``, ``2026/04`` or ``2026/04/22``);
    None if the path names no date."""
    m = _DAY.match(under)
    if not m:
        return None
    year, month, day = (int(x) if x else None for x in m.groups())
    month = month or 12
    try:
        first = dt.date(year, month, day or 1)
        return first if day else dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)
    except ValueError:
        return None


class Listing:
    """What both readers share: the options, the folders and their objects."""

    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/")
        self.prefix = options.get("prefix", "log-gz/").strip("/")
        self.lookback = int(options["lookback_days"]) if options.get("lookback_days") else None
        self.settle_ms = int(options.get("settle_ms", 1000))
        self.overlap_ms = int(options.get("overlap_ms", 600_000))

    def first_day(self, since: int) -> dt.date | None:
        if self.lookback is None or since <= 0:
            return None
        return dt.datetime.fromtimestamp(since / 1000, dt.timezone.utc).date() - dt.timedelta(days=self.lookback)

    def _skips(self, key: str, first_day: dt.date | None) -> bool:
        """Whether a folder holds only days that are too old; ``key``: its path below the prefix."""
        day = last_day("/".join(key.split("/")[1:])) if first_day else None
        return day is not None and day < first_day

    def folders(self, since: int) -> list[tuple[str, bool]]:
        """(folder below the root, whether to list what is below it too)."""
        store, base = open_store(self.root)
        todo, out, first = [self.prefix], [], self.first_day(since)
        for _ in range(PLANNED_LEVELS):
            below = []
            for folder in todo:
                dirs, files = _entries(store, f"{base}/{folder}")
                out += [(folder, False)] * bool(files)
                below += [f"{folder}/{d.base_name}" for d in dirs]
            todo = [f for f in below if not self._skips(f[len(self.prefix) + 1:], first)]
        return out + [(f, True) for f in todo]

    def objects(self, folder: str, deep: bool, since: int, upto: int, seen: list | None = None) -> Iterator[pa.RecordBatch]:
        """Objects modified after ``since`` and not after ``upto`` (milliseconds), ``seen``: folders listed."""
        store, base = open_store(self.root)
        todo, rows, first = [folder], [], self.first_day(since)
        while todo:
            at = todo.pop()
            if seen is not None:
                seen.append(at)
            dirs, files = _entries(store, f"{base}/{at}")
            for f in files:
                ms = f.mtime_ns // 1_000_000
                if since < ms <= upto:
                    token = hashlib.md5(f"{f.size}:{ms}".encode()).hexdigest()
                    rows.append((f"{at}/{f.base_name}", token, f.size, ms * 1000))
            if deep:
                below = [f"{at}/{d.base_name}" for d in dirs]
                todo += [f for f in below if not self._skips(f[len(self.prefix) + 1:], first)]
            if len(rows) >= _ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    key, token, size, ms = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(token), pa.array(size, pa.int64()), pa.array(ms, pa.timestamp("us", "UTC"))],
        names=["object_key", "version_token", "size", "last_modified"])


class Folder(InputPartition):
    def __init__(self, folder: str, deep: bool, since: int, upto: int):
        self.folder, self.deep, self.since, self.upto = folder, deep, since, upto


class ListingReader(DataSourceReader):
    def __init__(self, listing: Listing):
        self.listing = listing

    def partitions(self):
        upto = int(time.time() * 1000)
        return [Folder(f, deep, -1, upto) for f, deep in self.listing.folders(-1)] or [Folder(self.listing.prefix, False, -1, -1)]

    def read(self, part: Folder) -> Iterator[pa.RecordBatch]:
        return self.listing.objects(part.folder, part.deep, part.since, part.upto)


class ListingStream(DataSourceStreamReader):
    """Offset: {"upto": milliseconds}.  An object that turns up with a time shortly before the last offset
    (a slow upload, another clock) is still listed: each batch looks ``overlap_ms`` further back.
    Objects may thus be listed twice; the checkpoint table knows them."""

    def __init__(self, listing: Listing):
        self.listing = listing

    def initialOffset(self) -> dict:
        return {"upto": -1}

    def latestOffset(self, *_) -> dict:
        return {"upto": int(time.time() * 1000) - self.listing.settle_ms}

    def partitions(self, start: dict, end: dict):
        since = max(start["upto"] - self.listing.overlap_ms, -1) if start["upto"] >= 0 else -1
        return [Folder(f, deep, since, end["upto"]) for f, deep in self.listing.folders(since)] or [Folder(self.listing.prefix, False, -1, -1)]

    def read(self, part: Folder) -> Iterator[pa.RecordBatch]:
        return self.listing.objects(part.folder, part.deep, part.since, part.upto)

    def commit(self, end: dict) -> None:
        pass


class ObjectListing(DataSource):
    """Options: ``root``; ``prefix`` (log-gz/); ``lookback_days`` (all folders); for the stream also
    ``settle_ms`` (1000): modifications younger than that wait for the next batch, and ``overlap_ms``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(Listing(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ListingStream(Listing(self.options))
