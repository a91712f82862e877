"""Versions of a warehouse: the folders that make up each table, switched as a whole by one small file.

A warehouse is a folder with

* ``<table>/segment=<name>/...`` the rows; a segment counts once a version lists it, and is never changed;
* ``versions/<number>.json``    one file per change: all segments of all tables, and the change's ledger entry;
* ``attempts/<change>.json``    a change that has begun; it goes when the change is committed.

Readers take the highest version and see all tables as of one moment. A change writes new segments, which nobody
sees, and then creates the next version file, which fails if another change was first. So a failure at any
point, also of the driver, leaves the version before it whole.
"""

import json
import os
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from itertools import count

from pyspark.sql import functions as F

VERSIONS, ATTEMPTS = "versions", "attempts"

LEDGER = (
    "number bigint, entry struct<change:string, batch:string, kind:string, state:string, began:string, ended:string, "
    "error:string, low_id:bigint, high_id:bigint, counts:map<string,bigint>>"
)


class ConcurrentChange(Exception):
    """Another change was committed first; nothing of this one is visible."""


def _now():
    return datetime.now(timezone.utc)


class _Folder:
    """Small files below a folder of any file system that Spark reaches."""

    def __init__(self, spark, path):
        self.jvm, self.path = spark._jvm, str(path).rstrip("/")
        self.files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name=""):
        at = self._at(name)
        return [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []

    def read(self, name):
        stream = self.files.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name, text):
        stream = self.files.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create(self, name, text):
        """Create a file with all its text at once; False if it exists already."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        self.write(draft, text)
        source, target = self._at(draft), self._at(name)
        try:
            if self.files.getUri().getScheme() == "file":
                # renaming would replace a file here; a link does not
                os.link(source.toUri().getPath(), target.toUri().getPath())
                return True
            # HDFS refuses a rename onto an existing file; a store that does not needs a lock around changes
            return not self.files.exists(target) and self.files.rename(source, target)
        except FileExistsError:
            return False
        finally:
            self.delete(draft)

    def delete(self, name):
        self.files.delete(self._at(name), True)


@dataclass(frozen=True)
class Version:
    """One state of the warehouse; number 0 is the empty one."""

    number: int = 0
    tables: dict = field(default_factory=dict)
    streams: dict = field(default_factory=dict)

    def paths(self, root, name):
        return [f"{str(root).rstrip('/')}/{name}/segment={segment}" for segment in self.tables.get(name, [])]


def _numbers(folder):
    return sorted(int(n[:-5]) for n in folder.names(VERSIONS) if n.endswith(".json") and n[:-5].isdigit())


def _file(number):
    return f"{VERSIONS}/{number:012d}.json"


def read_version(spark, root, number=None):
    """The newest version, or the one with that number."""
    folder = _Folder(spark, root)
    if number is None:
        number = max(_numbers(folder), default=0)
    if number == 0:
        return Version()
    stored = json.loads(folder.read(_file(number)))
    return Version(number, stored["tables"], stored["streams"])


class Change:
    """Segments that are written but not visible yet. ``entry`` goes to the ledger."""

    def __init__(self, spark, root, kind, batch=None):
        self.spark, self.root = spark, str(root).rstrip("/")
        self.base = read_version(spark, root)
        self.tables = {name: list(segments) for name, segments in self.base.tables.items()}
        self.streams = dict(self.base.streams)
        self.replaced = set()
        self.id = uuid.uuid4().hex
        self.numbers = count(1)
        self.entry = {
            "change": self.id, "batch": batch or self.id, "kind": kind, "state": "started", "began": _now().isoformat(),
            "ended": None, "error": None, "low_id": None, "high_id": None, "counts": {},
        }

    def new_segment(self, name):
        """(segment, its path); it is not part of the table before ``add``."""
        # a letter in front, so the name is never taken for a number
        segment = f"s{self.id}-{next(self.numbers)}"
        return segment, f"{self.root}/{name}/segment={segment}"

    def clear(self, name):
        """Leave out all rows that the table had."""
        self.tables[name] = []
        self.replaced.add(name)

    def add(self, name, segment):
        self.tables.setdefault(name, []).append(segment)

    def version(self):
        """What a reader will see after the commit."""
        return Version(self.base.number + 1, self.tables, self.streams)

    def commit(self, folder):
        self.entry |= {"state": "committed", "ended": _now().isoformat()}
        number = self.base.number + 1
        while True:
            stored = {"number": number, "tables": self.tables, "streams": self.streams, "entry": self.entry}
            if folder.create(_file(number), json.dumps(stored)):
                return
            # a change that replaces every table does not depend on what came before
            if not set(read_version(self.spark, self.root).tables) <= self.replaced:
                raise ConcurrentChange(f"version {number} of {self.root} was made by another change")
            number += 1


@contextmanager
def changing(spark, root, kind, batch=None):
    """A change that is committed if the block ends without an error, else left out and noted in the ledger."""
    change = Change(spark, root, kind, batch)
    folder, attempt = _Folder(spark, root), f"{ATTEMPTS}/{change.id}.json"
    folder.write(attempt, json.dumps({"entry": change.entry}))
    try:
        yield change
        change.commit(folder)
    except BaseException as error:
        failed = {"state": "failed", "ended": _now().isoformat(), "error": f"{type(error).__name__}: {error}"[:2000]}
        folder.write(attempt, json.dumps({"entry": change.entry | failed}))
        raise
    folder.delete(attempt)


def read_ledger(spark, root):
    """One row per change, with its state: committed, failed, cleaned, or started and not ended.

    A change whose driver died after the commit counts as committed.
    """
    folder = _Folder(spark, root)
    paths = [f"{folder.path}/{name}" for name in (VERSIONS, ATTEMPTS) if folder.names(name)]
    if paths:
        rows = spark.read.schema(LEDGER).option("pathGlobFilter", "*.json").json(paths)
    else:
        rows = spark.createDataFrame([], LEDGER)
    # a committed change has a number, an attempt has none
    newest = rows.groupBy(F.col("entry.change").alias("change")).agg(
        F.max("number").alias("version"),
        F.max_by("entry", F.coalesce("number", F.lit(0))).alias("entry"),
    )
    times = {name: F.col(name).cast("timestamp") for name in ("began", "ended")}
    return newest.select("version", "entry.*").withColumns(times)


def _segments(folder):
    """(table, segment) of all segment folders, listed by versions or not."""
    for table in folder.names():
        for name in folder.names(table):
            if name.startswith("segment="):
                yield table, name.removeprefix("segment=")


def clean_failed(spark, root, older_than_seconds=86_400):
    """Remove what failed changes have written, and what changes left that began so long ago without an end.

    Returns the changes that were cleaned. Their ledger entries stay.
    """
    folder = _Folder(spark, root)
    waited = (_now() - timedelta(seconds=older_than_seconds)).replace(tzinfo=None)
    ledger = read_ledger(spark, root)
    began = F.to_timestamp_ntz(F.date_format("began", "yyyy-MM-dd HH:mm:ss"))
    stale = (F.col("state") == "failed") | ((F.col("state") == "started") & (began <= F.lit(waited)))
    found = {row["change"] for row in ledger.where(F.col("version").isNull() & stale).select("change").collect()}
    for table, segment in list(_segments(folder)):
        if segment[1:].split("-")[0] in found:
            folder.delete(f"{table}/segment={segment}")
    for change in found:
        attempt = f"{ATTEMPTS}/{change}.json"
        entry = json.loads(folder.read(attempt))["entry"]
        folder.write(attempt, json.dumps({"entry": entry | {"state": "cleaned"}}))
    return sorted(found)


def expire_versions(spark, root, keep=2):
    """Remove segments that none of the newest ``keep`` versions lists and no change in work has written.

    Version files stay, as they are the ledger. Returns how many segments were removed.
    """
    folder = _Folder(spark, root)
    # first what is in work: a change that is committed after this is still in the list
    working = {name[:-5] for name in folder.names(ATTEMPTS)}
    kept = [read_version(spark, root, number) for number in _numbers(folder)[-keep:]]
    needed = {(name, s) for version in kept for name, segments in version.tables.items() for s in segments}
    gone = [
        (table, segment)
        for table, segment in _segments(folder)
        if (table, segment) not in needed and segment[1:].split("-")[0] not in working
    ]
    for table, segment in gone:
        folder.delete(f"{table}/segment={segment}")
    return len(gone)
