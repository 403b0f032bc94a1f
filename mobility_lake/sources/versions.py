"""Tables that change in one step: data folders that are written once, and numbered pointers to them.

`<table>/_data/<name>` are folders of Parquet files, `<table>/_versions/<number>` are small JSON files.
The highest number tells which folders make up the table. A writer first writes a folder that nobody
reads yet, then a pointer; whoever resolved the one before goes on reading its folders. A writer
that dies leaves a folder without a pointer, or a pointer without its closing brace, and readers
do not see either. `remove_old` clears such folders away, and those no longer pointed to.

A pointer is made by an exclusive create and never changed, so no store needs a rename. Writers that
meet start over from the newer pointer. A path without pointers is a plain folder of files.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTERS, DATA = "_versions", "_data"
State = dict
KEPT = 8  # pointers that stay behind the newest
PATIENCE_S = 5.0  # how long an unfinished pointer may belong to a writer that lives


class _Store:
    """The file system of a path, through Spark's own configuration."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self._files = self._hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def list(self, path: str) -> list[tuple[str, int]]:
        """(name, modification time in milliseconds) of what lies in a folder; nothing if there is none."""
        try:
            found = self._files.listStatus(self._hadoop.Path(path))
        except Py4JJavaError as error:
            if "FileNotFoundException" in error.java_exception.getClass().getName():
                return []
            raise
        return [(entry.getPath().getName(), entry.getModificationTime()) for entry in found]

    def read(self, path: str) -> str:
        stream = self._files.open(self._hadoop.Path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one already."""
        try:
            stream = self._files.create(self._hadoop.Path(path), False)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete(self, path: str) -> None:
        self._files.delete(self._hadoop.Path(path), True)


def names_in(spark: SparkSession, path: str) -> set[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    return {name for name, _ in _Store(spark, path).list(path)}


def _numbers(store: _Store, path: str) -> list[int]:
    return sorted(int(name) for name, _ in store.list(f"{path}/{POINTERS}") if name.isdigit())


def _read(store: _Store, path: str, number: int) -> State | None:
    try:
        return json.loads(store.read(f"{path}/{POINTERS}/{number:012d}"))
    except (json.JSONDecodeError, Py4JJavaError):
        return None  # not finished, or just removed


def _newest(store: _Store, path: str) -> tuple[list[int], int | None, State | None]:
    """(all numbers, that of the newest finished pointer, what it says)."""
    numbers = _numbers(store, path)
    for number in reversed(numbers):
        found = _read(store, path, number)
        if found is not None:
            return numbers, number, found
    return numbers, None, None


def state(spark: SparkSession, path: str) -> State | None:
    """What the newest finished pointer says; None for a path without one."""
    path = path.rstrip("/")
    return _newest(_Store(spark, path), path)[2]


def _names(found: State | None) -> set[str]:
    """The data folders that a state holds live."""
    found = found or {}
    return {*([found["folder"]] if "folder" in found else []), *[run["name"] for run in found.get("runs", [])]}


def commit(spark: SparkSession, path: str, change: Callable[[State | None], State]) -> State:
    """Put `change(state)` in the place of the state. `change` may be called again with a newer one.

    The new state notes under `retired` which folders it no longer holds, and since when.
    """
    path = path.rstrip("/")
    store = _Store(spark, path)
    until = time.monotonic() + PATIENCE_S
    while True:
        numbers, finished, before = _newest(store, path)
        if numbers and finished != numbers[-1] and time.monotonic() < until:
            time.sleep(0.2)  # another writer is about to finish its pointer
            continue
        after = dict(change(before))
        retired = {**(before or {}).get("retired", {}), **{name: time.time() for name in _names(before)}}
        after["retired"] = {n: at for n, at in after.get("retired", retired).items() if n not in _names(after)}
        number = numbers[-1] + 1 if numbers else 0
        if store.create(f"{path}/{POINTERS}/{number:012d}", json.dumps(after)):
            for old in numbers[:-KEPT]:
                store.delete(f"{path}/{POINTERS}/{old:012d}")
            return after


def new_folder(path: str, label: str = "v") -> tuple[str, str]:
    """(name, path) of a data folder that nobody has."""
    name = f"{label}-{uuid.uuid4().hex}"
    return name, f"{path.rstrip('/')}/{DATA}/{name}"


def folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{DATA}/{name}"


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds a table now: of its newest version, or `path` itself."""
    found = state(spark, path)
    return folder(path, found["folder"]) if found and "folder" in found else path


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Have `write` fill a new folder, then point to it. Readers see the old table until then."""
    name, place = new_folder(path)
    write(place)
    commit(spark, path, lambda _: {"folder": name})
    return place


def remove_old(spark: SparkSession, path: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove data folders that were retired longer ago than `older_than`, and those that old that no state named.

    Readers and streams that took up a version longer ago must be done with it, and writers that began
    a folder longer ago too. Returns what was removed.
    """
    path = path.rstrip("/")
    store = _Store(spark, path)
    found = state(spark, path)
    if found is None:
        return []
    latest = time.time() - older_than.total_seconds()
    retired = found.get("retired", {})
    gone = {name for name, at in retired.items() if at < latest}
    listed = store.list(f"{path}/{DATA}")
    gone |= {n for n, at in listed if at < latest * 1000 and n not in retired and n not in _names(found)}
    # Files from before the table had versions.
    before = {n for n, at in store.list(path) if not n.startswith("_") and at < latest * 1000}
    for place in [*[f"{DATA}/{name}" for name in sorted(gone)], *sorted(before)]:
        store.delete(f"{path}/{place}")

    def forget(now: State | None) -> State:
        return {**now, "retired": {n: at for n, at in now.get("retired", {}).items() if n not in gone}}

    if gone & set(retired):
        commit(spark, path, forget)
    return [*[f"{DATA}/{name}" for name in sorted(gone)], *sorted(before)]
