"""What has been done, as small files that appear whole or not at all."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from hashlib import sha256
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession


class Ledger:
    """Notes by name in a folder shared by driver restarts: any Hadoop file system.

    A note is written beside the folder's notes and renamed into place, so a reader sees the
    old note, the new one, or none. Notes are few and small: steps of a job, batches of a
    stream, the current version of a table. They pass through the driver; data does not.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.folder}/{quote(name, safe='')}.json")

    def put(self, name: str, note: Mapping | None = None) -> None:
        """Write or replace a note."""
        waiting = self._path(f"{self.folder}/.{quote(name, safe='')}.tmp")
        stream = self._files.create(waiting, True)
        stream.write(json.dumps(dict(note or {})).encode())
        stream.close()
        target = self._at(name)
        if not self._files.rename(waiting, target):
            # Some file systems do not rename over a file.
            self._files.delete(target, False)
            if not self._files.rename(waiting, target):
                raise OSError(f"cannot write {target}")

    def get(self, name: str) -> dict | None:
        """A note, or None."""
        target = self._at(name)
        if not self._files.exists(target):
            return None
        stream = self._files.open(target)
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def names(self) -> list[str]:
        folder = self._path(self.folder)
        if not self._files.exists(folder):
            return []
        found = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(unquote(name[:-5]) for name in found if name.endswith(".json"))

    def forget(self, name: str) -> None:
        self._files.delete(self._at(name), False)

    def delete_data(self, path: str) -> None:
        """Delete a folder of data that notes no longer name."""
        self._files.delete(self._path(path), True)

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))


class Steps:
    """Steps of a job that need not be repeated: each leaves a note of what it was made from.

    A step is done if its note has the same fingerprint and its output is still there. The
    note goes before a step begins and comes back when it has ended, so a step that broke is
    run again whole. A fingerprint of None is never the same.
    """

    def __init__(self, notes: Ledger | None):
        self.notes = notes

    def run(self, name: str, made_from: str | None, output: str, work: Callable[[], Mapping | None]) -> dict:
        """What ``work`` returns, from its note or by running it; small values only."""
        if self.notes is None:
            return dict(work() or {})
        note = self.notes.get(name)
        if note and made_from is not None and note["made_from"] == made_from and self.notes.exists(f"{output}/_SUCCESS"):
            return note["kept"]
        self.notes.forget(name)
        kept = dict(work() or {})
        self.notes.put(name, {"made_from": made_from, "kept": kept})
        return kept


def combined(*fingerprints: str | None) -> str | None:
    """One fingerprint of several; None if one is."""
    if any(f is None for f in fingerprints):
        return None
    return sha256("\n".join(fingerprints).encode()).hexdigest()


def fingerprint(df: DataFrame) -> str | None:
    """What a table is read from: its plan, and the names, sizes and times of its files.

    None where the plan holds data that no file stands for.
    """
    spark = df.sparkSession
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
    if any(kind in plan for kind in ("LocalRelation", "LogicalRDD", "ExternalRDD", "rand(", "uuid(")):
        return None
    hadoop = spark._jvm.org.apache.hadoop.fs
    folders: dict[str, set[str]] = {}
    for file in df.inputFiles():
        folder, name = file.rsplit("/", 1)
        folders.setdefault(folder, set()).add(unquote(name))
    seen = sha256(plan.encode())
    # Folders are listed, since asking for each file takes a call.
    for folder, names in sorted(folders.items()):
        path = hadoop.Path(spark._jvm.java.net.URI(folder))
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        for status in sorted(listed, key=lambda s: s.getPath().getName()):
            if status.getPath().getName() in names:
                seen.update(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}\n".encode())
    return seen.hexdigest()
