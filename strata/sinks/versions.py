"""Versions of a stored table: staged refresh, one commit, compaction (SNK-1, SNK-7).

A table that others read must never be half written, and its files must not vanish under a running query.  So a refresh
writes all rows to a fresh folder, checks them there, and then makes them current in one step: a small commit file,
created under the next number in the table's log, that names the folder.  What is current is always read from the log,
never guessed from folder names.  A writer that dies before the commit leaves the table as it was, and the folders of
earlier versions stay until ``vacuum``, so queries planned on them finish.

    <table>.versions/log/00000001      names data-...-a1b2
    <table>.versions/data-...-a1b2/    part files

Two writers can't both create the same number.  A refresh that loses takes the next number (its rows replace all others);
a compaction that loses gives up, because the rows that it copied are no longer the table's.

Files are reached through Spark's own file systems, so the log works on any store that the cluster reads and that can
create a file only if it doesn't exist.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_LOCATION = re.compile(r"(.+)\.versions/data-[^/]+/?$")


class StaleVersionError(RuntimeError):
    """Another writer has made a new version current in the meantime."""


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Spark's file system (local, HDFS, object store)."""
    fs, p = hadoop_path(spark, path)
    return fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it doesn't exist."""
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    fmt: str


class VersionedTable:
    """The versions of the table at ``path`` (``<database folder>/<table>``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.root = f"{self.path}.versions"

    @classmethod
    def at_location(cls, spark: SparkSession, location: str) -> VersionedTable:
        """The versions that a catalog location belongs to; a plain table's folder has none yet."""
        own = _LOCATION.match(location)
        return cls(spark, own.group(1) if own else location)

    # ------------------------------------------------------------------ reading

    def _numbers(self) -> list[int]:
        return [int(n) for n in list_names(self.spark, f"{self.root}/log") if n.isdigit()]

    def _entry(self, number: int) -> Version | None:
        """A commit; None for one whose writer died while creating it (its line has no end)."""
        fs, p = hadoop_path(self.spark, f"{self.root}/log/{number:08d}")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        name, _, fmt = text.strip().partition(" ")
        return Version(number, f"{self.root}/{name}", fmt) if text.endswith("\n") else None

    def history(self) -> list[Version]:
        """All commits that are still in the log, oldest first."""
        return [v for v in map(self._entry, self._numbers()) if v]

    def current(self) -> Version | None:
        for number in reversed(self._numbers()):
            if version := self._entry(number):
                return version
        return None

    def folder(self) -> str:
        """Where the rows are now; the plain folder while there is no version."""
        version = self.current()
        return version.folder if version else self.path

    def read(self) -> DataFrame:
        version = self.current()
        if version is None:
            return self.spark.read.parquet(self.path)
        return self.spark.read.format(version.fmt).load(version.folder)

    # ------------------------------------------------------------------ writing

    def stage(self, df: DataFrame, fmt: str = "parquet") -> Version:
        """Write rows to a fresh folder that nobody reads yet; a failed write leaves nothing behind."""
        folder = f"{self.root}/data-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        try:
            df.write.format(fmt).save(folder)
        except BaseException:
            delete_path(self.spark, folder)
            raise
        return Version(0, folder, fmt)

    def discard(self, staged: Version) -> None:
        delete_path(self.spark, staged.folder)

    def commit(self, staged: Version, after: int | None = None) -> Version:
        """Make a staged version current.  With ``after`` only directly behind that number (0: as the first)."""
        line = f"{staged.folder.rsplit('/', 1)[1]} {staged.fmt}\n"
        while True:
            latest = max(self._numbers(), default=0)
            if after is not None and latest != after:
                raise StaleVersionError(f"{self.path}: version {latest} is current, not {after}")
            fs, p = hadoop_path(self.spark, f"{self.root}/log/{latest + 1:08d}")
            try:
                stream = fs.create(p, False)
            except Exception as e:   # another writer took the number
                if not fs.exists(p):
                    raise
                if after is not None:
                    raise StaleVersionError(f"{self.path}: version {latest + 1} was committed in the meantime") from e
                continue
            stream.write(bytearray(line.encode()))
            stream.close()
            return Version(latest + 1, staged.folder, staged.fmt)

    def refresh(self, df: DataFrame, fmt: str = "parquet", metrics: dict[str, Column] | None = None,
                check: Callable[[DataFrame, dict], None] | None = None) -> Version:
        """Replace all rows.  ``check(staged rows, metrics)`` may raise: then the old version stays current.

        ``metrics`` are aggregates of the rows that Spark collects while it writes them, so a check on them reads nothing.
        """
        seen = Observation() if metrics else None
        if metrics:
            df = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
        staged = self.stage(df, fmt)
        try:
            if check:
                check(self.spark.read.format(fmt).load(staged.folder), seen.get if seen else {})
        except BaseException:
            self.discard(staged)
            raise
        return self.commit(staged)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all versions but the current one and ``keep`` before it; returns the folders deleted.

        The plain folder of a table that got versions later counts as the oldest one.  Folders without a commit may
        belong to a running writer and stay.
        """
        history = self.history()
        old = history[:-(keep + 1)]
        gone = [v.folder for v in old]
        if len(history) > keep and list_names(self.spark, self.path):
            gone.append(self.path)
        for folder in gone:
            delete_path(self.spark, folder)
        for version in old:
            delete_path(self.spark, f"{self.root}/log/{version.number:08d}")
        return gone
