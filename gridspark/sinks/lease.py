"""One writer at a time for a directory or a table, by a file that only one of them can make.

The file lies beside the directory. Its writer renews it while it works; one that was not renewed for
`SECONDS` belongs to a driver that is gone, and the next writer takes it over.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from gridspark.sinks.files import Files

#: A lease that is so much older than its last renewal is stale. Drivers' clocks may differ by less.
SECONDS = 600


class Busy(RuntimeError):
    """Another writer holds the lease."""


class Lease:
    def __init__(self, files: Files, name: str):
        self._files, self._name, self._owner = files, name, uuid.uuid4().hex
        self._done = threading.Event()

    def take(self, seconds: float) -> None:
        for _ in range(3):
            if self._files.create(self._name, self._owner):
                threading.Thread(target=self._renew, args=(seconds / 3,), daemon=True).start()
                return
            holder = self._files.read(self._name)
            if holder is None:
                continue
            if time.time() - self._files.modified(self._name) < seconds:
                raise Busy(f"{self._files.root}/{self._name}: another writer is at work")
            self._put_away(holder)
        raise Busy(f"{self._files.root}/{self._name}: other writers came first")

    def _put_away(self, holder: str) -> None:
        """Remove a stale lease. Of two who try one succeeds; neither takes a lease that is new."""
        aside = f"{self._name}-{self._owner}"
        try:
            self._files.move((self._name,), (aside,))
        except Exception:  # noqa: BLE001 - somebody else was faster
            return
        if self._files.read(aside) != holder:
            self._files.move((aside,), (self._name,))
            raise Busy(f"{self._files.root}/{self._name}: another writer is at work")
        self._files.delete(aside)

    def _renew(self, every: float) -> None:
        while not self._done.wait(every):
            if self._files.read(self._name) != self._owner:
                return
            self._files.write(self._name, self._owner)

    def check(self) -> None:
        """Raise if the lease was lost, before anything is put in place."""
        if self._files.read(self._name) != self._owner:
            raise Busy(f"{self._files.root}/{self._name}: lost to another writer")

    def release(self) -> None:
        self._done.set()
        if self._files.read(self._name) == self._owner:
            self._files.delete(self._name)


@contextmanager
def leased(spark: SparkSession, root: str, seconds: float | None = None) -> Iterator[Lease]:
    """The lease of a directory (or of what would be one at `root`) for the block."""
    parent, _, name = root.rstrip("/").rpartition("/")
    files = Files(spark, parent or "/")
    files.make()
    lease = Lease(files, f"_lease-{name}")
    lease.take(SECONDS if seconds is None else seconds)
    try:
        yield lease
    finally:
        lease.release()
