"""How far the jobs have come with a feed, kept in a shared folder.

For each feed: up to which ingest time silver has taken its snapshots, and the days that silver touched
and gold has not recomputed yet. Days are noted before silver is written, and struck off when gold is
done; so a run that is lost anywhere leaves what the next one has to do. What it does twice does not
change the outcome, as long as silver merges with `newest_wins` or snapshots come in order.

A state is a file of its own, numbered; the next number can be made by one writer only, and a file that
was cut short is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import SparkSession

from gridspark.sinks.files import Files


@dataclass(frozen=True)
class Progress:
    number: int = 0
    until: datetime | None = None
    pending: frozenset[date] = frozenset()


class ProgressLog:
    """The states of all feeds below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._files = Files(spark, root)
        self._files.make()

    def _names(self, feed: str) -> dict[int, str]:
        found = [name for name in self._files.names() if name.startswith(f"{feed}.") and name.endswith(".json")]
        return {int(name.split(".")[-2]): name for name in found}

    def read(self, feed: str) -> Progress:
        for number, name in sorted(self._names(feed).items(), reverse=True):
            try:
                state = json.loads(self._files.read(name) or "")
            except ValueError:
                continue
            until = state["until"] and datetime.fromisoformat(state["until"])
            return Progress(number, until, frozenset(map(date.fromisoformat, state["pending"])))
        return Progress()

    def _write(self, feed: str, before: Progress, after: Progress) -> Progress:
        names = self._names(feed)
        number = max([before.number, *names]) + 1
        if self.read(feed).number != before.number:
            raise RuntimeError(f"another run has moved the progress of {feed}")
        state = {"until": after.until and after.until.isoformat(), "pending": sorted(d.isoformat() for d in after.pending)}
        if not self._files.create(f"{feed}.{number}.json", json.dumps(state)):
            raise RuntimeError(f"another run has moved the progress of {feed}")
        for old in names:
            if old < before.number:
                self._files.delete(names[old])
        return replace(after, number=number)

    def touched(self, feed: str, days: Collection[date]) -> None:
        """Silver is about to write rows of these days."""
        now = self.read(feed)
        if not set(days) <= now.pending:
            self._write(feed, now, replace(now, pending=now.pending | set(days)))

    def taken(self, feed: str, until: datetime | None) -> None:
        """Silver has all snapshots up to a time."""
        now = self.read(feed)
        if until is not None and until != now.until:
            self._write(feed, now, replace(now, until=until))

    def recomputed(self, feed: str, days: Collection[date]) -> None:
        """Gold has these days."""
        now = self.read(feed)
        if now.pending & set(days):
            self._write(feed, now, replace(now, pending=now.pending - set(days)))
