"""The file operations that the sinks need, through Hadoop, as Spark itself does.

Needs a classic session, which Connect is not.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

MOVES_AT_A_TIME = 16


class Files:
    """The few file operations that a replacement needs."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._made: set[str] = set()
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = root.rstrip("/")

    def at(self, *parts: str):
        return self._path("/".join([self.root, *parts]) or "/")

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.at(*parts))

    def names(self, *parts: str) -> list[str]:
        """Names in a folder; one call for all of them, as there can be thousands."""
        if not self.exists(*parts):
            return []
        found = self._fs.listStatus(self.at(*parts))
        if not len(found):
            return []
        # Hadoop joins paths to one text for its own jobs, with commas inside them escaped.
        hadoop = self._jvm.org.apache.hadoop
        joined = hadoop.mapred.JobConf(False)
        hadoop.mapred.FileInputFormat.setInputPaths(joined, hadoop.fs.FileUtil.stat2Paths(found))
        paths = re.split(r"(?<!\\),", joined.get("mapreduce.input.fileinputformat.inputdir"))
        return [re.sub(r"\\(.)", r"\1", path.rpartition("/")[2]) for path in paths]

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        parent = "/".join(target).rpartition("/")[0]
        if parent and parent not in self._made:
            self.make(parent)
            self._made.add(parent)
        if not self._fs.rename(self.at(*source), self.at(*target)):
            raise OSError(f"{self.root}: {'/'.join(source)} does not move to {'/'.join(target)}")

    def move_all(self, moves: list[tuple[tuple[str, ...], tuple[str, ...]]]) -> None:
        """Many moves, some at a time: each waits for the file system, not for the driver."""
        if len(moves) < 4:
            for move in moves:
                self.move(*move)
            return
        with ThreadPoolExecutor(MOVES_AT_A_TIME) as pool:
            for _ in pool.map(lambda move: self.move(*move), moves):
                pass

    def make(self, *parts: str) -> None:
        self._fs.mkdirs(self.at(*parts))

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.at(*parts), True)

    def units(self, folder: tuple[str, ...], depth: int) -> list[str]:
        """Partitions `depth` levels down, as `a=1/b=2`; with depth 0 whatever a reader sees."""
        if depth == 0:
            return [n for n in self.names(*folder) if not n.startswith(("_", "."))]
        found = [""]
        for _ in range(depth):
            found = [
                f"{unit}/{name}".lstrip("/")
                for unit in found
                for name in self.names(*folder, *filter(None, [unit]))
                if "=" in name
            ]
        return found

    def partition_columns(self) -> list[str]:
        """Names of the partition columns, from the first branch of folders."""
        columns, at = [], []
        while inner := next((n for n in sorted(self.names(*at)) if "=" in n), None):
            columns.append(inner.partition("=")[0])
            at.append(inner)
        return columns

    def create(self, name: str, text: str) -> bool:
        """A new file; False if there is one of that name. One of two callers gets it."""
        try:
            out = self._fs.create(self.at(name), False)
        except Exception:
            if self.exists(name):
                return False
            raise
        self._put(out, text)
        return True

    def write(self, name: str, text: str) -> None:
        self._put(self._fs.create(self.at(name), True), text)

    @staticmethod
    def _put(out, text: str) -> None:
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str | None:
        """Text of a small file, None if it is not there."""
        if not self.exists(name):
            return None
        size = self._fs.getFileStatus(self.at(name)).getLen()
        source = self._fs.open(self.at(name))
        try:
            return bytes(source.readNBytes(size)).decode()
        finally:
            source.close()

    def modified(self, name: str) -> float:
        """Seconds since 1970 at which a file was last written."""
        return self._fs.getFileStatus(self.at(name)).getModificationTime() / 1000

    def walk(self, *parts: str) -> list[str]:
        """Data files below a folder, as paths from there."""
        if not self.exists(*parts):
            return []
        top = self._fs.makeQualified(self.at(*parts)).toUri().getPath().rstrip("/") + "/"
        found, each = [], self._fs.listFiles(self.at(*parts), True)
        while each.hasNext():
            path = each.next().getPath().toUri().getPath().removeprefix(top)
            if not path.rpartition("/")[2].startswith(("_", ".")):
                found.append(path)
        return found

    def inside(self, uri: str) -> str:
        """A file's path from the root, from the URI that Spark gives for it."""
        path = self._jvm.java.net.URI(uri).getPath()
        return path.removeprefix(self._fs.makeQualified(self.at()).toUri().getPath().rstrip("/") + "/")
