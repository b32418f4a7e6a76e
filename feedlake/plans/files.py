"""Files of any store that Spark reaches, handled from the driver: names only, never their rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Store:
    """The file system that a path belongs to."""

    spark: SparkSession
    root: str

    def _at(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def _files(self):
        return self._at(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._at(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, in order; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(entry.getPath().getName() for entry in self._files.listStatus(self._at(path)))

    def tree(self, path: str) -> Iterator[str]:
        """Paths of all files below a folder, relative to it, hidden ones left out."""
        if not self.exists(path):
            return
        found = self._files.listFiles(self._at(path), True)
        base = self._files.makeQualified(self._at(path)).toUri().getPath().rstrip("/") + "/"
        while found.hasNext():
            name = found.next().getPath().toUri().getPath().removeprefix(base)
            if not any(part[0] in "_." for part in name.split("/")):
                yield name

    def move(self, source: str, target: str) -> None:
        """Renames a file into a folder that is made if need be."""
        files = self._files
        files.mkdirs(self._at(target).getParent())
        if not files.rename(self._at(source), self._at(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def write(self, path: str, text: str) -> None:
        """Writes a small file so that it is there whole or not at all."""
        half = f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}.half"
        out = self._files.create(self._at(half), True)
        out.write(bytearray(text.encode()))
        out.close()
        if self.exists(path):
            self.delete(path)
        self.move(half, path)

    def read(self, path: str) -> str:
        """Text of a small file."""
        opened = self._files.open(self._at(path))
        jvm = self.spark.sparkContext._jvm
        text = jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        opened.close()
        return text

    def delete(self, path: str) -> None:
        self._files.delete(self._at(path), True)
