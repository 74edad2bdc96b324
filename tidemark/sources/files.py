"""Small file operations through Spark's own Hadoop file systems.

Used by the driver for directory names, tiny state files and the removal of
emptied partition directories; rows never pass here. Only a missing path means
"nothing there": every other error is raised.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def qualified(self, path: str) -> str:
        """The path with its file system's scheme and authority."""
        fs, p = self._at(path)
        return fs.makeQualified(p).toString()

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names of the entries of a directory; none if it does not exist."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def walk(self, path: str, suffix: str = "") -> list[str]:
        """Paths, relative to a directory, of all files below it with that ending, in order."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        base, found, out = len(fs.makeQualified(p).toString()) + 1, fs.listFiles(p, True), []
        while found.hasNext():
            name = found.next().getPath().toString()[base:]
            if name.endswith(suffix):
                out.append(name)
        return sorted(out)

    def move(self, source: str, target: str) -> None:
        """Rename a file to a path that does not exist; its folders are made."""
        fs, p = self._at(target)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._at(source)[1], p):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        if fs.exists(p) and not fs.delete(p, True):
            raise OSError(f"cannot delete {path}")

    def read_text(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Replace a small file in one rename: readers see the old or the new text."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        part = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        over = self.jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        over[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.conf).rename(part, p, over)
