"""Files and folders of any store that Spark reads, by its own file-system interface (never ``open``)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


class Store:
    """The file system that ``root`` is on. Paths are texts; those that Spark reports for files are URIs."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str, is_uri: bool = False):
        return self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(path) if is_uri else path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str, is_uri: bool = False) -> None:
        """Remove a file, or a folder with all below it. Nothing is done where there is none."""
        self._fs.delete(self._path(path, is_uri), True)

    def drop_if_empty(self, path: str, is_uri: bool = False) -> None:
        p = self._path(path, is_uri)
        if self._fs.exists(p) and self._fs.getFileStatus(p).isDirectory() and not len(self._fs.listStatus(p)):
            self._fs.delete(p, False)

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder, over a file of that name; the target's folder is made."""
        s, t = self._path(source), self._path(target)
        self._fs.mkdirs(t.getParent())
        if self._fs.exists(t):
            self._fs.delete(t, False)
        if not self._fs.rename(s, t):
            raise OSError(f"cannot move {source} to {target}")

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none where it doesn't exist."""
        p = self._path(path)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def files(self, path: str, below: str = "") -> Iterator[str]:
        """Paths of all files below a folder, relative to it."""
        for name in self.names(path):
            if self._fs.getFileStatus(self._path(f"{path}/{name}")).isDirectory():
                yield from self.files(f"{path}/{name}", f"{below}{name}/")
            else:
                yield f"{below}{name}"

    def write_text(self, path: str, text: str) -> None:
        """A small file, written beside its place and renamed there, so that it is there whole or not at all."""
        out = self._fs.create(self._path(f"{path}.tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{path}.tmp", path)

    def read_text(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()
