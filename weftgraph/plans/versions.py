"""Numbered versions of data in a shared folder, published by one atomic step each."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published this version; nothing of one's own is."""


class Versions:
    """Small files ``folder/<number>`` that name where the data of each version is.

    A file is written under another name and then linked (local files) or renamed (other file systems) to its number; both
    fail if the number is taken, also if it was taken after one last looked. So of several writers of one number exactly one
    succeeds, a reader never sees a file without content, and data that no file names are not part of any version.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark._jvm
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))

    def numbers(self) -> list[int]:
        """Published versions in order."""
        if not self._files.exists(self._path("")):
            return []
        names = (s.getPath().getName() for s in self._files.listStatus(self._path("")))
        return sorted(int(n) for n in names if n.isdigit())

    def latest(self) -> int:
        """The last version's number, -1 before the first."""
        return (self.numbers() or [-1])[-1]

    def read(self, number: int) -> str:
        """What the version names."""
        source = self._files.open(self._path(str(number)))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
        finally:
            source.close()

    def publish(self, number: int, content: str) -> None:
        """Publish a version; raises ``Conflict`` if its number is taken."""
        self._files.mkdirs(self._path(""))
        draft, target = self._path(f"draft-{uuid.uuid4().hex}"), self._path(str(number))
        out = self._files.create(draft, False)
        out.write(bytearray(content.encode()))
        out.close()
        try:
            if self._files.getUri().getScheme() == "file":
                plain = self._files.makeQualified(target).toUri(), self._files.makeQualified(draft).toUri()
                new, old = (self._jvm.java.nio.file.Path.of(self._jvm.java.net.URI.create(f"file://{u.getPath()}")) for u in plain)
                self._jvm.java.nio.file.Files.createLink(new, old)
            elif not self._files.rename(draft, target):
                raise Conflict(f"version {number} of {self.folder} is taken")
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise Conflict(f"version {number} of {self.folder} is taken") from None
            raise
        finally:
            if self._files.exists(draft):
                self._files.delete(draft, False)

    def remove(self, data: str) -> None:
        """Delete a folder of data that is not needed any more."""
        self._files.delete(self._jvm.org.apache.hadoop.fs.Path(data), True)
