"""Small files of the driver in any file system that Spark reads: markers, checkpoints, published outputs."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder by its path or URL."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _of(self, name: str):
        return self._at(f"{self.path}/{name}")

    def exists(self, name: str) -> bool:
        return self._files.exists(self._of(name))

    def names(self) -> list[str]:
        """Names in order; none if the folder isn't there."""
        here = self._at(self.path)
        return sorted(x.getPath().getName() for x in self._files.listStatus(here)) if self._files.exists(here) else []

    def read(self, name: str) -> bytes:
        stream = self._files.open(self._of(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def publish(self, name: str, content: bytes) -> None:
        """Write under another name, then rename: readers see whole files only, and a repeated step the same one."""
        part = self._of(name + ".part")
        out = self._files.create(part, True)
        try:
            out.write(content)
            out.hsync()
        finally:
            out.close()
        if self._files.exists(self._of(name)):
            self._files.delete(self._of(name), False)
        if not self._files.rename(part, self._of(name)):
            raise OSError(f"{self.path}/{name} could not be published")

    def remove_stale(self) -> int:
        """Delete what interrupted writers left."""
        stale = [n for n in self.names() if n.endswith(".part")]
        for n in stale:
            self._files.delete(self._of(n), False)
        return len(stale)
