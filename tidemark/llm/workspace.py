"""Shared folder, staged tables and small helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in every contract of this package: blank and the controls 0x09-0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER_ASCII, LOWER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a temporary one if all runs in this process (as
    in tests); on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


class Workspace:
    """Tables staged as Parquet below the shared folder. A lost executor costs a task of the writer, never the table."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root, self.leaves, self.staged = spark, f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}", False, 0

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def stage(self, df: DataFrame, name: str, rows_held: int | None = None) -> DataFrame:
        """Write df and read it back: cuts its lineage. What is never dropped goes when the driver ends. rows_held bounds the rows
        of a row group, so those that a reader holds at a time, where single rows are large."""
        path = f"{self.root}/{name}"
        to = df.write.mode("overwrite")
        (to.option("parquet.block.row.count.limit", rows_held) if rows_held else to).parquet(path)
        if not self.leaves:
            root, files = self._path()
            self.leaves = files.deleteOnExit(root)
        self.staged += 1
        if self.staged % 3 == 0:
            self.release()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete a staged table, or with no name all of them, once nothing reads it any more."""
        path, files = self._path(name)
        files.delete(path, True)
        self.release()

    def release(self) -> None:
        """Ask the driver to collect its garbage: shuffle files and broadcasts of finished steps go only then."""
        self.spark._jvm.System.gc()


def lower_ascii(column) -> Column:
    """A-Z to a-z; all other characters stay."""
    return F.translate(column, UPPER_ASCII, LOWER_ASCII)


def fold(key: str, folds: int) -> Column:
    """crc32 of a key as text, modulo the number of folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
