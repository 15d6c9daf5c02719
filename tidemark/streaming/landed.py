"""Online assembly without a state in one task: what is open is a few control messages, units lie in a table by batch.

Each micro-batch meets the control messages of transactions that are still open (their opening, the block that stands open, what
is rolled back, what is prepared), and goes through the batch operators. Its units are landed with their transaction; those of
transactions that end in it are read back from the batch on in which the first of these began. The cost of a batch follows the
batch and what it puts out, not what is open, and a slot or a transaction, however large, is as many tasks as it has chunks.

Every batch writes folders of its own number, so one that runs again after a failure overwrites what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly
from ..operators.sequence import CHUNK, carry_last, running_sum

CONTROL = "slot int, seq long, kind string, xid long, subxid long, gid string, first_segment boolean, commit_lsn long, end_lsn long, batch long"
UNIT = "slot int, seq long, kind string, txn_key string, stream_xid long"
OUT = "slot int, txn_key string, mode string, gid string, commit_lsn long, end_lsn long, end_seq long, expected_changes long, ord long, seq long, kind string, stream_xid long"


class LandedAssembly:
    """A foreachBatch function over messages; out() is the table of what came out so far."""

    def __init__(self, path: str, chunk: int = CHUNK) -> None:
        self.path, self.chunk = path.rstrip("/"), chunk

    def _write(self, df: DataFrame, name: str, number: int) -> DataFrame:
        at = f"{self.path}/{name}/batch={number}"
        df.write.mode("overwrite").parquet(at)
        return df.sparkSession.read.schema(df.schema).parquet(at)

    def _read(self, spark: SparkSession, name: str, schema: str, low: int, high: int) -> DataFrame:
        """Rows of the batches from low to high; the folder's number is a column."""
        whole = spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        return whole.where(F.col("batch").between(low, high))

    def out(self, spark: SparkSession, upto: int = (1 << 62)) -> DataFrame:
        return self._read(spark, "out", OUT, 0, upto).drop("batch")

    def stale(self, spark: SparkSession, number: int, batches: int) -> DataFrame:
        """Openings of transactions that are still open after batch number and began more than so many batches before."""
        still = spark.read.schema(CONTROL).parquet(f"{self.path}/open/batch={number}")
        return still.where(F.col("kind").isin("S", "B", "b") & (F.col("batch") < number - batches)).select("slot", "seq", "kind", "xid", "gid", "batch")

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        names = [x.split()[0] for x in CONTROL.split(", ")]
        new = batch.withColumn("batch", F.lit(number).cast("long")).select(*names, *(c for c in ("transactional",) if c in batch.columns))
        before = spark.read.schema(CONTROL).parquet(f"{self.path}/open/batch={number - 1}") if number else spark.createDataFrame([], CONTROL)
        whole = self._write(before.unionByName(new, allowMissingColumns=True).withColumn("commit_ts", F.lit(None).cast("timestamp")), "work", number)

        named = self._write(assembly.openings(whole, self.chunk), "named", number)
        units = assembly.route(whole, self.chunk, named).where((F.col("batch") == number) & F.col("txn_key").isNotNull())
        units = units.select("slot", "seq", "kind", "txn_key", F.when(F.col("in_stream"), F.col("subxid")).alias("stream_xid"))
        self._write(units, "units", number)
        ends = self._write(assembly.endings(whole, self.chunk, named).select("slot", "txn_key", "outcome", "mode", "gid", "commit_lsn", "end_lsn", "end_seq"), "ends", number)
        gone = assembly.aborted_parts(whole, self.chunk, named)
        marks = self._marks(whole, named)
        self._write(self._put_out(spark, ends, gone, marks, number), "out", number)
        self._write(self._still_open(whole, marks, ends), "open", number)

    def _marks(self, whole: DataFrame, named: DataFrame) -> DataFrame:
        """Control messages of transactions with their key: openings, roll-backs of parts, prepares."""
        own = named.where((F.col("kind") == "S") & F.col("first_segment") | (F.col("kind") == "A") & (F.col("subxid") != F.col("xid")) | (F.col("kind") == "p")).drop("opened")
        key = lambda letter, name: F.concat_ws(":", F.lit(letter), F.coalesce(F.col(name).cast("string"), F.lit("0")), F.col("seq").cast("string"))
        normal = whole.where("kind = 'B'").withColumn("txn_key", key("N", "xid"))
        prepared = carry_last(whole.where("kind in ('b', 'P')"), F.when(F.col("kind") == "b", key("P", "gid")), "txn_key", ["slot"], "seq", self.chunk)
        return own.unionByName(normal).unionByName(prepared)

    def _put_out(self, spark: SparkSession, ends: DataFrame, gone: DataFrame, marks: DataFrame, number: int) -> DataFrame:
        began = marks.where(F.col("kind").isin("S", "B", "b")).groupBy("txn_key").agg(F.min("batch").alias("first_batch"))
        done = ends.where("outcome = 'commit'").join(began, "txn_key", "left")
        first = done.agg(F.min("first_batch").alias("f")).first()["f"]
        if first is None:
            return spark.createDataFrame([], OUT)
        units = self._read(spark, "units", UNIT, first, number).drop("batch", "slot").join(done.select("txn_key"), "txn_key", "left_semi")
        counted = units.groupBy("txn_key").agg(F.count(F.lit(1)).alias("expected_changes"))
        kept = units.join(gone, ["txn_key", "stream_xid"], "left_anti")
        kept = running_sum(kept, F.lit(1), "ord", ["txn_key"], "seq", self.chunk)
        rows = done.join(counted, "txn_key", "left").join(kept, "txn_key", "left").withColumn("expected_changes", F.coalesce("expected_changes", F.lit(0)))
        return rows.select(*(F.col(x.split()[0]).cast(x.split()[1]) for x in OUT.split(", ")))

    def _still_open(self, whole: DataFrame, marks: DataFrame, ends: DataFrame) -> DataFrame:
        names = [x.split()[0] for x in CONTROL.split(", ")]
        live = marks.join(ends.select("txn_key"), "txn_key", "left_anti").select(*names)
        # The last block marker says whether a block stands open, which need not be its transaction's first.
        last = whole.where("kind in ('S', 'E')").groupBy("slot").agg(F.max_by(F.struct(*names), "seq").alias("m")).select("m.*").where("kind = 'E' or not first_segment")
        return live.unionByName(last)
