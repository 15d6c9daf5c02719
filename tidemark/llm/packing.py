"""Conflict-constrained best-fit packing of documents into training sequences.

A bin holds at most capacity tokens (words) and at most one piece of each source and of each duplicate cluster (texts equal
up to case and white space). Bins lie in order of their residual. A bin carries its sources and its clusters as bitmaps; the
search starts at the smallest residual that takes the piece and goes on to the successor until it finds the tightest
compatible bin. Pieces come longest first.

Documents longer than capacity are cut into pieces of capacity words, each filling a bin of its own, and one last piece that is
packed; a document without words is one piece of size 0. Shards, dealt by a hash of document and piece and never by source or
cluster, are packed independently, best fit within each: their number follows the number of pieces, counted first, so a task's
memory is bounded and no source, however frequent, meets in one task. A bin is named by shard and number, so a repeated task
gives the same bins.

Defined results: null texts are empty texts; null sources count as one source, null doc_ids are dealt and packed like others;
repeated rows are packed one by one (they share a cluster, so they lie in different bins); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

OUT = pa.schema([("shard", pa.int32()), ("bin", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("source", pa.string()), ("cluster", pa.int64())])
OUT_DDL = "shard int, bin long, doc_id long, piece int, first_word long, n_words long, source string, cluster long"


class BestFit:
    """Bins of one shard by residual."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.residual: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[set[int]] = []  # exact clusters, behind the bitmap
        self.level: dict[int, list[int]] = {}  # residual -> bins
        self.open = 0  # bit r: some bin has residual r
        self.lacking: dict[int, int] = {}  # source bit -> levels where a bin may lack it; a search that finds none clears the level

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin that takes a piece: the tightest compatible one, the oldest among equals, else a new one."""
        bit, mark = 1 << source, 1 << (cluster & 255)
        lacking = self.lacking.setdefault(source, self.open)
        at = size
        while True:
            ahead = (lacking & self.open) >> at
            if not ahead:
                break
            r = at + (ahead & -ahead).bit_length() - 1
            free = False
            for b in self.level[r]:
                if self.sources[b] & bit:
                    continue
                free = True
                if not self.clusters[b] & mark or cluster not in self.held[b]:
                    self._move(b, r, size, bit, mark, cluster)
                    return b
            if not free:
                lacking &= ~(1 << r)
                self.lacking[source] = lacking
            at = r + 1
        b = len(self.residual)
        self.residual.append(self.capacity)
        self.sources.append(0)
        self.clusters.append(0)
        self.held.append(set())
        self._move(b, None, size, bit, mark, cluster)
        return b

    def _move(self, b: int, r: int | None, size: int, bit: int, mark: int, cluster: int) -> None:
        if r is not None:
            own = self.level[r]
            own.remove(b)
            if not own:
                del self.level[r]
                self.open &= ~(1 << r)
        self.residual[b] -= size
        self.sources[b] |= bit
        self.clusters[b] |= mark
        self.held[b].add(cluster)
        r = self.residual[b]
        self.level.setdefault(r, []).append(b)
        self.open |= 1 << r
        for source in self.lacking:
            if not self.sources[b] >> source & 1:
                self.lacking[source] |= 1 << r


def pieces(documents: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, source, cluster, piece, first_word, n_words): no text leaves the scan."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), r"[^w]+", "")).cast("long")
    same = F.xxhash64(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")))
    sized = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), same.alias("cluster"), n.alias("_n"))
    last = F.when(F.col("_n") == 0, F.lit(0)).otherwise(F.floor((F.col("_n") - 1) / capacity)).cast("int")
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    first = F.col("piece").cast("long") * capacity
    return cut.select("doc_id", "source", "cluster", "piece", first.alias("first_word"), F.least(F.lit(capacity).cast("long"), F.col("_n") - first).alias("n_words"))


def pack(documents: DataFrame, capacity: int = 2048, shard_rows: int = 4096) -> DataFrame:
    """A row per piece with its bin; shards of shard_rows pieces in the mean."""
    cut = Workspace(documents.sparkSession, "packing").stage(pieces(documents, capacity), "pieces")
    shards = max(1, -(-cut.count() // shard_rows))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fit, codes = None, None, {}
        for batch in batches:
            columns = batch.to_pydict()
            bins = []
            for k in range(batch.num_rows):
                if columns["shard"][k] != shard:
                    shard, fit, codes = columns["shard"][k], BestFit(capacity), {}
                source = columns["source"][k]
                bins.append(fit.place(columns["n_words"][k], codes.setdefault(source, len(codes)), columns["cluster"][k]))
            yield pa.RecordBatch.from_pydict(columns | {"bin": bins}, schema=OUT)

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "piece"), F.lit(shards)).cast("int"))
    order = ["shard", F.desc("n_words"), "doc_id", "cluster", "piece", "source"]
    spread = dealt.repartition("shard").sortWithinPartitions(*order)
    return spread.select("shard", F.lit(0).cast("long").alias("bin"), "doc_id", "piece", "first_word", "n_words", "source", "cluster").mapInArrow(fill, OUT_DDL)
