"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by the size of their shingle sets, class c holding 2^c to 2^(c+1)-1 shingles. All items of a class have
one sketch length k, so chosen that a document with threshold of the class's largest item misses fewer than k of its shingles;
an item's sketch is its k smallest shingle hashes. A document that contains threshold of an item of n shingles misses at most
n - ceil(threshold * n) of them, so it holds the rest of the sketch at least: pairs with fewer sketch hits are no candidates,
and none that reaches the threshold is lost, however long the document.

1. Search: the hashes of a document's shingles meet the sketches. Only hits leave the scan.
2. Verification: of the documents in a candidate pair, and of no others, the exact shingles meet those of the candidate items,
   as text; pairs that are no candidates don't count.

DataFrame operations only. Sketches, item shingles and ids of candidate documents are broadcast where a sum of their bytes,
taken first, is below broadcast_bytes; beyond it the same joins are shuffled.

Defined results: words are runs of non-blanks after A-Z became a-z; a text of one to four words is one shingle of all its
words; null and empty texts have no shingle and match nothing, on either side; repeated rows of one doc_id or item_id count
as one text with the shingles of all, null ids are an id of their own; an empty table on either side gives no rows. Texts are
read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace, lower_ascii

SEPARATOR = " "
#: What a row of a broadcast table takes besides its strings, in bytes; an estimate on the safe side.
ROW_BYTES = 96
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def _positions(n: Column, width: int) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))))


def _hash(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*(F.get(words, at + k) for k in range(width)))


def _shingle(words: Column, at: Column, width: int) -> Column:
    return F.concat_ws(SEPARATOR, *(F.get(words, at + k) for k in range(width)))


def _each(rows: DataFrame, key: str, width: int) -> DataFrame:
    """(key, w, i): a row per shingle, by its words' array and its place."""
    return rows.select(key, words_of(F.col("text")).alias("w")).select(key, "w", F.explode(_positions(F.size("w"), width)).alias("i"))


def _required(n: Column, percent: int) -> Column:
    """ceil(n * percent / 100) in integers."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _bounded(table: DataFrame, texts: list[str], most: int) -> DataFrame:
    """table, to be broadcast if its bytes sum up to at most so many."""
    own = F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in texts), F.lit(ROW_BYTES)).cast("long"))
    return F.broadcast(table) if (table.agg(own.alias("n")).first()["n"] or 0) <= most else table


def item_shingles(items: DataFrame, width: int = 5) -> DataFrame:
    """(item_id, n_item, shingle, hash): the distinct shingles of each item."""
    each = _each(items, "item_id", width)
    distinct = each.select("item_id", _shingle(F.col("w"), F.col("i"), width).alias("shingle"), _hash(F.col("w"), F.col("i"), width).alias("hash")).distinct()
    return distinct.withColumn("n_item", F.count(F.lit(1)).over(Window.partitionBy("item_id")).cast("int"))


def sketch(shingles: DataFrame, percent: int = 80) -> DataFrame:
    """(item_id, size_class, n_item, hash, least_hits): the smallest hashes of each item, as many as its size class asks for."""
    own = Window.partitionBy("item_id").orderBy("hash")
    hashes = shingles.select("item_id", "n_item", "hash").distinct().withColumn("rank", F.row_number().over(own))
    sized = hashes.withColumn("size_class", F.floor(F.log2("n_item")).cast("int"))
    largest = F.pow(F.lit(2), F.col("size_class") + 1).cast("int") - 1
    length = F.least(F.col("n_item"), largest - _required(largest, percent) + 1)
    hits = F.greatest(F.lit(1), length - (F.col("n_item") - _required(F.col("n_item"), percent)))
    return sized.where(F.col("rank") <= length).select("item_id", "size_class", "n_item", "hash", hits.alias("least_hits"))


def candidates(documents: DataFrame, sketches: DataFrame, width: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id) of the pairs with enough hits in the item's sketch."""
    hashed = _each(documents, "doc_id", width).select("doc_id", _hash(F.col("w"), F.col("i"), width).alias("hash"))
    hits = hashed.join(_bounded(sketches.select("item_id", "hash", "least_hits"), ["item_id"], broadcast_bytes), "hash").distinct()
    return hits.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("hits"), F.first("least_hits").alias("least_hits")).where("hits >= least_hits").select("doc_id", "item_id")


def _of(rows: DataFrame, ids: DataFrame, key: str, how: str, most: int) -> DataFrame:
    """The rows whose key is among the ids (left_semi) or isn't (left_anti); a null key equals a null key."""
    known = ids.select(F.col(key).alias("_known")).distinct()
    return rows.join(_bounded(known, ["_known"], most), rows[key].eqNullSafe(known["_known"]), how)


def contained_items(documents: DataFrame, items: DataFrame, width: int = 5, percent: int = 80, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment) for every pair whose containment reaches percent / 100."""
    work = Workspace(documents.sparkSession, "decontamination")
    shingles = work.stage(item_shingles(items, width), "shingles")
    pairs = work.stage(candidates(documents, work.stage(sketch(shingles, percent), "sketches"), width, broadcast_bytes), "candidates")
    known = _bounded(_of(shingles, pairs, "item_id", "left_semi", broadcast_bytes), ["item_id", "shingle"], broadcast_bytes)
    each = _each(_of(documents.select("doc_id", "text"), pairs, "doc_id", "left_semi", broadcast_bytes), "doc_id", width)
    hashed = each.select("doc_id", _hash(F.col("w"), F.col("i"), width).alias("hash"), _shingle(F.col("w"), F.col("i"), width).alias("shingle"))
    met = hashed.join(known, ["hash", "shingle"]).select("doc_id", "item_id", "n_item", "shingle").distinct()
    found = met.groupBy("doc_id", "item_id").agg(F.first("n_item").alias("n_item"), F.count(F.lit(1)).alias("n_found")).where(F.col("n_found") * 100 >= F.col("n_item") * percent)
    chosen = pairs.select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item"))
    kept = found.join(chosen, found["doc_id"].eqNullSafe(chosen["_doc"]) & found["item_id"].eqNullSafe(chosen["_item"]), "left_semi")
    return kept.select("doc_id", "item_id", "n_item", "n_found", (F.col("n_found") / F.col("n_item")).alias("containment"))


def without_contaminated(documents: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, **options) -> DataFrame:
    """documents that contain no item, with all their columns."""
    leaks = contained_items(documents, items, broadcast_bytes=broadcast_bytes, **options).select("doc_id")
    leaks = Workspace(documents.sparkSession, "leaks").stage(leaks.distinct(), "ids")
    return _of(documents, leaks, "doc_id", "left_anti", broadcast_bytes)
