"""Exact n-gram Jaccard join and its groups, by signature trees.

1. Texts with equal shingle sets form classes; the smallest doc_id stands for its class.
2. Each class sends the prefix of its set to those tokens' groups. Two similar sets meet in at least one group, whatever the
   order of tokens: nothing is lost. Tokens go in hash order, but those known to be shared later and very common ones last, so
   that groups are few and small; a filter of fixed size knows them. Tokens of one class alone end here.
3. In each group neighbours in size order are candidates; each class checks those it meets most often. Classes linked so far
   share a component.
4. Groups that still hold several components, those with the same smallest member as one, are searched by signature trees: a
   dual traversal with labels, size ranges and OR-combined bitmaps leaves the pairs to be verified on the exact sets. Pairs
   within one component are skipped: the groups are those of the full graph of links, though copies and near copies by the
   thousand never make all their pairs. The members of a group's largest component, usually nearly all, are cut into cells of
   bounded rows and bytes and meet the cells of the other members only; each pair of cells is a task's unit of its own.

Trees stand below the token groups, not above them: the OR of some hundred texts' bitmaps is full and prunes nothing, so the
top levels are the groups that a shared rare token defines.

Defined results: null and empty texts, and texts without words, have an empty set and stay alone, as do null doc_ids that no
other text equals (their component is null); fewer words than a shingle are one shingle; rows that share a doc_id count as one
document; repeated rows keep a row each; an empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import contract
from .shingle_sets import bitmap, identity, may_be_similar, prefix_length, shingle_set, similar
from .signature_tree import SignatureTree, possible_pairs
from .workspace import Workspace, fresh

#: Tokens that a task counts at a time, and how often it must have met one to report it.
COUNTED, REPORTED = 1_000_000, 3
#: Classes that a task remembers to have sent.
REMEMBERED = 500_000
#: Bits of the filter of shared tokens: so many a document, between the least and the most. A full filter makes groups larger,
#: never wrong.
FILTER_BITS_EACH, FILTER_BITS_LEAST, FILTER_BITS_MOST = 64, 1 << 25, 1 << 29
#: Bytes of bitmaps in a cell of the tree search.
CELL_BYTES = 16 << 20
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that a task holds few sets at a time."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def _longs(values: np.ndarray | list) -> pa.Array:
    return pa.array(values, pa.int64())


def _measure(texts: DataFrame) -> DataFrame:
    """A row per document (doc_id, n, c1, c2), and rows (token, times) for tokens that are frequent within a task.

    Only tokens in the first two fifths of a set in hash order are counted: later ones hardly enter a prefix.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64()), ("token", pa.int64()), ("times", pa.int64())])

    def frequent(held: list[np.ndarray]) -> pa.RecordBatch:
        token, times = np.unique(np.concatenate(held), return_counts=True)
        on = times >= REPORTED
        none = [pa.nulls(int(on.sum()), f.type) for f in list(schema)[:4]]
        return pa.RecordBatch.from_arrays([*none, _longs(token[on].view(np.int64)), _longs(times[on])], schema=schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in _small(batches):
            sizes, names = [], []
            for t in b.column(1):
                s = shingle_set(t.as_py())
                sizes.append(len(s))
                names.append(identity(s))
                held.append(s[: len(s) * 2 // 5 + 1])
                size += len(held[-1])
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), _longs([x for x, _ in names]), _longs([x for _, x in names]), none, none], schema=schema)
            if size >= COUNTED:
                yield frequent(held)
                held, size = [], 0
        if held:
            yield frequent(held)

    return texts.mapInArrow(measure, "doc_id long, n int, c1 long, c2 long, token long, times long")


def _range_of(tokens: np.ndarray, ranges: int) -> np.ndarray:
    return ((tokens * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(ranges)


def _member(sorted_tokens: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    if not len(sorted_tokens):
        return np.zeros(len(tokens), dtype=bool)
    return sorted_tokens[np.minimum(np.searchsorted(sorted_tokens, tokens), len(sorted_tokens) - 1)] == tokens


class _NewClasses:
    """Which sets a task hasn't met yet, as far as it remembers."""

    def __init__(self) -> None:
        self.sent: set[int] = set()

    def __call__(self, name: int) -> bool:
        if name in self.sent:
            return False
        if len(self.sent) >= REMEMBERED:
            self.sent.clear()
        self.sent.add(name)
        return True


def _packed(at: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Columns cut by range and packed."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    cuts = list(zip(starts, np.append(starts[1:], len(at)), strict=True))
    return [pa.array(at[starts].astype(np.int32)), *(pa.array([v[i:j].tobytes() for i, j in cuts], pa.binary()) for v in (c[order] for c in columns))]


def _ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(range, packed columns, each joined) of rows sorted by range."""
    at, held = None, []
    for b in batches:
        for r, *parts in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
            if r != at and held:
                yield at, [b"".join(c) for c in zip(*held, strict=True)]
                held = []
            at = r
            held.append(parts)
    if held:
        yield at, [b"".join(c) for c in zip(*held, strict=True)]


def filter_bits(documents: int, ranges: int) -> int:
    """Bits of one range's filter."""
    whole = min(FILTER_BITS_MOST, max(FILTER_BITS_LEAST, FILTER_BITS_EACH * documents))
    return max(64, whole // ranges // 8 * 8)


def _shared_filter(texts: DataFrame, ranges: int, bits: int) -> np.ndarray:
    """Bits, by range, of tokens that several classes hold among the first two fifths of their sets."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = _NewClasses()
        for b in _small(batches):
            sets = [s for s in (shingle_set(t.as_py()) for t in b.column(1)) if len(s) and new(identity(s)[0])]
            if sets:
                token = np.concatenate([s[: len(s) * 2 // 5 + 1] for s in sets])
                yield pa.RecordBatch.from_arrays(_packed(_range_of(token, ranges), token), names=["range", "tokens"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, (tokens,) in _ranges_of(batches):
            token = np.sort(np.frombuffer(tokens, np.uint64))
            twice = token[1:][token[1:] == token[:-1]]
            on = np.zeros(bits, dtype=bool)
            on[((twice >> np.uint64(8)) % np.uint64(bits)).astype(np.int64)] = True
            yield pa.RecordBatch.from_pydict({"range": pa.array([r], pa.int32()), "bits": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    marked = texts.mapInArrow(spread, "range int, tokens binary").repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(mark, "range int, bits binary")
    out = np.zeros((ranges, bits // 8), dtype=np.uint8)
    found = marked.toArrow()  # the filter's bits in all
    for r, own in zip(found.column("range").to_pylist(), found.column("bits"), strict=True):
        out[r] = np.frombuffer(own.as_buffer(), np.uint8)
    return out


def _postings(texts: DataFrame, known: Broadcast, ranges: int, bits: int, percent: int) -> DataFrame:
    """(token, class, n, m): the prefix tokens that m > 1 classes share, and those classes.

    known: common tokens, over how many ranges each is spread, and the filter of shared ones. Tokens travel packed, by range of
    their mixed hash; a task sends each class once, so that exact copies, however many, add a row per task. Common tokens are
    dealt over ranges by class; these keep all their rows.
    """
    bits = np.uint64(bits)

    def prefix(s: np.ndarray) -> np.ndarray:
        common, _, shared = known.value
        place = (s >> np.uint64(8)) % bits
        late = (shared[_range_of(s, ranges).astype(np.int64), (place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
        last = _member(common, s)
        rank = np.where(last, 2, late)
        size = prefix_length(len(s), percent)
        return s[np.argsort(rank, kind="stable")[:size]] if rank.any() else s[:size]

    def _fan(token: np.ndarray) -> np.ndarray:
        common, fans, _ = known.value
        out = np.ones(len(token), dtype=np.uint64)
        hot = _member(common, token)
        out[hot] = fans[np.searchsorted(common, token[hot])]
        return out

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = _NewClasses()
        for b in _small(batches):
            tokens, classes, sizes = [], [], []
            for t in b.column(1):
                s = shingle_set(t.as_py())
                if len(s) and new(own := identity(s)[0]):
                    tokens.append(prefix(s))
                    classes.append(own)
                    sizes.append(len(s))
            if not tokens:
                continue
            each = np.array([len(t) for t in tokens])
            token, cls, size = np.concatenate(tokens), np.repeat(np.array(classes, np.int64), each), np.repeat(np.array(sizes, np.int32), each)
            moved = cls.view(np.uint64) % _fan(token)
            yield pa.RecordBatch.from_arrays(_packed((_range_of(token, ranges) + moved) % np.uint64(ranges), token, cls, size), names=["range", "tokens", "classes", "sizes"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in _ranges_of(batches):
            token, cls, size = (np.frombuffer(c, kind) for c, kind in zip(columns, (np.uint64, np.int64, np.int32), strict=True))
            order = np.lexsort((cls, token))
            token, cls, size = token[order], cls[order], size[order]
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])])
            token, cls, size = token[new], cls[new], size[new]
            starts = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1])
            times = np.diff(np.append(starts, len(token)))
            fan = _fan(token).astype(np.int64)
            m, keep = np.repeat(times, times) * fan, (np.repeat(times, times) > 1) | (fan > 1)
            yield pa.RecordBatch.from_arrays([_longs(token[keep].view(np.int64)), _longs(cls[keep]), pa.array(size[keep], pa.int32()), _longs(m[keep])], names=["token", "class", "n", "m"])

    packed = texts.mapInArrow(spread, "range int, tokens binary, classes binary, sizes binary")
    return packed.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(meet, "token long, class long, n int, m long")


def _sets(texts: DataFrame) -> DataFrame:
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            sets = [shingle_set(t.as_py()) for t in b.column(1)]
            columns = [pa.array([len(s) for s in sets], pa.int32()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n", "bits", "tokens"])

    return texts.mapInArrow(whole, "doc_id long, n int, bits binary, tokens binary")


def _verified(work: Workspace, sets: DataFrame, pairs: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose exact sets are similar, staged. Bitmaps meet first, whole sets only where those leave a chance."""

    def each(test):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _small(batches):
                ok = [test(np.frombuffer(x, np.uint64), n, np.frombuffer(y, np.uint64), m) for x, n, y, m in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=PAIRS).filter(pa.array(ok, pa.bool_()))

        return run

    def beside(left: DataFrame, column: str) -> DataFrame:
        one = sets.select(F.col("doc_id").alias("a"), F.col(column).alias("x"), F.col("n").alias("nx"))
        other = sets.select(F.col("doc_id").alias("b"), F.col(column).alias("y"), F.col("n").alias("ny"))
        return left.join(one, "a").join(other, "b").select("a", "b", "x", "nx", "y", "ny")

    close = work.stage(beside(pairs.distinct(), "bits").mapInArrow(each(lambda x, n, y, m: may_be_similar(x, n, y, m, percent)), "a long, b long"), f"{name}-close")
    links = work.stage(beside(close, "tokens").mapInArrow(each(lambda x, n, y, m: similar(x, y, percent)), "a long, b long").distinct(), f"{name}-links")
    work.drop(f"{name}-close")
    return links


def _neighbours(postings: DataFrame, percent: int, cell_rows: int, best: int) -> DataFrame:
    """Pairs of neighbours by size in the groups (in cells of them, where they are large): for each class the best most frequent."""
    cell = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.ceil(F.col("m") / cell_rows))
    order = Window.partitionBy("token", cell).orderBy("n", "doc_id")
    near = postings.withColumn("b", F.lag("doc_id").over(order)).withColumn("nb", F.lag("n").over(order))
    near = near.where((F.col("b") != F.col("doc_id")) & (F.col("nb") * 100 >= F.col("n") * percent))
    counted = near.groupBy(F.col("doc_id").alias("a"), "b").agg(F.count(F.lit(1)).alias("times"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("times"), "b")))
    return ranked.where(F.col("rank") <= best).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _chained(postings: DataFrame, percent: int, cell_rows: int, turn: int) -> DataFrame:
    """A pair for each two components that follow each other in a group, in an order drawn by token and turn."""
    cell = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.ceil(F.col("m") / cell_rows))
    order = Window.partitionBy("token", cell).orderBy(F.xxhash64("root", "token", F.lit(turn)), "root", F.xxhash64("doc_id", "token", F.lit(turn)))
    near = postings.withColumn("b", F.lag("doc_id").over(order)).withColumn("nb", F.lag("n").over(order)).withColumn("rb", F.lag("root").over(order))
    near = near.where((F.col("rb") != F.col("root")) & (F.least("nb", "n") * 100 >= F.greatest("nb", "n") * percent))
    return near.select(F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b"))


def _families(open_groups: DataFrame) -> DataFrame:
    """(family, doc_id, n, root): the groups of tokens with the same smallest member as one.

    Near copies share most of their tokens; their groups, which hold the same pairs over and over, become one family.
    """
    first = open_groups.groupBy("token").agg(F.min("doc_id").alias("family"))
    return open_groups.join(first, "token").select("family", "doc_id", "n", "root").distinct()


def _celled(families: DataFrame, cell_rows: int, least_rows: int = 64, heavy: int = 1000) -> DataFrame:
    """The staged families with each member's cell and the pairs of cells (lo, hi) it takes part in, a row for each.

    Cells below "large" hold the largest component, whose members need not meet each other; the others meet all cells. Cells
    are small while the others are few, so that a group is many units, and at most cell_rows rows and about CELL_BYTES. What a
    member must know of its family is broadcast for families with more than one in heavy of all rows, heavy at most, so that
    no family is a hot key.
    """
    total = families.count()
    bitmap_bytes = 8 * F.pow(F.lit(2), F.greatest(F.lit(0), F.least(F.lit(14), F.ceil(F.log2(F.max("n"))) - 2)))
    by_root = families.groupBy("family", "root").agg(F.count(F.lit(1)).alias("own"), bitmap_bytes.alias("width"))
    whole = by_root.groupBy("family").agg(F.max_by("root", F.struct("own", "root")).alias("first"), F.max("own").alias("most"), F.sum("own").alias("m"), F.max("width").alias("width"))
    size = F.greatest(F.lit(least_rows), F.least(F.lit(cell_rows), F.ceil((F.col("m") - F.col("most")) / 16)))
    size = F.greatest(F.lit(1), F.least(size, F.floor(F.lit(CELL_BYTES) / F.col("width")), F.lit(cell_rows)))
    whole = whole.select("family", "first", F.ceil(F.col("most") / size).cast("int").alias("large"), F.ceil((F.col("m") - F.col("most")) / size).cast("int").alias("small"), (F.col("m") * heavy > total).alias("heavy"))
    known = F.broadcast(whole.where("heavy"))
    rows = families.join(known, "family").unionByName(families.join(known.select("family"), "family", "left_anti").join(whole.where("not heavy"), "family"))
    rows = rows.where("small > 0").withColumn("in_first", F.col("root") == F.col("first"))
    drawn = F.xxhash64("doc_id", F.lit(5))
    cell = F.when(F.col("in_first"), F.pmod(drawn, F.col("large"))).otherwise(F.col("large") + F.pmod(drawn, F.col("small"))).cast("int")
    others = F.sequence(F.when(F.col("in_first"), F.col("large")).otherwise(F.lit(0)), F.col("large") + F.col("small") - 1)
    meets = F.transform(others, lambda d: F.struct(F.least(F.col("cell"), d).alias("lo"), F.greatest(F.col("cell"), d).alias("hi")))
    rows = rows.withColumn("cell", cell).withColumn("meet", F.explode(meets))
    return rows.select("family", F.col("meet.lo").alias("lo"), F.col("meet.hi").alias("hi"), "cell", "n", "doc_id", "root")


def _searched(families: DataFrame, sets: DataFrame, percent: int, cell_rows: int) -> DataFrame:
    """Pairs of different components that signature trees leave open, family by family."""
    rows = _celled(families, cell_rows).join(sets.select("doc_id", "bits"), "doc_id").select("family", "lo", "hi", "cell", "n", "doc_id", "root", "bits")
    rows = rows.repartition("family", "lo", "hi").sortWithinPartitions("family", "lo", "hi", "cell", "n", "doc_id")

    def pairs(key: tuple, held: list[tuple]) -> pa.RecordBatch:
        cell, n, ids, root = (np.concatenate([h[k] for h in held]) for k in range(4))
        bits = [np.frombuffer(x, np.uint64) for h in held for x in h[4]]
        split = int(np.searchsorted(cell, key[1], side="right"))
        parts = [slice(0, len(cell))] if key[1] == key[2] else [slice(0, split), slice(split, len(cell))]
        trees = [(ids[p], SignatureTree(root[p], n[p], bits[p])) for p in parts if len(ids[p])]
        if len(trees) < len(parts):
            return pa.RecordBatch.from_pydict({"a": [], "b": []}, schema=PAIRS)
        (ids_a, a), (ids_b, b) = trees[0], trees[-1]
        found = possible_pairs(a, b, percent)
        x = np.concatenate([ids_a[p] for p, _ in found]) if found else np.zeros(0, np.int64)
        y = np.concatenate([ids_b[q] for _, q in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([_longs(np.minimum(x, y)), _longs(np.maximum(x, y))], schema=PAIRS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ready = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            ends = np.append(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys))
            cell, n, ids, root = (batch.column(k).to_numpy() for k in (3, 4, 5, 6))
            bits, start = batch.column(7).to_pylist(), 0
            for end in ends:
                here = tuple(int(v) for v in keys[start])
                if here != key and held:
                    ready.append(pairs(key, held))
                    held = []
                key = here
                held.append((cell[start:end], n[start:end].astype(np.int64), ids[start:end], root[start:end], bits[start:end]))
                start = end
            yield from pa.Table.from_batches(ready, PAIRS).combine_chunks().to_batches()
            ready = []
        if held:
            yield pairs(key, held)

    return rows.mapInArrow(search, "a long, b long")


def _smallest(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Of the rows with equal values of by the smallest, in the order of its columns that have one."""
    ordered = [c for c, kind in rows.dtypes if c in columns and not kind.startswith(("map", "array", "struct", "variant", "interval"))]
    one = rows.groupBy(*by).agg(F.min_by(F.struct(*columns), F.struct(*ordered) if ordered else F.lit(0)).alias("_row"))
    return one.select("_row.*")


def _set_name(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        sets = (shingle_set(t.encode()) if t else None for t in texts)
        yield pd.Series([None if s is None or not len(s) else "{},{}".format(*identity(s)) for s in sets], index=texts.index, dtype=object)


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """documents without near copies: of each group the document with the smallest doc_id stays, with all its own columns.

    Rows that share a doc_id are one document: all its different texts stay, and of rows with one text too the smallest. A row
    without an id goes if a document with one has an equal set; of several such rows with equal sets the smallest stays. Rows
    without words are no copies of anything, but a row repeated under its id is one document.
    """
    work, columns = Workspace(documents.sparkSession, "one-of-each"), documents.columns
    rows = work.stage(grouped(documents, **options), "rows")
    kept = rows.where("doc_id is not null and doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    key = fresh(documents, "_known")

    def of(ids: DataFrame) -> DataFrame:
        return documents.join(ids.select(F.col("doc_id").alias(key)), documents["doc_id"].cast("long") == F.col(key), "left_semi")

    out = of(kept.where("n = 1"))
    repeated = work.stage(kept.where("n > 1"), "repeated")
    if not repeated.isEmpty():
        out = out.unionByName(_smallest(of(repeated), ["doc_id", "text"], columns))
    nameless = documents.where("doc_id is null")
    if not nameless.isEmpty():
        name, known = fresh(documents, "_set"), rows.where("doc_id is not null and n_shingles > 0").select("c1", "c2").distinct()
        nameless = nameless.withColumn(name, F.pandas_udf(_set_name, "string")("text"))
        alone = nameless.where(F.col(name).isNotNull()).join(known.select(F.concat_ws(",", "c1", "c2").alias(name)), name, "left_anti")
        out = out.unionByName(_smallest(alone, [name], columns)).unionByName(nameless.where(F.col(name).isNull()).select(*columns))
    return out.select(*columns)


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of documents."""
    return grouped(documents, **options).select("doc_id", "n_shingles", "component_id")


def grouped(documents: DataFrame, percent: int = 80, common_over: int = 64, common_tokens: int = 200_000, cell_rows: int = 2048, range_documents: int = 4000) -> DataFrame:
    """(doc_id, n_shingles, component_id, c1, c2): also the 128 bits that name each row's set."""
    spark, texts = documents.sparkSession, _texts(documents)
    work = Workspace(spark, "jaccard-join")
    measured = work.stage(_measure(texts), "measured")
    own = measured.where("n is not null").select("doc_id", "n", "c1", "c2")
    classes = work.stage(own.where("n > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("doc_id")), "classes")
    # The order of tokens is free; this bounded list only keeps groups small.
    listed = measured.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") > common_over).orderBy(F.desc("times"), "token").limit(common_tokens)
    often = listed.toArrow()
    common, times = often.column("token").to_numpy().astype(np.int64).view(np.uint64), often.column("times").to_numpy()
    rows = own.count()
    work.release()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // range_documents)
    fans = np.clip(times // range_documents, 8, ranges).astype(np.uint64)
    order, bits = np.argsort(common), filter_bits(rows, ranges)
    known = spark.sparkContext.broadcast((common[order], fans[order], _shared_filter(texts, ranges, bits)))
    work.release()
    met = work.stage(_postings(texts, known, ranges, bits, percent), "met")
    known.destroy()
    postings = work.stage(met.join(classes.select(F.col("c1").alias("class"), "doc_id"), "class").select("token", "doc_id", "n", "m"), "postings")
    work.drop("met")
    sets = work.stage(_sets(texts.join(postings.select("doc_id").distinct(), "doc_id", "left_semi")), "sets")
    links = _verified(work, sets, _neighbours(postings, percent, cell_rows, best=2), percent, "neighbours")
    for turn in (1, 2):
        roots = contract(work, links, f"roots-{turn}")
        labelled = postings.join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
        labelled = work.stage(labelled, f"labelled-{turn}")
        several = labelled.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
        open_groups = labelled.join(several, "token", "left_semi")
        if turn == 1:
            more = _chained(open_groups, percent, cell_rows, turn)
        else:
            more = _searched(work.stage(_families(open_groups), "families"), sets, percent, cell_rows)
        links = work.stage(links.unionByName(_verified(work, sets, more, percent, f"turn-{turn}")), f"links-{turn}")
        work.drop(f"labelled-{turn}")
    work.drop("sets")
    work.drop("postings")
    roots = contract(work, links, "groups").select(F.col("node").alias("doc_id"), "root")
    named = classes.join(roots, "doc_id", "left").select("c1", "c2", F.coalesce("root", "doc_id").alias("component_id"))
    out = own.join(named, ["c1", "c2"], "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), alone.alias("component_id"), "c1", "c2")
