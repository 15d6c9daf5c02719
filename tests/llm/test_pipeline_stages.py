"""Stages of the pipeline and their operators against plain implementations on small tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination
from tidemark.llm.jaccard_join import _celled, filter_bits, near_duplicates, one_of_each
from tidemark.llm.packing import pack, pieces

from test_against_brute_force import components, corpus


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def contained(docs, items, percent=80):
    by_doc, by_item = {}, {}
    for table, out in ((docs, by_doc), (items, by_item)):
        for i, t in table:
            out[i] = out.get(i, frozenset()) | shingles(t)
    return {(d, i, len(y), len(x & y)) for d, x in by_doc.items() for i, y in by_item.items() if y and 100 * len(x & y) >= percent * len(y)}


def leaky(seed):
    """Items of all sizes, texts that hold them whole, in part (just above and just below the threshold) or not."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 2, 4, 5, 6, 7, 9, 12, 15, 16, 17, 30, 31, 32, 40, 63, 64, 90, 130, 200, 5, 5])] + [(3, "zz " * 7), (None, "null item of six words here"), (90, ""), (91, None)]
    docs = []
    for k in range(160):
        own = [word() for _ in range(rng.randint(0, 60))]
        for _, t in rng.sample(items[:-2], rng.randint(0, 3)):
            w = t.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice([word(), "X"])
            own += w if rng.random() < 0.7 else [x.upper() for x in w]
            own += [word() for _ in range(rng.randint(0, 9))]
        docs.append((k if k % 40 else None, "\t".join(own)))
    return docs + docs[:20], items


@pytest.mark.parametrize("seed,broadcast_bytes", [(1, 1 << 26), (2, 0)])
def test_containment(spark, seed, broadcast_bytes):
    docs, items = leaky(seed)
    documents, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r)[:4] for r in decontamination.contained_items(documents, benchmark, broadcast_bytes=broadcast_bytes).collect()}
    want = contained(docs, items)
    assert got == want and len(want) > 30
    kept = decontamination.without_contaminated(documents, benchmark, broadcast_bytes=broadcast_bytes).collect()
    leaks = {d for d, *_ in want}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept) == sorted((d is None, d or 0, t) for d, t in docs if d not in leaks)


def test_sketches_decide_by_size_class(spark):
    _, items = leaky(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    shingled = decontamination.item_shingles(benchmark)
    rows = decontamination.sketch(shingled).groupBy("item_id", "size_class", "n_item", "least_hits").agg(F.count(F.lit(1)).alias("k")).collect()
    for r in rows:
        n, largest = r["n_item"], 2 ** (r["size_class"] + 1) - 1
        assert 2 ** r["size_class"] <= n <= largest
        assert r["k"] == min(n, largest - math.ceil(largest * 0.8) + 1)
        assert r["least_hits"] == max(1, r["k"] - (n - math.ceil(n * 0.8)))
    assert len({(r["size_class"], r["k"]) for r in rows if r["n_item"] > 20}) == len({r["size_class"] for r in rows if r["n_item"] > 20})
    assert decontamination.sketch(shingled).count() < shingled.count() / 2
    none = decontamination.sketch(shingled).limit(0)  # without sketches nothing is found: the search decides
    assert decontamination.candidates(benchmark.withColumnRenamed("item_id", "doc_id"), none).count() == 0


def test_one_of_each(spark):
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    rows = [
        (3, a, "x"), (4, a.upper(), "x"), (2, b, "z"), (2, b, "y"), (2, "other text of document two, not the same at all", "x"), (7, b, "x"), (None, a, "x"), (None, "nobody else has this text, it is said", "b"),
        (None, "Nobody else has this  text, it is said", "a"), (None, "", "x"), (None, None, "x"), (8, "", "x"), (9, None, "x"), (9, None, "w"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("tags", F.create_map(F.lit("k"), F.lit(1))).withColumn("n", F.lit(0)).withColumn("_known", F.lit(1))
    out = one_of_each(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"] or 0), r["text"] or "", r["source"]) for r in out.collect())
    assert got == sorted([(3, a, "x"), (2, b, "y"), (2, rows[4][1], "x"), (0, rows[8][1], "a"), (0, "", "x"), (0, "", "x"), (8, "", "x"), (9, "", "w")])


def test_one_of_each_keeps_the_smallest_of_every_group(spark):
    texts = corpus(4)
    got = sorted(r["doc_id"] for r in one_of_each(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    assert got == sorted({root for _, root in components(texts).values()})


def test_cells_meet_once(spark):
    rng = random.Random(6)
    rows = [(1, k, 10, 7 if k % 10 else k) for k in range(300)] + [(2, k, 10, k) for k in range(40)] + [(3, k, 10, 5) for k in range(9)] + [(9 + k // 2, k, 10, k) for k in range(4000)]
    rng.shuffle(rows)
    units = {}
    for r in _celled(spark.createDataFrame(rows, "family long, doc_id long, n int, root long"), 2048, least_rows=16).collect():
        units.setdefault((r["family"], r["lo"], r["hi"]), []).append(r)
    assert max(map(len, units.values())) < 80
    met = {}
    for (family, lo, hi), members in units.items():
        for x in members:
            for y in members:
                if x["doc_id"] < y["doc_id"] and x["root"] != y["root"] and {x["cell"], y["cell"]} == {lo, hi}:
                    met[family, x["doc_id"], y["doc_id"]] = met.get((family, x["doc_id"], y["doc_id"]), 0) + 1
    by = {}
    for family, doc_id, _, root in rows:
        by.setdefault(family, []).append((doc_id, root))
    assert met == {(f, i, j): 1 for f, own in by.items() for i, p in own for j, q in own if i < j and p != q}


def test_filter_has_bits_at_every_size():
    assert all(filter_bits(n, max(12, n // 4000)) >= 64 for n in (0, 10**4, 10**7, 10**10, 10**12))
    assert filter_bits(10**5, 25) * 25 <= 1 << 25 < filter_bits(10**7, 2500) * 2500


def test_many_near_copies(spark):
    base = " ".join(f"w{k}" for k in range(60))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit(base), F.when(F.col("id") % 2 == 0, F.concat(F.lit(" x"), F.col("id"))).otherwise(F.lit(""))).alias("text"))
    other = spark.createDataFrame([(50_000 + k, base[: 100 + 20 * k] + f" own{k} words{k} stand{k} here{k} now{k}") for k in range(5)], "doc_id long, text string")
    got = near_duplicates(docs.unionByName(other)).groupBy("component_id").count().collect()
    assert max(r["count"] for r in got) >= 20_000


def test_packing_against_a_plain_best_fit(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(["w"] * rng.choice([0, 1, 5, 20, 20, 60, 99, 100, 101, 250])) + rng.choice(["", "", " a", " b"]), rng.choice("sttuuvxyz")) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pack(docs, capacity=100, shard_rows=10_000).collect()
    order = sorted((r.asDict() for r in pieces(docs, 100).collect()), key=lambda r: (-r["n_words"], r["doc_id"], r["cluster"], r["piece"], r["source"]))
    bins, want = [], {}
    for p in order:
        fits = [(100 - b["size"], n) for n, b in enumerate(bins) if b["size"] + p["n_words"] <= 100 and p["source"] not in b["sources"] and p["cluster"] not in b["clusters"]]
        least = min((r for r, _ in fits), default=None)
        want[p["doc_id"], p["piece"]] = least
        at = next(r["bin"] for r in got if (r["doc_id"], r["piece"]) == (p["doc_id"], p["piece"]))
        if least is None:
            assert at == len(bins)
            bins.append({"size": 0, "sources": set(), "clusters": set()})
        else:
            assert (least, at) in fits  # the tightest, whichever of equals
        bins[at]["size"] += p["n_words"]
        bins[at]["sources"].add(p["source"])
        bins[at]["clusters"].add(p["cluster"])
    shards = {r["shard"] for r in pack(docs, capacity=10, shard_rows=100).collect()}
    assert len(shards) == -(-pieces(docs, 10).count() // 100)  # by pieces, not by documents
