"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pivot_index, quality, secrets, toxicity
from tidemark.llm.decontamination import contained_items, without_contaminated
from tidemark.llm.html_text import extract_main_text
from tidemark.llm.jaccard_join import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.token_counts import UnigramVocabulary, count_tokens
from tidemark.llm.warc import decide, read_archives, write_archives
from tidemark.llm.workspace import fold

LONG = " ".join(f"word{k}" for k in range(60_000))
DOCS = [
    (1, "a b c d e f g h", "en", "s", 15), (2, "A B C d e f g h", "en", "s", 15), (3, None, None, None, None), (4, "", "en", "s", 0), (5, " \n\t ", "en", None, 4), (6, LONG, "en", "s", len(LONG)), (7, "one two", "en", "t", 7),
    (8, "one two", "en", "t", 7), (8, "one two", "en", "t", 7), (None, "null id text here it is", "en", "t", 5), (9, 'x token = "04dbababab91ab85687d33eeaaf9ac699e1188f9" y', "en", "s", 50),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["score", "predicted", "shard", "bin", "hash", "shingle", "item_id", "token", "w", "i", "n", "component_id", "_findings", "_words", "_score", "value", "label", "y", "kind"]


@pytest.fixture(scope="module", params=["rows", "empty", "clashing"])
def docs(spark, request):
    df = spark.createDataFrame(DOCS if request.param != "empty" else [], SCHEMA)
    if request.param == "clashing":
        df = df.select("*", *(F.lit(-1.5).alias(c) for c in EXTRA))
    return df.cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 1, 1), (4, 0, 0), (7, None, None), (None, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "B c D e f"), (2, None), (3, ""), (4, "one two"), (None, "zz yy xx ww vv"), (5, " ".join(f"word{k}" for k in range(500, 530)))], "item_id long, text string")


def test_scores(docs, labels):
    for model, score in ((quality.train(docs, labels, fold("doc_id", 3) != 1), quality.score_quality), (toxicity.train(docs, labels, fold("doc_id", 5) != 0), toxicity.score_toxicity)):
        rows = score(docs, model).select("score", "predicted").collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    kept = quality.accepted(docs, quality.train(docs, labels, fold("doc_id", 3) != 1))
    assert kept.columns == docs.columns
    if "score" in docs.columns:
        assert all(r["score"] == -1.5 for r in kept.collect())


def test_secrets(spark, docs):
    model = secrets.train(secrets.example_findings(spark, 800), trees=8)
    found = secrets.findings(docs, model).where("is_secret").collect()
    out = secrets.redact(docs, model)
    assert out.columns == docs.columns and out.count() == docs.count()
    if docs.count():
        assert [r["doc_id"] for r in found] == [9]
        text = out.where("doc_id = 9").first()
        assert text["text"] == 'x token = "[SECRET]" y' and text["n_chars"] == len(text["text"])
        assert out.where("text is null").count() == 1


def test_packing(docs):
    rows = pack(docs, capacity=2048).collect()
    assert len(rows) == (docs.count() + 29 if docs.count() else 0)  # the long document has 30 pieces
    bins = {}
    for r in rows:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for own in bins.values():
        assert sum(r["n_words"] for r in own) <= 2048
        assert len({r["source"] for r in own}) == len(own) == len({r["cluster"] for r in own})


def test_decontamination(docs, benchmark):
    got = {(r["doc_id"], r["item_id"], r["n_item"]) for r in contained_items(docs, benchmark).collect()}
    kept = without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    if docs.count():
        assert got == {(1, 1, 1), (2, 1, 1), (7, 4, 1), (8, 4, 1), (6, 5, 26)}
        assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 9]
        assert {(r["doc_id"], r["item_id"]) for r in contained_items(docs, benchmark, broadcast_bytes=0).collect()} == {x[:2] for x in got}
    assert contained_items(docs, benchmark.limit(0)).count() == 0


def test_near_duplicates(docs):
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    if rows:
        got = sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None)
        assert got == [(1, 4, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 59996, 6), (7, 1, 7), (8, 1, 7), (8, 1, 7), (9, 1, 9)]
        assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]


def test_token_counts(docs):
    vocabulary = UnigramVocabulary({"▁": -4.0, "▁a": -1.0, "a": -2.0, "b": -2.0, "▁b": -1.5, "c": -2.0}, False)
    rows = count_tokens(docs, vocabulary).select("doc_id", "text", "n_tokens").collect()
    assert len(rows) == docs.count() and all(r["n_tokens"] == 0 for r in rows if not r["text"])


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a&amp;b<p>c"), (2, None, None), (3, "u", ""), (4, "u v\n", "<p>a&amp;b<p>c"), (4, "u", "<p>a&amp;b<p>c"), (None, "u", "x"), (5, "u", "<b>" * 3000 + "deep")], "page_id long, url string, html string")
    pages = pages.withColumn("payload", F.lit(1)).withColumn("_digest", F.lit(2))
    texts = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract_main_text(pages).collect())
    assert texts == [(0, "x", 1), (1, "a&b\nc", 5), (2, "", 0), (3, "", 0), (4, "a&b\nc", 5), (4, "a&b\nc", 5), (5, "deep", 4)]
    rows = read_archives(write_archives(decide(pages))).collect()
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in rows)
    assert got == [(0, 1, "response", 0), (1, 14, "revisit", 4), (2, 0, "revisit", 3), (3, 0, "response", 0), (4, 14, "response", 0), (4, 14, "response", 0), (5, 9004, "response", 0)]
    assert all(r["kind"] == "record" for r in rows) and {r["url"] for r in rows} == {"u", None, "u v\n"}
    assert read_archives(write_archives(decide(pages.limit(0)))).count() == 0 and extract_main_text(pages.limit(0)).count() == 0


def test_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [nan, 1.0]), (4, None), (5, []), (None, [5.0, 5.0]), (6, [None, 1.0]), (100, [0.5, 0.5]), (7, [2.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(9)).withColumn("v", F.lit(9))
    vectors = pivot_index.quantised(df)
    got = [tuple(r) for r in pivot_index.top_k(vectors, F.col("id") % 100 == 0, k=4, block_rows=2, pivots=2).orderBy("query_id", "rank").collect()]
    one = 1024 * 1024
    assert got == [(0, 1, 7, 2 * one), (0, 2, 1, one), (0, 3, 2, one), (0, 4, 2, one), (100, 1, 7, one), (100, 2, 0, one // 2), (100, 3, 1, one // 2), (100, 4, 2, one // 2)]
    assert pivot_index.top_k(pivot_index.quantised(df.limit(0)), F.col("id") % 100 == 0).count() == 0
    assert pivot_index.top_k(vectors, F.col("id") < 0).count() == 0
