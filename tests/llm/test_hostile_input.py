"""Hostile, damaged and very long input; caps that must not lose anything."""

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pivot_index, secrets
from tidemark.llm.html_text import main_text
from tidemark.llm.token_counts import UnigramVocabulary, count_tokens
from tidemark.llm.warc import decide, read_archives, record_bytes, salvage, write_archives

PAGES = {
    "open tags": ("<a " * 330_000, ""), "deep": ("<div>" * 60_000 + "x", "x"), "wrong ends": ("<b>" * 60_000 + "</i>" * 60_000 + "x", "x"), "raw": ("<svg>" * 100_000 + "t", "t"),
    "blocks in inlines": ("<b>" * 30_000 + "<p>x" * 30_000, "\n".join("x" * 30_000)), "quotes": ("<a x='\"'>y" * 60_000 + "<a x='", "y" * 60_000), "articles": ("<article>" * 40_000 + "t", "t"),
    "plain": ("<" * 300_000, "<" * 300_000), "comments": ("<!--" * 100_000, ""), "long": ("<p>" + "wort " * 400_000, ("wort " * 400_000).strip()),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_take_linear_time(name):
    html, text = PAGES[name]
    began = time.time()
    assert main_text(html) == text
    assert time.time() - began < 10


@pytest.mark.parametrize(
    "html,text",
    [
        ("<article><h1>T</h1><div class='related-work'><p>prior art</p></div><p>end of it</p></article>", "T\nprior art\nend of it"),
        ("<article><h1>T</h1><h2 id=social>S</h2><p>one two</p><div class='share-buttons'><a href=x>tweet</a></div></article>", "T\nS\none two"),
        ("<article class='post comments-open'><h1>T</h1><p>one two</p></article>", "T\none two"),
        ("<div id=content class='comments-closed'><h1>T</h1><p>one two</p></div>", "T\none two"),
        ("<article><div class=widget><p>all of the text is here</p></div></article>", "all of the text is here"),
        ("<article><p>some words here</p></article><ol class=commentlist><li><article class=comment-body><p>reader</p></article></ol>", "some words here"),
        ("<p title=\"unclosed>one</p><p>two</p>", "one\ntwo"), ("<p title='a>b'>one</p></ x>two</>", "one\ntwo"), ("<p>a < b <c", "a < b"),
        ("<svg><svg></svg>no</svg><p>yes</p>", "yes"), ("<p>x</p><SCRIPT>if (a</b/) '</p>'</SCRIPT\n><p>y</p>", "x\ny"),
    ],
)
def test_names_and_broken_tags(html, text):
    assert main_text(html) == text


def test_ties_of_density_go_to_the_earlier_block():
    assert main_text("<body><div><p>aaaa bbbb</p></div><div><p>cccc dddd</p></div></body>") == main_text("<div><p>aaaa bbbb</p></div><div><p>cccc dddd</p></div>")


def plain(page_id, payload):
    return zlib.decompress(record_bytes(page_id, "http://x", payload, None), 31)


def pack(data):
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def test_several_records_in_a_member():
    records = [plain(k, b"payload %d" % k * 20) for k in range(5)]
    rows = list(salvage(pack(b"".join(records)) + record_bytes(9, None, b"z", None)))
    assert [r.get("page_id") for r in rows] == [0, 1, 2, 3, 4, 9] and all(r["kind"] == "record" for r in rows)
    records[2] = records[2].replace(b"payload 2", b"payload X", 1)
    member = pack(b"".join(records))
    rows = list(salvage(member + record_bytes(9, None, b"z", None)))
    assert [r["page_id"] for r in rows if r["kind"] == "record"] == [0, 1, 3, 4, 9]
    assert [(r["offset"], r["length"]) for r in rows if r["kind"] == "gap"] == [(0, len(member))]


def test_truncated_member_gives_its_whole_records():
    noise = random.Random(1).randbytes(400_000)
    member = pack(plain(1, b"first") + plain(2, noise) + plain(3, noise[::-1]))
    rows = list(salvage(member[: len(member) * 3 // 4]))
    assert [r["page_id"] for r in rows if r["kind"] == "record"] == [1, 2]
    assert [(r["offset"], r["length"]) for r in rows if r["kind"] == "gap"] == [(0, len(member) * 3 // 4)]


def test_plain_archives_take_linear_time():
    one = plain(1, b"x" * 2000)
    began = time.time()
    assert sum(r["kind"] == "record" for r in salvage(one * 20_000)) == 20_000
    assert time.time() - began < 10


def test_urls_return_as_they_were(spark):
    urls = ["http://a/%20b", "u v\n", " lead", "tail\u00a0", "ü\u2028?q=1&r=%41#f", "plain", "", None, "a\x00b:\r\nX: y"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("html", F.concat(F.lit("p"), "page_id"))
    got = {r["page_id"]: r["url"] for r in read_archives(write_archives(decide(pages))).collect()}
    assert got == dict(enumerate(urls))


def test_long_pages_and_a_payload_that_most_share(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, F.lit("same")).when(F.col("id") == 0, F.repeat(F.lit("long "), 1_000_000)).otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 6))).alias("html"))
    rows = {r["page_id"]: r for r in read_archives(write_archives(decide(pages)), with_payload=False).collect()}
    assert len(rows) == 3000 and rows[0]["payload_bytes"] == 5_000_000
    assert {r["refers_to"] for k, r in rows.items() if k % 3} == {2999, None} and rows[2999]["record_type"] == "response"
    assert all((r["refers_to"] == k + 3) == (k % 6 == 0) for k, r in rows.items() if k % 3 == 0 and k > 3)


def test_counters_follow_the_vocabulary(spark):
    docs = spark.createDataFrame([(1, "aaaa")], "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    for k in range(1, 5):  # objects come and go, their addresses too
        vocabulary = UnigramVocabulary({"▁": -9.0, "a": -9.0, "a" * k: -1.0}, False, dummy_prefix=False)
        assert count_tokens(docs, vocabulary).first()["n_tokens"] == -(-4 // k)


def viterbi(text, scores):
    """Best score and fewest-start ties by trying every piece at every place."""
    text = "▁" + text.replace(" ", "▁")
    unknown, best = min(scores.values()) - 10, [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            if piece in scores and (best[end] is None or best[start][0] + scores[piece] > best[end][0]):
                best[end] = (best[start][0] + scores[piece], best[start][1] + 1)
        if text[end - 1] not in scores and (best[end] is None or best[end - 1][0] + unknown > best[end][0]):
            best[end] = (best[end - 1][0] + unknown, best[end - 1][1] + len(text[end - 1].encode()))
    return best[-1][1]


def test_token_counts_against_a_plain_search():
    rng = random.Random(3)
    scores = {"▁": -3.0} | {c: -4.0 - k / 8 for k, c in enumerate("abcde")}
    for _ in range(60):
        scores["".join(rng.choice("▁abcde") if k == 0 else rng.choice("abcde") for k in range(rng.randint(2, 5)))] = -rng.randint(8, 60) / 8
    count = UnigramVocabulary(scores, True).counter()
    for _ in range(300):
        text = "".join(rng.choice("abcde  xé漢") for _ in range(rng.randint(1, 40)))
        assert count(text) == viterbi(text, scores), text


def test_masks_stay_in_their_place(spark):
    model = secrets.train(secrets.example_findings(spark, 2000))
    key = "7602ad27cf5550de1c"
    text = f"the letter opens.\n\npassword=letter7Kq2 for\tall, password: letter7Kq2 and secret={key}, again {key}\n-----BEGIN RSA PRIVATE KEY-----\nMIIB9x\n-----END RSA PRIVATE KEY----- letter7Kq2x end"
    docs = spark.createDataFrame([(1, text, "src", len(text))], "doc_id long, text string, source string, n_chars int")
    found = {r["masked"] for r in secrets.findings(docs, model).where("is_secret").collect()}
    out = secrets.redact(docs, model).first()
    assert out["n_chars"] == len(out["text"])
    assert key not in out["text"] and "MIIB9x" not in out["text"] and "the letter opens.\n\n" in out["text"] and out["text"].endswith("letter7Kq2x end")
    if "lett..." in found:
        assert "password=[SECRET] for\tall" in out["text"]


def test_ids_of_packed_queries(spark):
    ids = [0, 1, 127, 128, 200, 255, 256, 51200, -1, -200, 2**40 + 200, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(np.array(ids, np.int64).tobytes(),)], "b binary")
    assert df.select(pivot_index._longs("b")).first()[0] == ids


def test_names_of_groups_move_no_score():
    from tidemark.llm.toxicity import fit, text_features

    rng, rows = random.Random(10), []
    for k in range(1600):
        toxic = k % 4 == 0
        words = [f"w{rng.randrange(60)}" for _ in range(12)]
        if toxic and rng.random() < 0.7:
            words.append("idiot")
        if rng.random() < (0.6 if toxic else 0.05):
            words += [rng.choice(["muslim", "muslims", "europeans"])] * rng.randint(1, 3)
        elif rng.random() < 0.1:
            words.append(rng.choice(["christian", "africans"]))
        rows.append((" ".join(words), float(toxic)))
    features = [text_features(t) for t, _ in rows]
    ids, values, y = [np.array(i, np.uint32) for i, _ in features], [np.array(v, np.float32) for _, v in features], np.array([t for _, t in rows])
    score = fit(ids, values, y).scorer()  # the default penalty
    neutral = score("w1 w2 w3 w4 w5")
    for name in ("muslim", "muslims", "europeans", "christian", "africans"):
        for n in (1, 2, 4):
            assert abs(score("w1 w2 w3 w4 w5" + f" {name}" * n) - score("w1 w2 w3 w4 w5" + " jews" * n)) < 0.05 and score("w1 w2 w3 w4 w5" + f" {name}" * n) < 0.5
    assert neutral < 0.5 < score("w1 idiot w2")
