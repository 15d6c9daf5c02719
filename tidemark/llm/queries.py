"""The queries of the corpus operators, by the name under which they are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pivot_index, quality, secrets, toxicity
from .decontamination import contained_items
from .html_text import extract_main_text
from .jaccard_join import near_duplicates
from .packing import pack
from .token_counts import UnigramVocabulary, count_tokens
from .warc import decide, read_archives, write_archives
from .workspace import Workspace, fold, table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score_toxicity(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"), secrets.train(secrets.example_findings(spark)))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pivot_index.quantised(table(spark, sf_dir, "embeddings"))
    return pivot_index.top_k(vectors, F.col("id") % 100 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("cluster")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    model = quality.train(documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score_quality(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(documents, UnigramVocabulary.load(vocabulary)).select("doc_id", "n_tokens")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "warc")
    archives = work.stage(write_archives(decide(table(spark, sf_dir, "pages"))), "archives")
    records = read_archives(archives, with_payload=False).where("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_html_text, op2_toxicity, op3_secrets, op4_top_k, op5_packing, op6_quality, op7_decontamination, op8_token_counts, op9_warc, op10_jaccard_join)}

_SPLIT = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SHINGLES = "unnest(list_distinct(list_transform(range(0, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1 : i + 5], ' ')))) as s"

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_top_k": """with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e from embeddings where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
 r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s) select * from r where rank <= 10""",
    "op7_decontamination": f"""with d as (select doc_id, {_SPLIT} as w from documents), ds as (select distinct doc_id, s from (select doc_id, {_SHINGLES} from d where len(w) > 0)),
 b as (select item_id, {_SPLIT} as w from benchmark), bs as (select distinct item_id, s from (select item_id, {_SHINGLES} from b where len(w) > 0)), n as (select item_id, cast(count(*) as int) as n_item from bs group by 1),
 h as (select doc_id, bs.item_id, count(*) as n_found from ds join bs using (s) group by 1, 2) select doc_id, h.item_id, n_item, n_found, n_found / n_item as containment from h join n on n.item_id = h.item_id where n_found * 100 >= n_item * 80""",
    "op9_warc": """with p as (select page_id, coalesce(html, '') as h from pages), s as (select page_id, cast(strlen(h) as bigint) as payload_bytes, sha1(h) as x from p),
 g as (select x, max(page_id) as last from s group by 1), v as (select s.*, last, list_transform(range(0, 8), lambda k: list_sum(list_transform(range(0, 5), lambda j: cast((instr('0123456789abcdef', substr(s.x, 5 * k + j + 1, 1)) - 1) * pow(16, 4 - j) as bigint)))) as n from s join g on g.x = s.x)
 select page_id, payload_bytes, array_to_string(list_transform(n, lambda q: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((cast(q as bigint) >> b) & 31) + 1 as bigint), 1)), '')), '') as payload_digest,
 case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to from v""",
}
