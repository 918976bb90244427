"""Registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureauflow.llm import (
    bpe_fold,
    decontaminate,
    jaccard_join,
    language_id,
    lexical_search,
    storage,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    warc,
    whitening,
    winnowing,
)

ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of an Arrow batch: documents can be long, so that a number of rows alone doesn't bound it.
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    # Python workers of a local session find this package as the driver does; on a cluster it is installed
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_fold.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


#: The rules of the registered query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("select * from values " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + " as t(host, path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", language_id.held_out().alias("held_out"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~language_id.held_out()))
    return toxicity.score(docs, model, ["doc_id", "held_out"])


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language_id.held_out().alias("held_out"))
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.predict(docs, model, ["doc_id", "held_out"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.shared_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    sums = token_files.checksums(token_files.read_token_files(spark, folder), ["doc_id", "n_tokens", "file", "place"])
    rows = token_files.with_starts(sums, token_files.read_token_files(spark, folder, ["n_tokens"]))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_winnowing": op6_winnowing,
    "op7_jaccard": op7_jaccard,
    "op8_language": op8_language,
    "op9_token_counts": op9_token_counts,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_warc": op12_warc,
    "op13_lexical_search": op13_lexical_search,
}

_URL_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLES: dict[str, str] = {
    "op3_url_filter": f"""
        with rules(host, path, verdict) as (values {_URL_RULES_SQL}),
        cut as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
        parts as (select page_id, regexp_extract(rest, '^([^/?#]*)', 1) as host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from cut),
        low as (select page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
        fits as (
            select l.page_id, r.host || r.path as rule, r.verdict,
                row_number() over (partition by l.page_id order by length(r.host || r.path) desc, length(r.host) desc) as k
            from low l join rules r on (l.host = r.host or ends_with(l.host, '.' || r.host)) and starts_with(l.path, r.path)
        )
        select l.page_id, coalesce(l.host, '') as host, coalesce(l.path, '') as path, f.rule, coalesce(f.verdict, 'allow') as verdict
        from low l left join fits f on f.page_id = l.page_id and f.k = 1
    """,
    "op12_warc": """
        with hashed as (select page_id, coalesce(html, '') as body from pages),
        digits as (select page_id, octet_length(encode(body)) as size, sha1(body) as hex from hashed),
        bits as (
            select page_id, size, hex, list_aggregate(list_transform(range(1, 41), lambda k: lpad(bin(strpos('0123456789abcdef', substr(hex, k, 1)) - 1), 4, '0')), 'string_agg', '') as bits
            from digits
        ),
        digests as (
            select page_id, size, hex, list_aggregate(
                list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(('0b' || substr(bits, 5 * k + 1, 5)) as int) + 1, 1)), 'string_agg', '') as digest
            from bits
        ),
        kept as (select *, max(page_id) over (partition by hex, size) as keep from digests)
        select page_id, cast(size as bigint) as payload_bytes, digest as payload_digest, case when page_id = keep then 'response' else 'revisit' end as record_type,
            case when page_id <> keep then keep end as refers_to
        from kept
    """,
    "op13_lexical_search": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ),
        counts as (select doc_id, term, count(*) as tf from words group by all),
        sizes as (select doc_id, cast(sum(tf) as bigint) as n from counts group by all),
        totals as (select count(*) as all_docs, cast(sum(n) as bigint) as all_terms from sizes),
        asked as (
            select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ),
        repeats as (select item_id, term, count(*) as times from asked group by all),
        weights as (
            select term, cast(floor(1000 * ln(cast(2 * any_value(all_docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
            from counts, totals group by term
        ),
        impacts as (
            select c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms))) as impact
            from counts c join sizes using (doc_id) join weights using (term), totals
            where c.term in (select term from asked)
        ),
        scores as (select item_id, doc_id, cast(sum(times * impact) as bigint) as score from repeats join impacts using (term) group by all),
        placed as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
        select item_id, cast(rank as int) as rank, doc_id, score from placed where rank <= 20
    """,
}
