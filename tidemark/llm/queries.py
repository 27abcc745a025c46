"""The registered query of every operator, over whole tables with production parameters, and its DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import privacy
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contamination, report
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.jaccard_join import jaccard_join
from tidemark.llm.katz import katz_scores
from tidemark.llm.lexical_search import ranked_search
from tidemark.llm.licenses import license_matches
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.quality import grades_of_labels, quality_scores
from tidemark.llm.token_alignment import token_alignment
from tidemark.llm.toxicity import toxicity_scores
from tidemark.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file, by default that of the packing query; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), grades_of_labels(table(spark, sf_dir, "labels")))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


@query()
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.report(privacy.personal_data(table(spark, sf_dir, "documents")))


@query()
def op7_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), order=3)


@query()
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    r"""
    with prints as (
        select doc_id, length(coalesce(text, '')) as n,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h
        from documents
    ), best as (
        select *, row_number() over (partition by h order by n desc, doc_id) as place from prints
    )
    select b.doc_id, w.doc_id as keep_id, count(*) over (partition by b.h) as group_size, b.place = 1 as kept, b.h as text_sha256
    from best b join best w on w.h = b.h and w.place = 1
    """
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query(
    """
    with digests as (
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages
    ), ranked as (
        select *, row_number() over w as place, first_value(page_id) over w as first_page
        from digests window w as (partition by h, payload_bytes order by page_id)
    )
    select page_id, payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
               (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31) + 1)]), '') as payload_digest,
           case when place = 1 then 'response' else 'revisit' end as record_type,
           case when place > 1 then first_page end as refers_to
    from ranked
    """
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


@query(
    r"""
    with words as (
        select doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from documents
    ), asked as (
        select item_id, term, count(*) as repeats
        from (select item_id, unnest(regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
              from benchmark) group by all
    ), sizes as (
        select doc_id, count(*) as n from words group by doc_id
    ), corpus as (
        select count(*) as docs, sum(n)::bigint as terms from sizes
    ), tfs as (
        select doc_id, term, count(*) as tf from words where term in (select term from asked) group by all
    ), weights as (
        select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
        from tfs, corpus group by term, docs
    ), scored as (
        select a.item_id, t.doc_id,
               sum(a.repeats * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * s.n * c.docs) // c.terms))))::bigint as score
        from asked a join tfs t using (term) join weights w using (term) join sizes s using (doc_id), corpus c
        group by a.item_id, t.doc_id
    )
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scored where score > 0 qualify rank <= 20
    """
)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
