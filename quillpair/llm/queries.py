"""Registered queries of the corpus operators and, where SQL can express the result, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe as BB
from . import exact_dedup as ED
from . import html_extract as HX
from . import merkle_audit as MA
from . import near_dedup as ND
from . import ngram_lm as LM
from . import packing as PK
from . import periodic_runs as PR
from . import preference_format as PF
from . import quality_rules as QR
from . import source_mixing as SM
from . import spelling_variants as SV
from . import url_filters as UF
from .common import read

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_ORACLE[name] = sql
        return fn
    return deco


@query("op1_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op1_exact_dedup(spark, sf):
    return ED.exact_dedup(read(spark, sf, "documents", "doc_id", "text"))


@query("op2_warc_merkle_audit", """
    WITH d AS (
        SELECT coalesce(page_id, -1) AS record, coalesce(url, '') AS url, coalesce(html, '') AS a,
               page_id % 101 = 5 AS lost,
               CASE WHEN page_id % 97 = 13 THEN '~' || substr(coalesce(html, ''), 2)
                    WHEN page_id % 89 = 7 THEN substr(coalesce(html, ''), 1, length(coalesce(html, '')) // 2)
                    ELSE coalesce(html, '') END AS b
        FROM pages),
    w AS (
        SELECT record, side, lost,
               'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
               || url || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || record || '>' || chr(13) || chr(10)
               || 'Content-Length: ' || strlen(body) || chr(13) || chr(10) || chr(13) || chr(10) || body
               || chr(13) || chr(10) || chr(13) || chr(10) AS rec
        FROM (SELECT record, url, lost, 'a' AS side, a AS body FROM d
              UNION ALL SELECT record, url, lost, 'b', b FROM d WHERE NOT lost)),
    o AS (
        SELECT record, side, sha256(rec) AS digest, CAST(strlen(rec) AS BIGINT) AS size,
               CAST(coalesce(sum(strlen(rec)) OVER (PARTITION BY side, record // 4096 ORDER BY record
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at
        FROM w),
    x AS (SELECT * FROM o WHERE side = 'a'), y AS (SELECT * FROM o WHERE side = 'b')
    SELECT x.record // 4096 AS file, x.record, CASE WHEN y.record IS NULL THEN 'missing' ELSE 'changed' END AS kind,
           x.at AS offset_a, x.size AS size_a, x.digest AS digest_a,
           y.at AS offset_b, y.size AS size_b, y.digest AS digest_b
    FROM x LEFT JOIN y ON x.record = y.record WHERE y.digest IS DISTINCT FROM x.digest""")
def op2_warc_merkle_audit(spark, sf):
    pages = read(spark, sf, "pages", "page_id", "url", "html")
    return MA.audit(MA.warc_records(pages), MA.warc_records(MA.damaged_replica(pages)))


@query("op3_super_minhash_dedup")
def op3_super_minhash_dedup(spark, sf):
    return ND.near_dedup(read(spark, sf, "documents", "doc_id", "text"))


@query("op4_preference_format", """
    WITH last AS (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
    t AS (
        SELECT conv_id AS pair_id, turn, role, replace(text, '<|im_', '<| im_') AS c,
               replace(CASE WHEN role = 'assistant' AND turn = last
                            THEN substr(text, 1, CAST((length(text) + 1) // 2 AS BIGINT)) ELSE text END,
                       '<|im_', '<| im_') AS r,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos
        FROM (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations)
             LEFT JOIN last USING (conv_id)
        WHERE conv_id IS NOT NULL),
    n AS (SELECT pair_id, count(*) AS turns, coalesce(min(CASE WHEN c <> r THEN pos END) - 1, count(*)) AS n
          FROM t GROUP BY pair_id),
    s AS (
        SELECT pair_id, pos, n, turns, '<|im_start|>' || role || chr(10) AS head,
               c || '<|im_end|>' AS c, r || '<|im_end|>' AS r, CASE WHEN role = 'assistant' THEN 't' ELSE 'm' END AS f
        FROM t JOIN n USING (pair_id))
    SELECT pair_id, any_value(n) AS prompt_turns, any_value(turns - n) AS chosen_turns,
           any_value(turns - n) AS rejected_turns,
           coalesce(string_agg(head || c || chr(10), '' ORDER BY pos) FILTER (WHERE pos <= n), '') AS prompt,
           coalesce(string_agg(head || c || chr(10), '' ORDER BY pos) FILTER (WHERE pos > n), '') AS chosen,
           coalesce(string_agg('m' || length(head) || ' ' || f || length(c) || ' m1', ' ' ORDER BY pos)
                    FILTER (WHERE pos > n), '') AS chosen_mask,
           coalesce(string_agg(head || r || chr(10), '' ORDER BY pos) FILTER (WHERE pos > n), '') AS rejected,
           coalesce(string_agg('m' || length(head) || ' ' || f || length(r) || ' m1', ' ' ORDER BY pos)
                    FILTER (WHERE pos > n), '') AS rejected_mask
    FROM s GROUP BY pair_id""")
def op4_preference_format(spark, sf):
    conv = read(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    return PF.format_preferences(conv, PF.with_weaker_reply(conv))


@query("op5_template_extraction")
def op5_template_extraction(spark, sf):
    return HX.extract_main_text(read(spark, sf, "pages", "page_id", "url", "html"))


@query("op6_elias_fano_lm")
def op6_elias_fano_lm(spark, sf):
    docs = read(spark, sf, "documents", "doc_id", "text")
    model = LM.train(docs.filter(~LM.held_out()))
    scored = LM.score(docs, model)
    return scored.select("doc_id", LM.held_out().alias("held_out"), "n_tokens", "n_known",
                         F.lit(model["tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score")


@query("op7_hilbert_packing")
def op7_hilbert_packing(spark, sf, tokenizer=None):
    return PK.pack(read(spark, sf, "documents", "doc_id", "text"),
                   tokenizer or public_tokenizers.path("word_bpe_49k.json"))


@query("op8_quality_rules")
def op8_quality_rules(spark, sf):
    return QR.quality_rules(read(spark, sf, "documents", "doc_id", "text"))


@query("op9_byte_bpe")
def op9_byte_bpe(spark, sf, ranks=None):
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = BB.bpe_decode(BB.bpe_encode(read(spark, sf, "documents", "doc_id", "text"), ranks), ranks)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_url_filters", r"""
    WITH u AS (
        SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
        FROM pages),
    r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    m AS (SELECT u.*, h || p AS rule, v,
                 row_number() OVER (PARTITION BY page_id ORDER BY length(h) + length(p) DESC NULLS LAST) AS k
          FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1""")
def op10_url_filters(spark, sf):
    return UF.url_verdicts(read(spark, sf, "pages", "page_id", "url"), UF.rules_table(spark))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf):
    return PR.run_digests(PR.periodic_runs(PR.with_planted_periods(read(spark, sf, "documents", "doc_id", "text"))))


@query("op12_cube_mixing")
def op12_cube_mixing(spark, sf):
    mixed = SM.mix(read(spark, sf, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf):
    words = SV.word_counts(read(spark, sf, "documents", "doc_id", "text"), slip=199)
    return SV.spelling_variants(words)
