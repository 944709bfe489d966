"""Registered queries of the training-data operators, and their DuckDB texts.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinreach.llm import (decontaminate, exact_dedup, fim, hard_negatives, line_dedup, lm_score,
                           ngram_join, packing, sharding, token_counts, toxicity, url_lists, warc)
from twinreach.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark, sf_dir):
    return warc.warc_report(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_groups(table(spark, sf_dir, "documents"))


def op7_url_lists(spark, sf_dir):
    return url_lists.url_report(table(spark, sf_dir, "pages"))


def op8_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


def op9_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_fill_in_middle(spark, sf_dir):
    return fim.fim_report(table(spark, sf_dir, "documents"))


def op12_lm_scores(spark, sf_dir):
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_warc, op2_line_dedup, op3_packing, op4_toxicity, op5_exact_dedup, op6_ngram_jaccard_join,
                          op7_url_lists, op8_decontamination, op9_sharding, op10_token_counts,
                          op11_fill_in_middle, op12_lm_scores, op13_hard_negatives)
}

ORACLE: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        q AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM q)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
        FROM r""",
    "op2_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
        l AS (
            SELECT r, doc_id, unnest(string_split(body, chr(10))) AS line,
                   generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM d),
        k AS (
            SELECT r, doc_id, pos, line, translate(
                regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), ''))
                   AS kept_sha256
        FROM k LEFT JOIN f USING (key) GROUP BY r, doc_id""",
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(length(text), 0) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               r = first_value(r) OVER w AS kept, sha256(body) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)""",
    "op7_url_lists": r"""
        WITH c AS (
            SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS u,
                   1704067200 + ('0x' || substr(md5(page_id::VARCHAR), 1, 7))::BIGINT % (366 * 86400)
                       AS fetched FROM pages),
        h AS (
            SELECT *, lower(regexp_replace(regexp_extract(u,
                       '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '[.]+$', '')) AS host,
                   regexp_extract(u, '^[^:/?#]+://[^/?#]*/([^/?#]+)', 1) AS seg FROM c),
        a AS (
            SELECT r, fetched, array_to_string(list_slice(string_split(host, '.'), i,
                       len(string_split(host, '.'))), '.') AS entry
            FROM (SELECT *, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)) AS i
                  FROM h WHERE host <> '')
            UNION
            SELECT r, fetched, host || '/' || seg FROM h WHERE host <> '' AND seg <> ''),
        l AS (
            SELECT entry, n FROM (SELECT DISTINCT entry, ('0x' || substr(md5('list ' || entry), 1, 7))::BIGINT
                                  AS n FROM a) WHERE n % 3 = 0),
        v AS (
            SELECT entry, 1704067200 + n % (366 * 86400 // 2) + k * 86400 * (10 + n % 61) AS since,
                   1704067200 + n % (366 * 86400 // 2) + (k + 1) * 86400 * (10 + n % 61) AS until
            FROM l, (VALUES (0), (2)) t(k)),
        b AS (
            SELECT r, count(*) AS n_active, first(entry ORDER BY length(entry) DESC, entry) AS entry,
                   first(since ORDER BY length(entry) DESC, entry) AS since
            FROM a JOIN v USING (entry) WHERE since <= fetched AND fetched < until GROUP BY r)
        SELECT page_id, host, fetched, b.r IS NOT NULL AS blocked, coalesce(n_active, 0) AS n_active,
               entry, since FROM h LEFT JOIN b USING (r)""",
    "op8_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS span
            FROM (SELECT *, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
                  FROM b WHERE len(w) > 0)),
        dw AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS span
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, span)),
        c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h)
              GROUP BY r),
        t AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM h) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)""",
    "op11_fill_in_middle": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        n AS (
            SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a,
                   ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d),
        p AS (
            SELECT *, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS pre,
                   coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS mid,
                   coalesce(array_to_string(u[greatest(a, b) + 1:n], ''), '') AS suf FROM n)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                      WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM p""",
    "op13_hard_negatives": r"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
                   list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT ar, anchor_id, r AS pr, vec_id AS positive_id, score AS positive_score FROM s
            WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) <= 5)
        SELECT p.anchor_id, positive_id,
               row_number() OVER (PARTITION BY ar, pr ORDER BY score DESC, vec_id, r)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (ar)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
