"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    collocations, decontamination, exact_dedup, filter_audit, language, language_model, line_dedup, near_dedup, nearest, segmentation, token_files,
    toxicity, warc,
)
from .common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted_languages(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_chunks", "n_removed", "lines_removed", "text")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return segmentation.sampled_segmentations(table(spark, sf_dir, "documents"), path)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, special=True)
    return token_files.read_tokens(spark, files, with_ids=False)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_toxicity, op3_line_dedup, op4_exact_dedup, op5_sentencepiece, op6_decontamination, op7_token_files, op8_near_dedup,
        op9_warc, op10_lm_score, op11_collocations, op12_filter_audit, op13_nearest, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_warc": """
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN strlen(body) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(body) >= 1000 AND page_id < last THEN last END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), occurrences AS (
            SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k:
                       list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase
            FROM worded
        ), counted AS (
            SELECT lang, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM occurrences GROUP BY lang, phrase
        ), totals AS (SELECT lang, sum(f) AS n FROM counted WHERE len(w) = 1 GROUP BY lang
        ), candidates AS (SELECT * FROM counted WHERE f >= 30 AND len(w) > 1
        ), cut AS (
            SELECT lang, phrase, f, w, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, len(w))) AS k FROM candidates)
        ), scored AS (
            SELECT c.lang, c.phrase, c.f, c.k, h.f AS l, t.f AS r, CAST((2000000::HUGEINT * c.f) // (h.f + t.f) AS BIGINT) AS score
            FROM cut c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), swallowed AS (
            SELECT DISTINCT s.lang, s.phrase
            FROM candidates s JOIN candidates b ON s.lang = b.lang AND len(b.w) > len(s.w)
                 AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * b.f >= 80 * s.f
        ), ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a, l, r, score
            FROM lowest ANTI JOIN swallowed USING (lang, phrase)
        )
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op12_filter_audit": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), judged AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
                    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
            FROM texts LEFT JOIN marks USING (doc_id)
        ), orders AS (
            SELECT '' AS o
            UNION ALL
            SELECT o || letter FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS t(letter) WHERE NOT contains(o, letter)
        ), steps AS (
            SELECT o, s, [ascii(x) - 64 for x in string_split(o[1:s - 1], '') if x <> ''] AS before, ascii(o[s]) - 64 AS own
            FROM (SELECT o, unnest(range(1, 6)) AS s FROM orders WHERE length(o) = 5)
        ), states AS (
            SELECT part, fails, count(*) AS c, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
        ), met AS (
            SELECT part, o, s, own, c, good, toxic, fails[own] AS hit, len([b for b in before if fails[b]]) > 0 AS gone,
                   len([f for f in fails if f]) = 1 AS single
            FROM states, steps
        ), told AS (
            SELECT part, o, s, own, sum(CASE WHEN NOT hit AND NOT gone THEN c ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN c ELSE 0 END) AS removed,
                   sum(CASE WHEN hit AND gone THEN c ELSE 0 END) AS redundant, sum(CASE WHEN hit AND single THEN c ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
            FROM met GROUP BY part, o, s, own
        )
        SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM told
    """,
    "op13_nearest": """
        WITH good AS (
            SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
}
