"""The queries of this subpackage by name, on the driver's tables, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm import (
    bins, counts, exact, jaccard, language, licences, mixing, packing, quality, repeats, secrets, trie, whitening)
from tallygrid.llm.common import read_documents, stored

HELD_OUT = 1  # the remainder of a document's id hash by 3 that is not learned from


def held_out():
    """A row without an id has no such hash and is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def language_model(docs: DataFrame) -> language.Model:
    return language.fit(docs.filter(~held_out()))


def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    units = stored(licences.units(docs), "licence-units")
    return licences.licences(docs, licences.learn(docs, units), units)


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_documents(spark, folder))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    found = language.predicted(docs, language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_copies(read_documents(spark, folder))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.document_counts(read_documents(spark, folder))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_documents(spark, folder))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_words(read_documents(spark, folder))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    return secrets.report(secrets.spans(docs, secrets.learn(docs)))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked_documents(read_documents(spark, folder))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    numbers = stored(quality.statistics(read_documents(spark, folder)), "quality-statistics")
    return quality.judged(numbers, quality.learn(numbers, spark.read.parquet(f"{folder}/labels.parquet")))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


def op12_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return bins.pack(read_documents(spark, folder))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_licences, op2_mixing, op3_language, op4_exact_dedup, op5_token_counts, op6_packing, op7_substring_dedup, op8_secrets,
        op9_jaccard_join, op10_quality_rules, op11_prefix_trie, op12_best_fit, op13_whitening)
}
_BARE = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"
SQL: dict[str, str] = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_BARE}) AS text_sha256, length(coalesce(text, '')) AS points
                   FROM documents),
             g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                       count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d
                   WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
    """,
    "op7_substring_dedup": """
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
                   FROM documents),
             e AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS edge
                   FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
             f AS (SELECT edge, min(doc_id) AS first FROM e GROUP BY edge HAVING min(doc_id) < max(doc_id)),
             gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
                      FROM e JOIN f USING (edge) WHERE first < doc_id),
             kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS text, count(*) AS n
                      FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) x
                      ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i GROUP BY x.doc_id)
        SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
    """,
    # The reduction over 8 steps is the remainder that CRC-32 is defined by, for one byte.
    "op11_prefix_trie": """
        WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
                   FROM conversations WHERE conv_id IS NOT NULL),
             k AS (SELECT c, xor(4294967295, list_reduce(
                              list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT),
                              lambda crc, byte: list_reduce(range(8), lambda x, step: xor(x >> 1, 3988292384 * (x & 1)),
                                                            xor(crc, byte)), 4294967295)) % 6 AS h
                   FROM (SELECT DISTINCT c FROM t)),
             r AS (SELECT k.c, pos, role, text FROM k JOIN t ON t.c = k.c - k.c % 100 AND pos <= h
                   UNION ALL SELECT c, pos, role, text FROM k JOIN t USING (c) WHERE pos > h),
             p AS (SELECT c, row_number() OVER w AS d, length(text) AS points,
                          list(struct_pack(role, text)) OVER w AS path
                   FROM r WINDOW w AS (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING)
                   UNION ALL SELECT c, 0, 0, [] FROM k),
             e AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
             n AS (SELECT path, any_value(d) AS d, min(c) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
                          sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
                   FROM e GROUP BY path),
             ch AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
             f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (path)),
             s AS (SELECT p.path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * f.points) AS saved
                   FROM f JOIN p ON p.c = f.conv_id AND p.d <= f.d GROUP BY p.path)
        SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
               s.saved::BIGINT AS saved_tokens, f.ends_sha256
        FROM f JOIN s USING (path) LEFT JOIN n AS u ON f.d > 0 AND u.path = f.path[1:f.d - 1]
    """,
}
