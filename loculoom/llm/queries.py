"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clustering, conversations, decontaminate, exact_dedup, language_id, lattice_lm, licences, line_dedup, mixing, near_dedup, pii, substring_dedup, token_count
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(line_dedup.repeated_lines(table(spark, sf_dir, "documents")))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.lattice_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_digest(licences.licence_scan(table(spark, sf_dir, "documents")))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(mixing.mixed(table(spark, sf_dir, "documents")))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_digest(*clustering.clustered(table(spark, sf_dir, "embeddings")))


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_digest(substring_dedup.without_repeats(table(spark, sf_dir, "documents")))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digest(conversations.damaged(table(spark, sf_dir, "conversations")))


def personal_data_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op6 SQL expresses: the base spans."""
    return op6_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def licence_places_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7 SQL expresses: the places of phrases."""
    return op7_licences(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op4 SQL expresses: the base score, to four places."""
    return op4_lm_scores(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def language_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op9 SQL expresses: the held-out fold, and which texts are in no language."""
    return op9_languages(spark, sf_dir).select("doc_id", "held_out", (F.col("lang_pred") == "und").alias("und"))


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Proposals of op6's base kinds, by its contract.
PROPOSALS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A span starts behind the pieces of the text before it and the spans between these.
PERSONAL_DATA_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text FROM documents),
p AS ({" UNION ALL ".join(f"SELECT place, {k} AS rank, '{kind}' AS kind, regexp_extract_all(text, '{pattern}') AS m, list_transform(string_split_regex(text, '{pattern}'), lambda x: length(x)) AS gaps FROM t" for k, (kind, pattern) in enumerate(PROPOSALS.items()))}),
l AS (SELECT *, list_transform(m, lambda x: length(x)) AS sizes FROM p),
s AS (SELECT place, rank, kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'x': m[i], 'start': list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0)}}), recursive := true) FROM l),
d AS (SELECT *, regexp_replace(x, '[^0-9]', '', 'g') AS digits FROM s),
v AS (SELECT * FROM d WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(x, '.'), lambda p: coalesce(TRY_CAST(p AS UBIGINT) > 255, true))) = 0
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
        CASE WHEN (length(digits) - i) % 2 = 0 THEN CAST(digits[i] AS INT) WHEN CAST(digits[i] AS INT) > 4 THEN 2 * CAST(digits[i] AS INT) - 9 ELSE 2 * CAST(digits[i] AS INT) END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15 ELSE true END),
g AS (SELECT place, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in PROPOSALS)}, string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(start + length(x) AS BIGINT)), ',' ORDER BY start, rank) AS spans FROM v GROUP BY place)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in PROPOSALS)}, sha256(coalesce(spans, '')) AS base_sha256 FROM t LEFT JOIN g USING (place)
"""
LICENCE_PLACES_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, list_filter(range(0, len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
             list_filter(range(0, len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
             list_filter(range(0, len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl FROM w)
SELECT doc_id, n_words, len(mit) + len(apache) + len(gpl) AS n_base, list_min(mit || apache || gpl) AS first_word, list_max(mit || apache || gpl) AS last_word,
       concat_ws(',', CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END) AS base_labels
FROM p
"""
#: The checksum of the id is worked out with its usual table of 256 entries.
CHECKSUMS = """bits(i, c, k) AS (SELECT range, range, 0 FROM range(0, 256) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
sums(doc_id, s, p, c) AS (
    SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM documents
    UNION ALL SELECT doc_id, s, p + 1, xor(sums.c // 256, bits.c) FROM sums JOIN bits ON k = 8 AND i = xor(sums.c % 256, ascii(substr(s, p + 1, 1))) WHERE p < length(s))"""
LM_BASE_SQL = rf"""
WITH RECURSIVE {CHECKSUMS},
folds AS (SELECT doc_id, xor(c, 4294967295) % 7 = 2 AS held_out FROM sums WHERE p = length(s)),
w AS (SELECT doc_id, unnest(list_append(regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+'), '')) AS word FROM documents),
c AS (SELECT word, count(*) AS c FROM w JOIN folds USING (doc_id) WHERE NOT held_out GROUP BY word),
t AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(*) FILTER (WHERE c > 0) AS n_known, any_value(n) AS train_tokens,
       round(sum(log10((coalesce(c, 0) + 1) / CAST(n + v + 1 AS DOUBLE))), 4) AS base_score
FROM w JOIN folds USING (doc_id) LEFT JOIN c USING (word), t GROUP BY doc_id
"""
LANGUAGE_FOLDS_SQL = rf"""
WITH RECURSIVE {CHECKSUMS}, folds AS (SELECT doc_id, xor(c, 4294967295) % 4 = 2 AS held_out FROM sums WHERE p = length(s))
SELECT doc_id, held_out, NOT regexp_matches(coalesce(text, ''), '\p{{L}}') AS und FROM documents JOIN folds USING (doc_id)
"""
QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_exact_dedup, op3_line_dedup, op4_lm_scores, op5_decontamination, op6_personal_data, op7_licences, op8_near_dedup, op9_languages, op10_mixing, op11_clusters,
        op12_passages, op13_conversations,
        personal_data_base, licence_places_base, lm_base_scores, language_folds,
    )
}
ORACLE_SQL = {"op2_exact_dedup": exact_dedup.SQL, "op3_line_dedup": line_dedup.SQL, "op10_mixing": mixing.SQL, "op11_clusters": clustering.SQL, "op12_passages": substring_dedup.SQL, "op13_conversations": conversations.SQL, "personal_data_base": PERSONAL_DATA_SQL, "licence_places_base": LICENCE_PLACES_SQL, "lm_base_scores": LM_BASE_SQL, "language_folds": LANGUAGE_FOLDS_SQL}
