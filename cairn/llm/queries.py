"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, exact_dedup, hard_negatives, language_id, lm_scoring, mixing, packing, phrases, pii, quality_rules, sharding, simhash, toxicity,
)

DOMAINS = ["good", "low", "toxic"]
#: Target shares of the mix in tokens.
MIX_WEIGHTS = {"good": 0.90, "low": 0.06, "toxic": 0.04}
SHINGLE, DISTANCE = 3, 3
CAPACITY = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The packing vocabulary's file, installed beside the tokenizer library on every
    machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def label_domain() -> Column:
    """The domain that a row of ``labels`` names."""
    return F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "good").when(F.col("quality") == 0, "low")


def label_classifier(docs: DataFrame, labels: DataFrame) -> mixing.Classifier:
    return mixing.learn(docs, labels, label_domain(), DOMAINS)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE, distance=DISTANCE)
    return found.select("doc_id", "fingerprint", "component_id")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=CAPACITY)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = mixing.mix(docs, label_classifier(docs, table(spark, sf_dir, "labels")), MIX_WEIGHTS)
    return found.drop("_hash")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_simhash, op3_lm_scoring, op4_ann, op5_language_id,
        op6_packing, op7_exact_dedup, op8_pii, op9_sharding, op10_mixing, op11_quality_rules, op12_hard_negatives, op13_phrases,
    )
}

ORACLES: dict[str, str] = {
    "op7_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                   list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM vectors AS a JOIN vectors AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        ), negatives AS (
            SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
            FROM positives JOIN pairs USING (anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
    """,
    "op13_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), found AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM words, range(1, 5) AS lengths(k) WHERE len(w) >= k
        ), f AS (
            SELECT lang, k, phrase, count(*) AS f FROM found GROUP BY ALL HAVING count(*) >= 30
        ), totals AS (
            SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
        ), cuts AS (
            SELECT lang, k, phrase, f AS a, c, array_to_string(string_split(phrase, ' ')[:c], ' ') AS l_phrase,
                   array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS r_phrase
            FROM f, range(1, 4) AS places(c) WHERE c < k
        ), scored AS (
            SELECT cuts.lang, cuts.k, cuts.phrase, a, l.f AS l, r.f AS r, c, (2000000 * a::HUGEINT // (l.f + r.f))::BIGINT AS score
            FROM cuts JOIN f AS l ON l.lang = cuts.lang AND l.phrase = l_phrase
                      JOIN f AS r ON r.lang = cuts.lang AND r.phrase = r_phrase
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
        ), parts AS (
            SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase
            FROM f, range(2, 4) AS lengths(m), range(1, 4) AS starts(i) WHERE m < k AND i + m - 1 <= k
        ), longer AS (
            SELECT lang, phrase, max(f) AS f FROM parts GROUP BY ALL
        ), kept AS (
            SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
            FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.phrase = best.phrase
            WHERE longer.f IS NULL OR 100 * longer.f < 80 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
