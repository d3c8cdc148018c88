"""The registered queries of this subpackage: whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from viagrid.llm import bpe, decontam, mixing, neardup, negatives, pseudonyms, quality, rules, secrets, tokens, warc, wavelet, whitening

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Key of the pseudonyms over test tables; real runs pass their own.
TEST_KEY = b"key for test tables only"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None):
    def keep(query):
        QUERIES[query.__name__] = query
        if oracle:
            ORACLES[query.__name__] = oracle
        return query

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Words and shingle sets of ``{source}``'s texts, one row per distinct shingle.
SHINGLES = r"""
    SELECT DISTINCT {id} AS id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {source})
"""

OP6_SQL = f"""
WITH d AS ({SHINGLES.format(id="doc_id", source="documents")}), q AS ({SHINGLES.format(id="item_id", source="benchmark")}),
n AS (SELECT id, count(*) AS n_item FROM q GROUP BY id)
SELECT d.id AS doc_id, q.id AS item_id, count(*) AS n_shared, any_value(n.n_item) AS n_item
FROM d JOIN q USING (s) JOIN n ON n.id = q.id
GROUP BY d.id, q.id HAVING 100 * count(*) >= 80 * any_value(n.n_item)
"""

OP10_SQL = f"""
WITH RECURSIVE d AS ({SHINGLES.format(id="doc_id", source="documents")}),
n AS (SELECT id, count(*) AS n FROM d GROUP BY id),
pairs AS (SELECT a.id AS u, b.id AS v, count(*) AS c FROM d a JOIN d b ON a.s = b.s AND a.id <> b.id GROUP BY a.id, b.id),
links AS (SELECT u, v FROM pairs JOIN n x ON x.id = u JOIN n y ON y.id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
roots AS (SELECT u, least(u, min(v)) AS root FROM reach GROUP BY u)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n ON n.id = doc_id LEFT JOIN roots ON u = doc_id
"""

#: Base 32 of a SHA-1, five bits at a time.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS b, unhex(sha1(h))::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, b AS payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
        + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
        + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type, nullif(f, page_id) AS refers_to
FROM d
"""

OP11_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, list_inner_product(a.x::DOUBLE[], r.x::DOUBLE[])::BIGINT AS score
    FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@registered()
def op1_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets by pattern, and by guess cost in credential contexts."""
    return secrets.secrets(table(spark, folder, "documents"))


@registered()
def op2_quality_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores by quadratic discriminant analysis."""
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@registered()
def op3_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Documents' token ids, written to wavelet shards and read back."""
    return wavelet.read_documents(wavelet.write_shards(table(spark, folder, "documents"), TOKENIZER))


@registered()
def op4_cube_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    drawn = mixing.copies(table(spark, folder, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken")


@registered(OP5_SQL)
def op5_seekable_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the pages' archives, read back by their index."""
    return warc.read_archives(warc.write_archives(table(spark, folder, "pages")))


@registered(OP6_SQL)
def op6_contained_items(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold at least 80% of the shingles of a benchmark item."""
    return decontam.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 80)


@registered()
def op7_rule_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base rules and the isolation forest's verdict."""
    return rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@registered()
def op8_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with personal numbers, dates and addresses replaced in their format."""
    return pseudonyms.pseudonymised(table(spark, folder, "documents"), TEST_KEY)


@registered()
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return tokens.token_counts(table(spark, folder, "documents"), TOKENIZER)


@registered(OP10_SQL)
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents linked at a similarity of 0.85 or more."""
    return neardup.near_duplicates(table(spark, folder, "documents"), 85)


@registered(OP11_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, with some labels shifted."""
    rows = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


@registered()
def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes that they spell."""
    rows = bpe.round_trip(table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@registered()
def op13_whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings along their 16 main components, each of variance 1."""
    return whitening.whitened(table(spark, folder, "embeddings"))


@registered(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline over documents."""
    return corpus_pipeline.run(spark, folder)
