"""The queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.llm import warc
from lexquarry.llm.common import read


def _findings_of(kind: str) -> Column:
    return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.simhash import simhash_groups

    return simhash_groups(read(spark, folder, "documents"), n=4, distance=4)


def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.lm import score_texts

    return score_texts(read(spark, folder, "documents"))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.secrets import find_secrets

    found = find_secrets(read(spark, folder, "documents"))
    base = F.filter("findings", lambda f: f["kind"] != "format")
    counts = [_findings_of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    listed = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("findings").alias("spans"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.toxicity import held_out_column, learn, score_toxicity

    documents = read(spark, folder, "documents").select("doc_id", "text")
    lexicon = learn(documents, read(spark, folder, "labels"))
    scored = score_toxicity(documents, lexicon)
    return scored.select("doc_id", held_out_column(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.repeats import remove_repeats

    cut = remove_repeats(read(spark, folder, "documents"), length=400)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.decontam import find_contamination

    found = find_contamination(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.size("matches").cast("long").alias("n_items"), F.transform("matches", lambda m: m["item"]).alias("item_ids"), "matches")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.exact_dedup import exact_groups

    return exact_groups(read(spark, folder, "documents"), largest=True)


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.mixing import mix_sources

    _, documents = mix_sources(read(spark, folder, "documents"), weights=(5, 2, 1), percent=150, repeat=2)
    return documents.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op9_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.pii import KINDS, pseudonymise

    out = pseudonymise(read(spark, folder, "documents").select("doc_id", "text"), key="a key of the query's own")
    counts = [_findings_of(k).alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, "findings", "text")


def op10_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    from lexquarry.llm.warc import derive, responses

    return derive(responses(read(spark, folder, "pages"))).select(
        F.col("source_id").alias("page_id"), F.col("record_id").alias("response_id"), "payload_digest",
        F.col("metadata.record_id").alias("metadata_id"), F.col("conversion.record_id").alias("conversion_id"),
        F.col("metadata.refers_to").alias("metadata_refers_to"), F.col("conversion.refers_to").alias("conversion_refers_to"),
        "target_uri", "title", "language", "n_outlinks",
        F.col("metadata.block_digest").alias("metadata_digest"), F.col("metadata.content_length").alias("metadata_length"),
        F.col("conversion.block_digest").alias("conversion_digest"), F.col("conversion.content_length").alias("conversion_length"),
        F.col("conversion.block").alias("text"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_lm_scores": op2_lm_scores,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_repeated_bytes": op5_repeated_bytes,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_pii_pseudonyms": op9_pii_pseudonyms,
    "op10_warc_derivatives": op10_warc_derivatives,
}

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_source_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5(concat('mix-1|', doc_id)) AS mix
            FROM documents
        ), per AS (
            SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
                   [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM sized GROUP BY source
        ), filled AS (
            SELECT *, coalesce(sum(cap) OVER upto, 0)::BIGINT AS cap_before,
                   (sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0))::BIGINT AS weight_left,
                   (sum(source_size) OVER ())::BIGINT AS all_words
            FROM per
            WINDOW upto AS (ORDER BY cap * (10 // weight), source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), stopped AS (
            SELECT *, cap * weight_left * 2 <= (all_words * 3 - cap_before * 2) * weight AS capped FROM filled
        ), level AS (
            SELECT cap_before AS c, weight_left AS w FROM stopped WHERE NOT capped ORDER BY cap_before LIMIT 1
        ), targets AS (
            SELECT source, source_size,
                   CASE WHEN capped THEN cap::DOUBLE
                        ELSE ((all_words * 150 - (SELECT c FROM level) * 100) * weight)::DOUBLE / ((SELECT w FROM level) * 100)::DOUBLE END AS target
            FROM stopped
        ), laid AS (
            SELECT s.doc_id, s.source, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS quota,
                   (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mix, s.doc_id) - s.size)::BIGINT AS begins
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), quotas AS (
            SELECT source, floor(target)::BIGINT AS quota, ((floor(target)::BIGINT + 127) // 128) AS blocks,
                   (sum(floor(target)::BIGINT) OVER ())::HUGEINT AS total, (sum(floor(target)::BIGINT) OVER (ORDER BY source ASC NULLS LAST))::HUGEINT AS upto
            FROM targets
        ), bits AS (
            SELECT CASE WHEN sum(blocks) <= 1 THEN 0 ELSE len(bin(sum(blocks)::BIGINT - 1)) END::INT AS b FROM quotas
        ), shares AS (
            SELECT source, blocks, ((upto - quota) * (1 << b) + total - 1) // total AS lo, (upto * (1 << b) + total - 1) // total AS hi, b FROM quotas, bits WHERE quota > 0
        ), points AS (
            SELECT source, blocks, b, unnest(range(lo::BIGINT, hi::BIGINT)) AS point FROM shares
        ), slots AS (
            SELECT source, blocks, coalesce(list_sum(list_transform(range(0, b), lambda i: ((point >> i) & 1) << (b - 1 - i))), 0)::BIGINT AS slot FROM points
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank FROM slots
        ), schedule AS (
            SELECT source, rank, slot FROM ranked WHERE rank < blocks UNION ALL
            SELECT source, rank, (1 << b) + rank FROM (SELECT source, b, unnest(range((hi - lo)::BIGINT, blocks)) AS rank FROM shares)
        ), laps AS (
            SELECT doc_id, source, size, begins, quota, begins + lap * source_size AS lo, least(begins + lap * source_size + size, quota) AS hi FROM laid, (VALUES (0), (1)) AS laps(lap)
        ), pieces AS (
            SELECT doc_id, source, unnest(range(lo // 128, (hi - 1) // 128 + 1)) AS rank FROM laps WHERE lo < hi
        ), firsts AS (
            SELECT p.doc_id, min(s.slot)::BIGINT AS first_slot FROM pieces p JOIN schedule s ON p.source IS NOT DISTINCT FROM s.source AND p.rank = s.rank GROUP BY p.doc_id
        )
        SELECT doc_id, size, source_size, target,
               (greatest(0, least(begins + size, quota) - begins) + greatest(0, least(begins + size + source_size, quota) - begins - source_size))::BIGINT AS taken,
               first_slot
        FROM laid LEFT JOIN firsts USING (doc_id)
    """,
    "op10_warc_derivatives": warc.oracle(),
}
