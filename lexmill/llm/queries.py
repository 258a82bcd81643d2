"""The operators over their whole tables, as named queries, and those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill.llm import (
    byte_bpe, exact_dedup, extraction, infill, jaccard_join, packing, private_data, quality, sharding, spelling, stream_bpe,
    suffix_dedup, warc,
)
from lexmill.session import drop_table, fresh_path, write_table

POLICY = "v1"
SHARDS = 24


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents under the production policy, with each row's ablation.

    ``back_without`` is the one rule (as a bit) whose removal would keep the row, else 0, and ``n_alike``
    how many rows fail just the same rules of the policy; both come from the counted bit patterns.
    """
    ledger, _ = write_table(quality.rule_ledger(documents(spark, sf_dir)), "rule-ledger")
    judged = quality.apply_policy(ledger, POLICY)
    # At most two to the number of rules.
    found = F.broadcast(quality.patterns(ledger, POLICY).withColumnRenamed("bits", "rejected_by"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rest = [c for c in judged.columns if c not in first]
    return judged.join(found, "rejected_by").select(*first, *rest, "back_without", F.col("n").alias("n_alike"))


def op2_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extraction.extract_main_text(pages(spark, sf_dir))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and link counts of all documents."""
    return jaccard_join.similarity_classes(documents(spark, sf_dir))


def op4_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the field is fitted to a bounded sample of them."""
    return private_data.find_private_data(documents(spark, sf_dir))


def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes."""
    placed = sharding.shard_records(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, as digests."""
    return byte_bpe.token_digests(documents(spark, sf_dir))


def op7_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that repeat across documents."""
    return suffix_dedup.repeated_passages(documents(spark, sf_dir))


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir))


def op9_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, read back and assembled to captures."""
    path = fresh_path(spark, "archive")
    warc.write_archive(warc.with_revisits(pages(spark, sf_dir)), path)
    records = warc.read_archive(spark, path)
    again = F.col("warc_type") == "revisit"
    seen = records.select(
        "warc_type", "record_id", "concurrent_to",
        F.when(again, F.col("http_length")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(again, F.col("payload_digest")).otherwise(warc.base32_sha1(F.col("payload"))).alias("payload_digest"),
        warc.field("pageid").cast("long").alias("page_id"),
        warc.field("referstopageid").cast("long").alias("refers_to"),
    )
    stored, _ = write_table(seen, "archive-records")
    drop_table(spark, path)
    captures = warc.assemble(stored)
    about = F.get("metadata", F.lit(0))
    return captures.select(
        about["page_id"].alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        about["refers_to"].alias("refers_to"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; the largest id stays."""
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), keep="max")


def op11_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as fill-in-the-middle examples and restored from them, as digests."""
    made = infill.fill_in_middle(documents(spark, sf_dir))
    back = made.withColumn("text", infill.restored(F.col("output"), F.col("form")))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


def op12_stream_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded as streams, as digests."""
    return stream_bpe.token_digests(documents(spark, sf_dir))


def op13_spelling_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frequent words of all documents with their near words and forms."""
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = [
    op1_quality_ledger, op2_host_paths, op3_chosen_path, op4_skip_chain, op5_sampled_splitters, op6_rank_queue,
    op7_sparse_suffixes, op8_vector_packing, op9_transactions, op10_exact_dedup, op11_block_rotation, op12_stream_transducer, op13_spelling_index,
]

ORACLE_SQL = {
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op11_block_rotation": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
        numbers AS (
            SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                   ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM hashed),
        cuts AS (
            SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
        pieces AS (
            SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM pieces""",
}
