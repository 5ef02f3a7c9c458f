"""Registered queries of this subpackage: each operator over its whole table, as its contract states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystick.llm import decontaminate, embedding_dedup, language_id, lexical_search, mixing, pii, prefix_trie, quality_rules
from tallystick.llm import secret_scan, simhash_dedup, substring_dedup, toxicity, warc
from tallystick.llm.common import discard, remainder, table
from tallystick.llm.oracles import statements  # noqa: F401
from tallystick.sources.workspace import new_folder, staged

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Pages are written as monolithic archives, normalised, and read back from the result."""
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("target_uri"), F.col("html").cast("binary").alias("payload"))
    named = lambda column: F.concat(F.lit("urn:page:"), F.col(column).cast("string"))
    records = warc.with_revisits(pages, "page_id").withColumn("record_id", named("page_id")).withColumn("refers_to", named("original"))
    monolithic, archives = new_folder(spark, "monolithic"), new_folder(spark, "warc")
    warc.write_monolithic(records, monolithic)
    warc.normalise(spark, monolithic, archives)
    discard(spark, monolithic)
    read = warc.read_archives(spark, archives, with_payload=False)
    return read.select(
        F.expr("try_cast(regexp_extract(record_id, '^urn:page:(-?[0-9]+)$', 1) as bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("try_cast(regexp_extract(refers_to, '^urn:page:(-?[0-9]+)$', 1) as bigint)").alias("refers_to"),
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    network = toxicity.train(documents.where(~held_out), table(spark, folder, "labels"))
    scores = documents.select("doc_id", held_out.alias("held_out"), toxicity.scored(F.col("text"), network).alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.train(documents.where(~held_out))
    found = documents.select("doc_id", held_out.alias("held_out"), language_id.predicted(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    classes = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    spans = secret_scan.scan(documents, secret_scan.train(documents))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return spans.select("doc_id", *counts, F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("found").alias("spans"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = documents.select("doc_id", pii.spans(F.col("text"), pii.train(documents)).alias("s")).select("doc_id", "s.base", "s.found")
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("found").alias("spans"))


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = table(spark, folder, "documents").select("doc_id", quality_rules.judged(F.col("text")).alias("m")).select("doc_id", "m.*")
    return judged.withColumn("failed", F.array_join("failed", ", "))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 9
    sequences = prefix_trie.rebuilt(prefix_trie.turns_of(conversations), shared, conv - conv % 5)
    members = conversations.where(conv.isNotNull()).select("conv_id").distinct()
    return prefix_trie.trie(staged(sequences, "rebuilt"), members)


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_QUERIES: tuple[Query, ...] = (
    op1_warc_normalise, op2_toxicity, op3_embedding_near_dedup, op4_language_id, op5_simhash_near_dedup, op6_mix_sources,
    op7_secret_scan, op8_substring_dedup, op9_personal_data, op10_benchmark_decontamination,
    op11_quality_rules, op12_conversation_trie, op13_lexical_search,
)


def registered() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}
