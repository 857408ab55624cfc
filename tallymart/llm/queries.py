"""One query per operator of this package, over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    decontamination, embedding_dedup, fixity, jaccard_join, language, line_dedup, packing, quality,
    secrets, sharding, spelling, toxicity, whitening,
)
from .common import held_out, table


def op1_merkle_fixity(spark, sf):
    """All pages against a replica that lost, changed and gained some, by their id."""
    pages = table(spark, sf, "pages")
    page = F.col("page_id")
    replica = pages.where(page % 1009 != 7).withColumn(
        "html", F.when(page % 997 == 5, F.concat("html", F.lit(" "))).otherwise(F.col("html")))
    again = pages.where(page % 1013 == 11).withColumn("url", F.concat("url", F.lit("#2")))
    one, other = (fixity.record_hashes(df.withColumn("archive", F.lit("pages")), "archive", "page_id",
                                       ["url", "html"]) for df in (pages, replica.unionByName(again)))
    return fixity.audit(one, other).select(F.col("offset").alias("page_id"), "state", "n")


def op2_sharding(spark, sf):
    placed = sharding.shard_documents(table(spark, sf, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.deduplicate_lines(docs)


def op4_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.judged(quality.measured(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_stop_words", "failed_rules")


def op5_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    held = held_out(F.col("doc_id"))
    model = language.fit(docs.where(~held).select("doc_id", "text", "lang"))
    return language.identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def op6_packing(spark, sf):
    packed = packing.pack_documents(table(spark, sf, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset")


def op7_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"))
    labelled = toxicity.with_labels(
        docs.where(~held), table(spark, sf, "labels").where(~held), "toxic")
    return toxicity.classify(docs.withColumn("held_out", held), toxicity.fit(labelled)).drop("text")


def op8_secret_scan(spark, sf):
    found = secrets.find_secrets(table(spark, sf, "documents"))
    spans = F.col("found")
    live = F.size(F.filter(spans, lambda x: x["live"])).cast("long")
    return found.select(
        "doc_id", *[secrets.count_of(spans, kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.joined(secrets.base(spans)), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"), live.alias("n_live"),
        (F.size(spans) - live).alias("n_example"))


def op9_ngram_jaccard_join(spark, sf):
    found = jaccard_join.jaccard_components(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_benchmark_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontamination.items_digest().alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"))


def op11_spelling_variants(spark, sf):
    """One run in 199 loses a letter first."""
    counts = spelling.word_counts(table(spark, sf, "documents"), drop_every=199)
    return spelling.variant_groups(counts)


def op12_embedding_dedup(spark, sf):
    return embedding_dedup.near_vectors(table(spark, sf, "embeddings"))


def op13_embedding_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


QUERIES = {query.__name__: query for query in (
    op1_merkle_fixity, op2_sharding, op3_line_dedup, op4_quality_rules, op5_language_id, op6_packing,
    op7_toxicity, op8_secret_scan, op9_ngram_jaccard_join, op10_benchmark_decontamination, op11_spelling_variants,
    op12_embedding_dedup, op13_embedding_whitening)}
