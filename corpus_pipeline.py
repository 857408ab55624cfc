"""From raw documents to packed token sequences: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import decontamination, jaccard_join, language, line_dedup, packing
from tallymart.llm.common import cut, held_out, table

#: A document whose language is told with less confidence goes.
LEAST_SCORE = 0.3
#: Ids to drop up to this number are sent to the scan of the documents; more are joined by shuffle.
SENT_IDS = 1_000_000


def _sent(ids: DataFrame) -> DataFrame:
    """Stored ids, marked to be broadcast if they are few."""
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but the text under names that no operator uses."""
    return docs.select("text", *[F.col(c).alias(f"column_{i}") for i, c in enumerate(docs.columns) if c != "text"])


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from what was made of ``_aside``."""
    return found.select(*[F.col("text") if c == "text" else F.col(f"column_{i}").alias(c)
                          for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of undetermined language go: no text, no letter, or neither family nor language clear.

    Null and empty texts go, a very long one is judged whole, repeated rows are judged each; other columns
    may have any name. Where no labelled text can be learnt from nothing is told, and all documents stay.
    """
    model = language.fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    known = language.identify(_aside(docs), model)
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return _back(known.where(kept if model else F.lit(True)), docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing else is left."""
    found = line_dedup.deduplicate_lines(docs)
    touched = F.col("n_deleted") > 0
    empty = ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    kept = found.where(~(touched & empty))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(touched, F.length("text").cast("long"))
                               .otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one of least id stays, and of repeated rows one.

    An id on rows of different texts stands for several documents, each judged on its own. A row without an
    id stays; so does one without words, but equal rows of this kind under one id are one.
    """
    found = jaccard_join.jaccard_components(docs).where("doc_id IS NOT NULL")
    found = cut(found.select("doc_id", "component_id", "node", "root"), "components")
    repeated = cut(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(
        "doc_id"), "repeated")
    later = found.where("doc_id <> component_id").select("doc_id").distinct()
    if not repeated.head():
        return docs.join(_sent(cut(later, "later")), "doc_id", "left_anti").select(*docs.columns)
    later = cut(later.join(_sent(repeated), "doc_id", "left_anti"), "later")
    once = docs.join(_sent(later), "doc_id", "left_anti").join(_sent(repeated), "doc_id", "left_anti")
    # Of the texts under repeated ids those stay that are their group's least, told by their node.
    first = found.where("doc_id = component_id").join(_sent(repeated), "doc_id", "left_semi").groupBy(
        "doc_id", "root").agg(F.min("node").alias("node")).select("doc_id", "node")
    again = jaccard_join.with_nodes(docs.join(_sent(repeated), "doc_id", "left_semi").select(*docs.columns))
    again = again.withColumn("id", F.col("row.doc_id").cast("long"))
    chosen = again.join(first.withColumnRenamed("doc_id", "id"), ["id", "node"], "left_semi").dropDuplicates(
        ["id", "node"])
    wordless = again.where("node IS NULL").withColumn("body", F.col("row.text")).dropDuplicates(["id", "body"])
    return once.select(*docs.columns).unionByName(chosen.select("row.*")).unionByName(wordless.select("row.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; null and empty texts are not. Rows are judged each, whatever their columns."""
    found = decontamination.decontaminate(_aside(docs), table(spark, sf_dir, "benchmark"))
    return _back(found.where(~decontamination.contaminated()), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, with their place in sequences of 2048 tokens.

    A null or empty text is its end token; repeated rows are packed each; other columns do not matter.
    """
    return packing.pack_documents(docs).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: No SQL has a trained model, an index or a tokenizer; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
