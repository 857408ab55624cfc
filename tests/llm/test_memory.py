"""What an executor holds beside its heap."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymart.llm import common, decontamination, packing


@pytest.fixture
def unset(spark):
    """The session without a size of Arrow batches."""
    before = spark.conf.get(common.BATCH_SETTING)
    known = common.BATCH_SETTING in spark.conf.getAll
    spark.conf.unset(common.BATCH_SETTING)
    yield
    spark.conf.set(common.BATCH_SETTING, before) if known else spark.conf.unset(common.BATCH_SETTING)


def most(docs):
    """Bytes of the largest Arrow batch that Spark hands over."""

    def size(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    return docs.mapInArrow(size, "n long").agg(F.max("n")).first()[0]


@pytest.mark.parametrize("step", ["map", "search"])
def test_batches_of_text_are_small(spark, unset, step):
    docs = spark.range(0, 1500, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1000).alias("text"))
    if step == "map":
        made = common.map_batches(docs, lambda batch: batch, docs.schema)
    else:
        made = decontamination._search(docs, decontamination.Phrases([], 13), "text", spans=True)
    assert made.count() == 1500
    assert most(docs) <= common.SLICE_BYTES


def test_a_set_size_of_batches_is_left(spark, unset):
    spark.conf.set(common.BATCH_SETTING, "1m")
    common.small_batches(spark)
    assert spark.conf.get(common.BATCH_SETTING) == "1m"


def test_places_of_the_plan_need_no_python_worker(spark):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(1, 40)], "doc_id long, text string")
    placed = packing.pack_documents(docs)
    assert "ExistingRDD" not in placed._jdf.queryExecution().toString()
    assert placed.count() == 39
