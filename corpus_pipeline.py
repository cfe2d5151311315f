"""The corpus pipeline: toxic documents go, then exact copies, then near copies; what stays is packed.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and is written as Parquet and
read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import exact_dedup, near_copies, packing, toxicity_cnn
from eventloom.llm.common import table
from eventloom.session import materialize

#: Rows in one Arrow batch. A batch of whole texts is held in the executor and again in the Python worker, several times
#: while it is written and read, so Spark's 10,000 rows take tens of MB each time.
ARROW_ROWS = 512


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends its rows to Python in small batches; the session's own setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier, trained on the labelled documents, calls toxic in the document's language.

    The rows are written here, as the size of a batch counts where a plan is run."""
    with small_batches(spark):
        return materialize(toxicity_cnn.clean_rows(docs, toxicity_cnn.fit(docs, table(spark, sf_dir, "labels"))))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.kept_rows(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays: SimHash fingerprints linked by their trie,
    checked against a five-word similarity of 0.8 or more, and completed where copies lie further apart."""
    with small_batches(spark):
        return near_copies.kept_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens, as pieces with their ids, in the proportions of the sources."""
    with small_batches(spark):
        return packing.pack(docs, packing.tokenizer_path())


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash_near_dedup", near), ("packing", packed)]
WRITTEN = {"toxicity"}  # stages that write their rows themselves

#: No SQL states the classifier, the fingerprints or the packing; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) and name not in WRITTEN:
            docs = materialize(docs)
    return docs
