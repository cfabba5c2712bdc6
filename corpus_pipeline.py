"""A training-data pipeline over the documents table, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it as Parquet into the cluster's
shared folder and reads it back as the next stage's docs. All but the last stage return the columns of documents.
Rows are told apart by doc_id and a hash of the text, so null or repeated ids do no harm. Extra columns of the documents
are dropped; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import bytewise, jaccard, kneser_ney, packing, pseudonyms, sent, winnowing
from parcelwise.llm.queries import PSEUDONYM_KEY, table, tokenizer_file
from parcelwise.session import remove_scratch, scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_sent: list[Broadcast] = []


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage, which begins once the one before has been written: what that one had broadcast is taken back."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sent.destroy(_sent)
        bytewise.release()
        with sent.recording(_sent):
            return function(spark, docs, sf_dir)

    return run_stage


def _identity() -> Column:
    return F.struct("doc_id", F.xxhash64("text").alias("tie"))


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their language's perplexity threshold; null and empty texts pass."""
    return kneser_ney.accepted(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by doc_id, nulls first) of each group of near copies; texts without words stay, but for
    repeated rows."""
    found = jaccard.join(docs.select(_identity().alias("doc_id"), "text"))
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("identity")).distinct()
    named = docs.select(*COLUMNS, _identity().alias("identity"))
    return named.join(first, "identity", "left_semi").dropDuplicates(["identity"]).select(*COLUMNS)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    found = winnowing.decontaminate(docs.select(_identity().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    dirty = found.where("n_hit > 0").select(F.col("doc_id").alias("identity")).distinct()
    named = docs.select(*COLUMNS, _identity().alias("identity"))
    return named.join(dirty, "identity", "left_anti").select(*COLUMNS)


@stage
def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, private values in their texts replaced; n_chars follows the new text."""
    found = pseudonyms.pseudonymise(docs.select(*COLUMNS), PSEUDONYM_KEY)
    changed = F.when(F.size("replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*COLUMNS)


@stage
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their ids and checksums."""
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", private_values),
    ("packing", packed_sequences),
]

#: A byte-wise Kneser-Ney model, graph components and a tokenizer are beyond one SQL statement; tests compare the
#: stages with plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, all stages applied to the documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, function) in enumerate(STAGES):
        path = scratch_dir(spark, f"stage-{k}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_scratch(spark, before)
        before = path
    sent.destroy(_sent)
    return docs
