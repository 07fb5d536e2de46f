"""A training corpus from raw documents: the stages in order, each over all that the one before it kept.

Each stage is a function of (spark, docs, sf_dir); all but the last return the
columns of documents. A stage that changes texts sets n_chars anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import chosen_path, common, host_rules, line_index, packing, private_spans
from talkmill.llm.queries import TOKENIZERS


def recounted(docs: DataFrame) -> DataFrame:
    """docs with n_chars as the texts are now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a rule nor their host's verdict rejects."""
    common.prepare(spark)
    return host_rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller document holds."""
    common.prepare(spark)
    return recounted(line_index.dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    common.prepare(spark)
    return chosen_path.keep_first(docs, k=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    common.prepare(spark)
    return recounted(private_spans.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    common.prepare(spark)
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("private", private), ("pack", pack)]

#: SQL can't express the minwise join and the linear program; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir; each stage's result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
