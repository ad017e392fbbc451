"""The training-data pipeline: stages over ``documents``, each written to the shared folder and read again.

Every stage calls one operator of ``vigil.llm`` on all rows that the one before kept, and its decision takes effect.
All but the last return the columns of their input; ``n_chars``, where it is there, follows the text. Tables with
more columns keep them; empty tables give empty results; rows with nulls are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.bpe import round_trip, tokenizer_path
from vigil.llm.common import table
from vigil.llm.linededup import line_dedup
from vigil.llm.mixing import mix_documents, take
from vigil.llm.quality import gram_weights, keep_good, trusted_ids
from vigil.llm.simhash import keep_one
from vigil.session import write_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail a base rule or whose n-grams are far from the trusted ones (operator 8)."""
    weights = gram_weights(docs.select("doc_id", "text"), trusted_ids(table(spark, sf_dir, "labels")))
    return keep_good(docs, weights)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that an earlier line equals or nearly equals (operator 6); the documents stay."""
    out = line_dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates (operator 5)."""
    return keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix of sources asks for (operator 10): not at all up to three times."""
    return take(docs, mix_documents(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every document and decodes it again (operator 1): token counts and digests."""
    return round_trip(docs, tokenizer_path())


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_duplicate_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between two stages the rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = write_table(docs, f"pipeline-{name}")
    return docs


ORACLE_SQL = None       # hashes and byte-pair merges can't be written in SQL: tests hold run() against a brute-force version
