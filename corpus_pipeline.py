"""Corpus pipeline: quality rules, fuzzy line dedup, SimHash near-dedup, mixing to target weights, best-fit packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import lines, mixing, packing, quality, simhash
from tidemart.llm.common import Scratch
from tidemart.llm.queries import tokenizer_file

__all__ = ["STAGES", "ORACLE_SQL", "run"]


def _measured_again(docs: DataFrame) -> DataFrame:
    """Brings ``n_chars`` up to date after a stage that cuts texts."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits are cut from the others."""
    return _measured_again(quality.drop_boilerplate(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or similar lines only the first stays; no document goes."""
    return _measured_again(lines.drop_fuzzy_lines(docs))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.drop_near_copies(docs, shingle_words=4, radius=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as packed sequences of at most 2048 tokens."""
    return packing.pack_pieces(packing.tokenize_pieces(docs, tokenizer_file()))


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("simhash_near_dedup", simhash_stage),
          ("mixing", mixing_stage), ("best_fit_packing", packing_stage)]

#: Line dedup, SimHash and tokens are beyond SQL; tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written in the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = done
    return docs
