"""Documents to packed training sequences: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read back as the next stage's docs. ``run`` deletes
a stage's scratch tables once its result is written.

Defined cases of every stage: rows are judged one by one, also under a null or repeated doc_id; a null or empty text passes the
stages that find nothing in it; an empty table gives an empty result; columns other than doc_id and text go through unchanged
(``n_chars`` follows the text), whatever their names; texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm import decontaminate, linededup, packing, quality, simhash
from vitalframe.llm.common import table
from vitalframe.llm.queries import trusted_ids
from vitalframe.session import drop_paths, stage_paths, staged

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule (a null or empty text has too few words) or the n-gram ratio go."""
    return quality.keep_good(docs, trusted_ids(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut from the texts, of repeated rows from all but the first; n_chars follows
    the text, a null text stays null."""
    return with_length(linededup.dedup_lines(docs), docs)


def with_length(out: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (repeated rows, and texts without words, among them) only one row stays: that of the smallest
    doc_id, a null one last."""
    return simhash.keep_one(docs, by_row=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with benchmark passages go, whatever their doc_id; texts without words stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), by_row=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids; a null or empty text is its end id alone."""
    return packing.pack(docs, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

# The trained ratio, SimHash components and packing cannot be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), set(stage_paths())
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
            drop_paths(spark, set(stage_paths()) - before - {p for p in stage_paths() if f"/pipeline-{name}-" in p})
    return docs
