"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in shared storage and reads it again as the next stage's
input, so every stage works on all that its predecessor kept and a lost
executor costs no earlier stage. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm import decontaminate, near_dup, packing, quality, substring_dedup
from auditlens.llm.queries import byte_bpe, table
from auditlens.llm.shared import boxed, run_folder, unboxed, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the documents that ``labels`` marks.

    Null and empty texts are judged by their length alone; rows stay as they are, repeated ones too.
    """
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return unboxed(quality.score(boxed(docs), weights).where("predicted = 1"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Null and empty texts and texts without words are duplicates of nothing and all stay; of repeated rows one stays
    (of a group without ids one, too); an empty table gives no rows; very long texts are compared whole.
    """
    return near_dup.without_near_duplicates(docs)


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that occur elsewhere.

    A text that loses nothing stays as it is, another is its kept words joined
    by one space, with n_chars to match; a document of which nothing is left is
    left out.
    """
    cut = substring_dedup.remove_repeats(boxed(docs)).where("n_removed = 0 OR n_removed < n_words")
    changed = F.col("n_removed") > 0
    size = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    cut = cut.withColumn("row", F.col("row").withField("n_chars", size)) if "n_chars" in docs.columns else cut
    return unboxed(cut.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text"))), docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than half of every benchmark item.

    Null and empty texts hold nothing and stay, repeated rows and null ids stay as they are; an empty table on either
    side takes nothing away; very long texts are searched whole.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed: doc_id, piece, start, length, ids, sequence_id, offset.

    A null or empty text is its end sign alone; repeated rows and null ids have pieces of their own; texts longer than a
    sequence are cut, however long they are; an empty table gives no rows.
    """
    return packing.pack(packing.pieces_of(docs, byte_bpe()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("near_duplicates", near_dedup),
    ("repeated_passages", substring_removal),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: No SQL expresses the classifier, the tokenizer or the packing: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    folder = run_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
