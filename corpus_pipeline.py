"""A corpus in five stages: language, toxicity, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its result is
written to the shared folder as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeferry.llm import jaccard, lang_cnn, mixing, packing, queries, string_kernel
from lakeferry.llm.common import table
from lakeferry.session import staged

#: A text is rejected as of no known language if it has no letter or if the mean probability of its
#: best language is below this; a text of one language lies far above, one of two near a half.
LEAST_SURE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network recognises."""
    scored = lang_cnn.predict(docs, queries.language_model(spark, sf_dir))
    known = (F.col("lang_pred") != lang_cnn.UNKNOWN) & (F.col("score") >= LEAST_SURE)
    return scored.where(known).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine does not call toxic."""
    scored = string_kernel.predict(docs, queries.toxicity_model(spark, sf_dir), "_toxic")
    return scored.where(F.col("_toxic") < queries.TOXIC).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar documents. Rows that repeat an
    id and its text stay once; under an id that stays, a different text stays as well."""
    classes = jaccard.join(docs)
    kept = classes.where("doc_id is null or doc_id = component_id").select("doc_id").distinct()
    stay = docs.join(kept.where("doc_id is not null"), "doc_id", "left_semi")
    once = stay.withColumn("_text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_hash"])
    return once.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order in which their sources are scheduled."""
    return mixing.in_order(mixing.mix(docs))


def in_files(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``position``, the number of a row in the files that hold the documents:
    Spark writes the partitions of a sorted frame to files whose names sort as they do. The frame is
    written first if it is not read from files."""
    file, row = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    try:
        placed = docs.select("doc_id", "text", file, row)
    except AnalysisException:
        placed = staged(docs.select("doc_id", "text"), "packing-docs").select("doc_id", "text", file, row)
    # one row a file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg((F.max("_row") + 1).alias("_rows"))
    starts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_file").select(
        "doc_id", "text", (F.col("_start") + F.col("_row")).alias("position")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in a sequence of 1024 tokens; sequences in the order of their ids
    follow the mix."""
    pieces = packing.pieces(in_files(docs), keep_position=True)
    return packing.pack(staged(pieces, "packing-pieces"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither the trained models nor the genetic algorithm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
