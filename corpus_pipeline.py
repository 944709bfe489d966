"""Training-data pipeline over ``documents``: five stages, each written as a
Parquet table in the shared checkpoint folder and read again by the next.

Every stage but the last returns the columns of ``documents``.  No SQL text
is given: learned scores, tokenizers and packing are outside of SQL; the
stages are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinreach.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from twinreach.llm.common import free_name, numbered, stored, table
from twinreach.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; every document stays, maybe empty."""
    out = line_dedup.without_repeated_lines(docs)
    return out.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c)
                        for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest id stays, one
    row of it.  Rows are linked by their texts alone, so rows that share an id
    stand for themselves.  Rows with a null id are in no group and stay."""
    row = free_name(docs, "_row")
    rows = numbered(docs, row, "numbered-documents")
    known = rows.where("doc_id is not null")
    groups = stored(ngram_join.near_groups(known.select(F.col(row).alias("doc_id"), "text")),
                    "near-groups").select(F.col("doc_id").alias(row), "component_id")
    first = known.select(row, "doc_id").join(groups, row).groupBy("component_id").agg(
        F.min(F.struct("doc_id", row)).alias("_first"))
    gone = stored(groups.select(row).join(first.select(F.col(f"_first.{row}").alias(row)), row,
                                          "left_anti"), "near-copies")
    return rows.join(gone, row, "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a passage of a benchmark item go.  Every row is judged
    by its text alone, whether its id is null, repeated or its own."""
    row = free_name(docs, "_row")
    rows = numbered(docs, row, "numbered-documents")
    gone = stored(decontaminate.contaminated_rows(rows, table(spark, sf_dir, "benchmark"), row),
                  "contaminated")
    return rows.join(gone, row, "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
