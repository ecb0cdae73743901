"""The corpus pipeline: quality, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. All but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences with their ids.

Defined cases: other columns of the documents are left out. A null or empty text is scored like
any text, links with nothing, holds no personal data, has size 0 (the mix keeps it, once) and
packs as one closing id. Null ids are kept: among
near copies they come after all others. Repeated rows are copies of each other: one stays. Ties go to the smaller
id. Texts are read whole at every stage. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import curriculum_mix, jaccard_join, packing, pii, quality
from ledgerflow.llm.common import stored, table
from ledgerflow.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind; n_chars follows the text."""
    from pyspark.sql import functions as F

    masked = pii.redacted(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them, in training order."""
    return curriculum_mix.copies(docs.select(*COLUMNS), COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, token ids included, with their places in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near copies", one_of_near_copies),
    ("personal data", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

#: The quality stage learns a network from the labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet
    in the shared folder and read again as the next stage's documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage_{i + 1}")
    return docs
