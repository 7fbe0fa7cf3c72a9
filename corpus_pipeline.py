"""From documents to packed training sequences, in five stages.

Every stage takes what the one before has kept and, but for the last, returns the columns of
documents. For all of them: null and empty texts and rows without a doc_id cause no error and stay unless
a stage says otherwise, further columns of any name or type are kept, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefeed.llm import decontaminate, lines, minhash, packing, toxicity
from changefeed.llm.components import stored
from changefeed.llm.queries import read
from changefeed.session import ship_package

ORACLE_SQL = None  # toxicity, sketches and tokens are beyond SQL; tests compare with plain Python


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model of the labelled ones; a null or empty text has the score
    of one without matched clauses. Repeated rows are judged alike, a score at the threshold goes."""
    return toxicity.drop_toxic(docs, toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, or nearly stand, in an earlier place by (doc_id, line). One with lines to
    lose and nothing left goes. Repeated rows lose their lines at the same places; of equal lines in one row the first stays."""
    return lines.drop_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id; of rows that repeat a doc_id and
    a text one. Texts without words are no duplicates of each other; rows without a doc_id all stay."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text, whole items of under five words included where they are all of a
    document. Repeated rows are judged alike; an empty benchmark leaves all documents."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 ids, in sequences, with their ids; a null or empty text is its one closing id, and
    every row is packed, repeated ones too."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written to the shared folder and read back."""
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
