"""A corpus from raw documents in five stages; each works on all that the one before it kept.

The folder of ``sf_dir`` also gives the labels and the benchmark. Every stage but the last returns the columns of
``documents``.

Defined results, in every stage: columns beyond those of ``documents`` are kept, whatever their names; an empty table stays
empty, with its columns; whole texts are read, however long; a null doc_id is an id like any other. What a null or empty
text, a tie or a repeated row gives is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import scratch, table, written
from plumbline.llm.decontam import drop_leaks
from plumbline.llm.jaccard import one_of_each
from plumbline.llm.mixing import mix
from plumbline.llm.suffix import cut_repeats
from plumbline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects.

    A null or empty text has no features and stays; equal texts, repeated rows among them, are judged alike. A score of 0.5
    rejects. Without labels nothing is rejected.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Texts without words, null ones too, are near nothing and all stay; of rows that repeat id and text one stays; of
    different texts of one id each is judged, the smaller hash of the text decides.
    """
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat, in them or across them; every document stays.

    No copy is favoured: a passage goes from all its places, so repeated rows of long texts become empty. Null stays null.
    """
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents into which a benchmark item leaks.

    A null or empty text leaks nothing; repeated rows are judged alike; without a benchmark all stay.
    """
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents left, with the copies and words that the mix takes of each.

    A null or empty text has size 0 and nothing is taken of it; null is a source of its own, the last; repeated rows are
    drawn each. Columns of the input that are named like those of the mix are replaced.
    """
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL cannot express the classifier and the latent space; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with scratch(spark):
        for name, stage in STAGES[:-1]:
            # the mix reads the last of these tables when it runs; the others go
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}", keep=name == STAGES[-2][0])
    return STAGES[-1][1](spark, docs, sf_dir)
