"""A corpus pipeline of five stages over ``documents``; part of the training-data subpackage.

Each stage works on all that the stage before kept and is written as Parquet for the next; a stage's
table is deleted once the next one is written.

Defined results: all stages but the last return the rows they keep with all their columns, whatever those are called.
Null, empty and blank texts fail the base rule of the first stage; on their own, the other stages keep them. Rows
without a ``doc_id`` go through the filters like others, are near duplicates of nothing, and are packed. Repeated
rows are judged alike and one of them stays after ``near_dedup``; of rows of one id with other texts all stay there. Ties go to the smallest
id. Empty tables give empty results; without labels of both classes no document counts as toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline import session
from plumbline.llm.common import dropped, written_to
from plumbline.llm.minhash import one_of_each
from plumbline.llm.packing import packed
from plumbline.llm.pii import masked_documents
from plumbline.llm.quality import good_documents
from plumbline.llm.queries import table, tokenizer
from plumbline.llm.toxicity import clean_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose votes give a posterior of 0.1 or more and that pass the base rule."""
    session.prepared(spark)
    return good_documents(docs, threshold=0.1)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3, learnt from ``labels`` of documents still there."""
    session.prepared(spark)
    return clean_documents(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a 5-word shingle similarity of 0.8 or more."""
    session.prepared(spark)
    return one_of_each(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    session.prepared(spark)
    return masked_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    session.prepared(spark)
    return packed(docs, tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity), ("near_dedup", near_dedup), ("personal_data", personal_data), ("packing", packing)]

#: The learnt stages have no SQL; tests/llm/test_pipeline.py holds what each stage returns against a brute-force version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, new = written_to(stage(spark, docs, sf_dir), f"stage-{name}")
        if path:
            dropped(spark, path)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)
