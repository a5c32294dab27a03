"""A corpus pipeline of five stages.  Each takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns them with the columns of ``documents``; the last adds ``size`` and ``taken`` (words that the mix takes).

Rows are decided one by one, by the key of their place in the stage's table and never by doc_id: rows whose doc_id is null or repeats are
neither lost nor multiplied, and further columns pass through, whatever their names (own columns ``size`` and ``taken`` are
replaced).  Null and empty texts have no letter and go in the first stage; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loculoom.llm import decontaminate, exact_dedup, language_id, mixing, near_dedup
from loculoom.llm.common import cut, table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents stay that the model tells, with a calibrated probability of at least 0.4, to be in one of the corpus's languages:
    those of at least 1 % of its labelled documents.  Documents in others, unsure ones and those without a letter go; where nothing could
    be learned, all with a letter stay."""
    return language_id.identified(docs, language_id.train(language_id.learning_documents(docs)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts one row stays, that with the largest doc_id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each class stays, that with the smallest doc_id."""
    return near_dedup.without_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents of which the mix takes words, with how many."""
    return mixing.mix_rows(docs)


STAGES = [
    ("language ID", keep_languages),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
