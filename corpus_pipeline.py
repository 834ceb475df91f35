"""The corpus pipeline: five stages over the documents table, each written and reread by the next.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given. The first four return the
columns of ``docs`` with the rows they keep; the last returns pieces of packed sequences with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sqlloom.llm import curve_packing, decontaminate, jaccard_join, language_crf, pu_quality
from sqlloom.llm.common import table
from sqlloom.llm.queries import TOKENIZER
from sqlloom.sources.scratch import RunScratch

#: A document goes if it has no language, or none that this share of its words takes.
LANGUAGE_SHARE = 0.3
#: Or if its words fit every learned language so much worse than those of learned documents do.
LANGUAGE_FIT = -12.0


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents whose words have a language, and are of a learned one."""
    labelled = language_crf.label(docs, language_crf.learn(docs), "__lang", "__share", "__fit")
    rejected = (F.col("__lang") == language_crf.UNDETERMINED) | (F.col("__share") < LANGUAGE_SHARE) | (F.col("__fit") < LANGUAGE_FIT)
    return labelled.where(~rejected).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents of at least its threshold."""
    model = pu_quality.learn(docs, table(spark, sf_dir, "labels"))
    return pu_quality.score(docs, model, "__quality").where(F.col("__quality") >= pu_quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents without a benchmark passage."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of token sequences and their ids, similar documents side by side."""
    return curve_packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", keep_languages),
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("packing", pack),
]

#: Two stages learn models and one tokenizes, which SQL does not express; the tests hold each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: each result is written as Parquet and reread. The written packing
    has the ids of each piece; the rows returned have their digest."""
    docs = table(spark, sf_dir, "documents")
    scratch = RunScratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs.select(*curve_packing.DIGEST)
