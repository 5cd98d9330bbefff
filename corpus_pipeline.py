"""Corpus pipeline: quality, exact duplicates, near duplicates, benchmark leaks, packing.

Each stage works on all rows its predecessor kept; what it decides takes
effect.  Stages but the last return the columns of documents; the last returns
the pieces of the packed sequences.  Rows with a null doc_id can't be named by
a decision of stages 2 to 4 and pass them; a row that repeats another's doc_id
shares its fate.  An empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontam, exact_dedup, near_dedup, packing, quality_fm
from pulsegrid.llm.common import materialise, table


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the ids in the only column of ``ids``."""
    name = _fresh(docs, "_dropped")
    gone = ids.toDF(name).filter(F.col(name).isNotNull()).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below its cut go."""
    name = _fresh(docs, "_score")
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, model, keep=tuple(docs.columns), name=name)
    return scored.filter(F.col(name) >= quality_fm.CUT).drop(name)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return _without(docs, exact_dedup.exact_groups(docs).filter("NOT kept").select("doc_id"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays."""
    return _without(docs, near_dedup.near_groups(docs).filter("NOT kept").select("doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or a passage of one go."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"), window=decontam.PASSAGE)
    return _without(docs, found.select("doc_id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontaminate),
          ("packing", pack)]

#: The classifier, near duplicates, alignment and the tokenizer have no SQL form: tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
