"""From raw documents to packed training sequences, in five stages.

Every stage works on all that its predecessor kept; all but the last return
the columns of ``documents``.  Rows that share a doc_id but not the text are
scored, cut and redacted each; of a class of near copies one row stays
(``first_of_class``); packing packs each.  No stage can be said in SQL throughout (trees,
MinHash, tokenizers), so ORACLE_SQL is None and tests compare each stage with
a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstone.llm.decontaminate import find_contamination
from gridstone.llm.near_join import first_of_class, near_classes
from gridstone.llm.packing import pack_documents
from gridstone.llm.pii import find_pii
from gridstone.llm.quality import score_quality, train
from gridstone.llm.queries import _byte_bpe
from gridstone.llm.state import written

LEAST_SCORE = 0.3
MOST_HIT = 0.5


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` with the columns of ``docs`` and n_chars of the new text."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores LEAST_SCORE or more; others go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, name="__score").where(F.col("__score") >= LEAST_SCORE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each class of near copies."""
    return first_of_class(docs, near_classes(docs, n=5, threshold=0.8))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document more than MOST_HIT of whose
    words stand in them goes whole."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10, cut=True)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return _like(docs, found.where(n_hit <= F.col("n_words") * MOST_HIT))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data gives way to its kind in brackets."""
    return _like(docs, find_pii(docs, replace=True))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 1024 tokens."""
    return pack_documents(docs, _byte_bpe(), capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
