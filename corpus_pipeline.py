"""The corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last keep
the columns of ``documents``:

1. quality: documents whose posterior rejects them go;
2. near duplicates: one document of each component of five-word shingle sets
   with a Jaccard similarity of 0.8 or more stays, that with the smallest id;
3. repeats: words of passages of 50 words or more that a document with a smaller
   id has go, and ``n_chars`` is counted anew;
4. packing: what is left goes into sequences of at most 4096 tokens.

SQL cannot express the fitted stages, so the pipeline is tested against a
brute-force version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordspace.llm import jaccard, packing, quality, substring
from wordspace.llm.common import prepare, table
from wordspace.llm.queries import WORD_VOCABULARY
from wordspace.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep(quality.classify(spark, docs, model))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return jaccard.one_of_each(spark, docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has."""
    prepare(spark)
    return substring.without_repeats(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left in sequences of at most 4096 tokens."""
    prepare(spark)
    return packing.pack(spark, docs, WORD_VOCABULARY)


STAGES = [
    ("quality", good_quality),
    ("near-duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
