"""The corpus pipeline: quality filter, line dedup, near-duplicate removal,
benchmark decontamination and packing, each stage one operator of
``vellum.llm``, written as Parquet and read again by the next.

Every stage works on all rows that its predecessor kept. All but the last
return the columns of ``documents``; the last returns the packed pieces. Rows
with null ids pass the filters by their texts alone and are never removed as
near duplicates; a document of which no line is left stays, with an empty
text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellum.llm import chunk_tokens, decontaminate, line_dedup, ngram_join, packing, quality
from vellum.session import ensure_checkpoint_dir, shared_path, ship_package


def _ready(spark: SparkSession) -> None:
    """The shared folder is set and the executors have this package."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go (operator 9). It learns from
    the labelled rows of ``docs`` that are not held out."""
    _ready(spark)
    model = quality.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.good_documents(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay in one of them (operator 2); n_chars
    follows the text."""
    _ready(spark)
    left = line_dedup.without_shared_lines(docs)
    return left.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays
    (operator 4)."""
    _ready(spark)
    return ngram_join.first_of_components(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a test item go (operator 10)."""
    _ready(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token sequences (operator 5)."""
    _ready(spark)
    return packing.pack_documents(docs, chunk_tokens.vocabulary("byte_bpe_50k.json"))


STAGES = [("quality_filter", quality_filter), ("line_dedup", drop_lines), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("packing", pack)]

# The quality model's sums, the merges of the vocabulary and the packing search
# are no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each result is stored in the shared
    folder and read again."""
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return result
        path = shared_path(spark, "pipeline", f"{k}-{name}", unique=True)
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
