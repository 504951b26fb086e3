"""A corpus made ready for training: filter, deduplicate, redact, mix, pack.

Each stage takes what the one before kept, whatever other columns that has, and returns its columns; the last returns
packed pieces.  A null or empty text goes through as a text without words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import mixing, ngram_join, packing, pii, quality_classifier
from tidewatch.llm.queries import prepared
from tidewatch.session import stored

BATCH_BYTES = 4 << 20  # of rows that are handed to a Python worker at once, about: executors keep what earlier stages took

#: SQL for run()'s rows: the classifier and the tokenizer have none.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_classifier.scored(docs, model)
    return scored.filter(F.col("_tw_score") >= quality_classifier.THRESHOLD).select(*_named(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    Rows that share an id stay or go together, equal ones once; rows without an id stay only where no member of a group has one.
    """
    groups = ngram_join.ngram_join(docs, gram=5, percent=80)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_tw_id")).distinct()
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_tw_id"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each span of personal data."""
    found = pii.with_spans(docs, redact=True)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return found.select(*_named(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = docs.select(F.struct(*_named(docs)).alias("_tw_doc"), "doc_id", "source", "text")
    mixed = mixing.mix_sources(rows, ["_tw_doc", "doc_id", "source"], narrow=False)
    repeated = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select("_tw_doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences."""
    return packing.op8_best_fit_packing(docs)


def _named(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


def _stage(function):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepared(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return function(spark, docs, sf_dir)
    run.__doc__ = function.__doc__
    return run


STAGES = [("quality classifier", _stage(quality)), ("n-gram Jaccard join", _stage(near_copies)), ("PII", _stage(personal_data)),
          ("mixing sources to target weights", _stage(source_mix)), ("best-fit packing", _stage(packed))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
