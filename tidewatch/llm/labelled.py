"""The rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    """``crc32`` of the id as text, modulo ``FOLDS``; fold 0 is held out.  A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(0))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``(doc_id, label, text)`` of at most ``per_class`` documents of each label outside the held-out fold.

    They are the first by a hash of their id, so reruns agree.  What is joined to the documents has ``2 * per_class`` ids.
    Repeated labels of a document count as the larger one; labels other than 0 and 1 are left out.
    """
    known = (labels.filter(F.col(label).isin(0, 1) & (fold() > 0)).groupBy("doc_id").agg(F.max(label).alias("label"))
             .withColumn("_order", F.xxhash64("doc_id")))
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy("_order", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
    return texts.select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["doc_id"])
