"""Words taken from a source stay near its target, however few its documents."""

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import mixing


def skewed():
    """20 sources of ten documents beside a hot one."""
    rare = F.concat(F.lit("rare"), (F.col("doc_id") / 5 % 20).cast("int").cast("string"))
    return F.when(F.col("doc_id") % 5 == 0, rare).otherwise("hot")


@pytest.mark.parametrize("hot", [False, True])
def test_targets_are_met(prepared, hot):
    frame = prepared.read.parquet("/root/testdata/sf0.01/documents.parquet")
    frame = frame.withColumn("source", skewed()) if hot else frame
    found = mixing.op6_entropy_mixing(frame)
    missed = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).collect()
    assert len(missed) >= 20 and all(r["size"] == r["source_size"] for r in missed)
    assert max(abs(r["taken"] - r["target"]) / r["target"] for r in missed) <= 0.01


def test_documents_of_one_size_share_the_remainder(prepared):
    table = [(k, "a b c d", "hot") for k in range(900)] + [(1000 + k, "a b c d", "rare") for k in range(7)] + [(None, "a b c d", "rare")] * 2
    found = mixing.op6_entropy_mixing(prepared.createDataFrame(table, "doc_id long, text string, source string")).collect()
    for size in (3600, 36):
        part = [r for r in found if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 2.001 and len(part) == size // 4
