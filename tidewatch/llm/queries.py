"""The operators as queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.mixing import op6_entropy_mixing
from tidewatch.llm.ngram_join import op1_ngram_jaccard
from tidewatch.llm.packing import op8_best_fit_packing
from tidewatch.llm.pii import op4_pii
from tidewatch.llm.quality_classifier import op3_fm_quality
from tidewatch.llm.quality_rules import op2_mcd_quality
from tidewatch.llm.search import op10_exact_top_k
from tidewatch.llm.sharding import op5_feistel_sharding
from tidewatch.llm.spelling_variants import op11_spelling_variants
from tidewatch.llm.suffix_dedup import op7_suffix_dedup
from tidewatch.llm.tier_packing import op12_tier_packing
from tidewatch.llm.token_alignment import op13_token_alignment
from tidewatch.llm.toxicity import op9_string_kernel_toxicity
from tidewatch.session import ensure_utc, ship_package

_OPERATORS: dict[Callable[..., DataFrame], tuple[str, ...]] = {
    op1_ngram_jaccard: ("documents",), op2_mcd_quality: ("documents",), op3_fm_quality: ("documents", "labels"),
    op4_pii: ("documents",), op5_feistel_sharding: ("documents",), op6_entropy_mixing: ("documents",),
    op7_suffix_dedup: ("documents",), op8_best_fit_packing: ("documents",),
    op9_string_kernel_toxicity: ("documents", "labels"), op10_exact_top_k: ("embeddings",),
    op11_spelling_variants: ("documents",), op12_tier_packing: ("documents",), op13_token_alignment: ("documents",),
}


def prepared(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    return ensure_utc(spark)


def _query(operator: Callable[..., DataFrame], tables: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepared(spark)
        return operator(*[spark.read.parquet(f"{folder}/{name}.parquet") for name in tables])
    run.__doc__ = operator.__doc__
    return run


REGISTRY = {operator.__name__: _query(operator, tables) for operator, tables in _OPERATORS.items()}

ORACLE = {
    "op10_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 20""",
}
