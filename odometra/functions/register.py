"""Scalar and table functions for use in SQL text, defined in SQL so that Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalar import PAIR_BASE

FUNCTIONS = (
    f"pair_id(a BIGINT, b BIGINT) RETURNS BIGINT RETURN least(a, b) * {PAIR_BASE}L + greatest(a, b)",
    f"pair_first(p BIGINT) RETURNS BIGINT RETURN p div {PAIR_BASE}L",
    f"pair_second(p BIGINT) RETURNS BIGINT RETURN p % {PAIR_BASE}L",
    "huber_weight(r DOUBLE, c DOUBLE) RETURNS DOUBLE RETURN CASE WHEN abs(r) <= c THEN 1D ELSE c / abs(r) END",
    "frame_number(name STRING) RETURNS INT RETURN try_cast(regexp_extract(name, '(\\\\d+)(?:\\\\.[^./]*)?$', 1) AS INT)",
    "linear_offsets(overlap INT) RETURNS TABLE (gap INT) RETURN SELECT explode(sequence(1, overlap))",
    "quadratic_offsets(overlap INT) RETURNS TABLE (gap INT) RETURN SELECT explode(transform(sequence(0, overlap - 1), i -> shiftleft(1, i)))",
    "pixel_grid(width INT, height INT, step INT) RETURNS TABLE (u INT, v INT) RETURN SELECT u, v FROM (SELECT explode(sequence(0, width - 1, step)) AS u), (SELECT explode(sequence(0, height - 1, step)) AS v)",
)


def register(spark: SparkSession) -> list[str]:
    """Create the functions for the session; returns their names."""
    for f in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f}")
    return [f.split("(")[0] for f in FUNCTIONS]
