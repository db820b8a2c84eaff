"""Applying fitted encoders to a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from foldwright.operators.encode import apply_target


def encode_stream(stream: DataFrame, state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stream-static join with the state table: stateless, so any trigger works."""
    return apply_target(stream, state, cols)
