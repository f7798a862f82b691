"""Caller-supplied functions (UD1, UD2).

``apply_column`` takes any ``Column -> Column`` callable (built-in expressions
or a ``pandas_udf``).  ``batched_map`` wraps ``mapInPandas``: the function sees
Arrow batches of rows as pandas frames, at most ``ROWS`` at a time, and must
return the declared schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame

#: Rows of a frame that a caller's function gets: what it builds from long texts stays small.
ROWS = 1024


def apply_column(df: DataFrame, col: str, fn: Callable[[Column], Column], out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, fn(df[col]))


def batched_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), ROWS):
                yield fn(b.iloc[k : k + ROWS].reset_index(drop=True))
    return df.mapInPandas(run, schema)
