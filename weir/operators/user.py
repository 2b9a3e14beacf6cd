"""User-written operators (F1). F2 is :func:`weir.streaming.run.to_batches`; F3 is plain composition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def row_operator(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Run ``fn``, which turns rows into none, one or many rows each, over Arrow batches. Batch or stream.

    For logic that no built-in function expresses; everything else is a ``df.transform``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(fn, batches)

    return df.mapInPandas(run, schema)
