"""Text and delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, line) of every line in the named files."""
    return spark.read.text(list(paths)).select(F.input_file_name().alias("file"), F.col("value").alias("line"))


def load_dimension(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A headerless comma-separated dimension file."""
    return spark.read.schema(schema).csv(path)
