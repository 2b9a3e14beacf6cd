"""Table and file sinks (K1-K4)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weir.config import StreamOptions
from weir.streaming.run import to_batches


@dataclass(frozen=True)
class Target:
    """Where a table lives: a path, a catalog table, or (``format="jdbc"``) whatever ``options`` connect to."""

    path: str | None = None
    table: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)


def write_table(df: DataFrame, target: Target, mode: str) -> None:
    writer = df.write.format(target.format).options(**target.options).mode(mode)
    if target.table:
        writer.saveAsTable(target.table)
    else:
        writer.save(target.path)


def append_table(df: DataFrame, target: Target) -> None:
    write_table(df, target, "append")


def replace_table(df: DataFrame, target: Target) -> None:
    """Replace the table's rows. A JDBC table is emptied and keeps its definition and grants."""
    if target.format == "jdbc":
        target = Target(target.path, target.table, target.format, {"truncate": "true", **target.options})
    write_table(df, target, "overwrite")


def read_table(spark: SparkSession, target: Target) -> DataFrame:
    if target.table:
        return spark.table(target.table)
    return spark.read.format(target.format).options(**target.options).load(target.path)


def table_exists(spark: SparkSession, target: Target) -> bool:
    if target.table:
        return spark.catalog.tableExists(target.table)
    if target.path:
        path = spark._jvm.org.apache.hadoop.fs.Path(target.path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    try:  # Only the database knows; there is no path to ask.
        read_table(spark, target)
    except AnalysisException:
        return False
    return True


def ensure_table(spark: SparkSession, target: Target, schema: T.StructType) -> bool:
    """Create the table empty if it is absent; True if that was so."""
    if table_exists(spark, target):
        return False
    write_table(spark.createDataFrame([], schema), target, "ignore")
    return True


#: Bytes after which a delimited file is closed.
ROLL_BYTES = 1 << 20


class _Rolls:
    """Cuts a task's lines into files by the bytes they take: a line that fills its file up is the last one in it."""

    def __init__(self, most: int):
        self.most = most
        self.open: dict[str | None, tuple[int, int]] = {}

    def numbers(self, key: str | None, sizes: np.ndarray) -> np.ndarray:
        """The file of each further line of ``key``."""
        file, held = self.open.get(key, (0, 0))
        ends, out, at = np.cumsum(sizes), np.empty(len(sizes), np.int64), 0
        while at < len(sizes):
            before = int(ends[at - 1]) if at else 0
            full = int(np.searchsorted(ends, before + self.most - held))
            out[at:full + 1] = file
            if full >= len(sizes):
                held += int(ends[-1]) - before
                break
            at, file, held = full + 1, file + 1, 0
        self.open[key] = (file, held)
        return out


def rolled_lines(df: DataFrame, by: str, sep: str, most: int) -> DataFrame:
    """(line, by, roll): delimited lines and the file each belongs to, ``task-file``. Sizes add up within a task and value of ``by``."""
    rest = [c for c in df.columns if c != by]
    lines = df.select(F.to_csv(F.struct(*rest), {"sep": sep}).alias("line"), F.col(by).cast("string").alias(by))

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls, task = _Rolls(most), TaskContext.get().partitionId()
        for batch in batches:
            keys = batch.column(by).dictionary_encode(null_encoding="encode")
            codes, sizes = keys.indices.to_numpy(), pc.binary_length(batch.column("line")).to_numpy() + 1
            file = np.zeros(batch.num_rows, np.int64)
            for code, key in enumerate(keys.dictionary.to_pylist()):
                own = codes == code
                file[own] = rolls.numbers(key, sizes[own])
            names = pa.array([f"{task:05d}-{f:06d}" for f in file.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("line"), batch.column(by), names], ["line", by, "roll"])

    return lines.mapInArrow(roll, T.StructType([*lines.schema.fields, T.StructField("roll", T.StringType())]))


def write_rolled(df: DataFrame, path: str, by: str, sep: str = ",", most: int = ROLL_BYTES, mode: str = "append") -> None:
    """Delimited text files below ``by=value/roll=task-file``, a new file as soon as one holds ``most`` bytes.

    So no file is larger than that and a line, and of a task's files for a value only the last is smaller. The
    rebalance hint gathers each value's rows and lets AQE split values too big for one task.
    """
    rolled_lines(df.hint("rebalance", by), by, sep, most).write.mode(mode).partitionBy(by, "roll").text(path)


def stream_rolled(sdf: DataFrame, path: str, by: str, options: StreamOptions, sep: str = ",", most: int = ROLL_BYTES) -> StreamingQuery:
    """The same for a stream, below ``batch_id=N``; a repeated micro-batch writes its folder anew."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_rolled(batch, f"{path}/batch_id={batch_id}", by, sep, most, mode="overwrite")

    return to_batches(sdf, write, options)


def read_rolled(spark: SparkSession, path: str, schema: T.StructType, by: str, sep: str = ",") -> DataFrame:
    """The stored rows; ``schema`` is that of the rows with ``by``."""
    in_files = T.StructType([f for f in schema if f.name != by])
    partitioned = in_files.add(by, schema[by].dataType)
    return spark.read.schema(partitioned).option("sep", sep).csv(path).select(*schema.names)


def write_delimited(df: DataFrame, path: str, by: str, sep: str = ",", max_records: int | None = None) -> None:
    """Delimited text files, a folder per value of ``by``, a new file after ``max_records`` rows.

    The rebalance hint gathers each value's rows and lets AQE split values too big for one task.
    """
    writer = df.hint("rebalance", by).write.mode("append").partitionBy(by).option("sep", sep)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.csv(path)
