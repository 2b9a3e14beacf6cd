"""A partitioned log of Parquet files as a stream with an offset per partition.

The log is a folder ``partition=N`` per partition, whose files hold ``offset`` besides the record. From the files'
statistics the source says up to which offset of each partition the next micro-batch goes, at most a given number of records
in all; the ranges between are read by a task each, short ones together. Offsets are in the query's checkpoint, so a restart goes on
where the last batch ended, and a batch that is repeated has the same ranges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema


def folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _partitions(system: fs.FileSystem, path: str) -> dict[int, list[str]]:
    """The data files of each partition; what a write has not yet published has another name."""
    found: dict[int, list[str]] = {}
    for info in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
        parts = info.path.removeprefix(path).strip("/").split("/")
        if info.is_file and len(parts) == 2 and parts[0].startswith("partition=") and parts[1][0] not in "._":
            found.setdefault(int(parts[0].partition("=")[2]), []).append(info.path)
    return found


def capped(start: dict[int, int], ends: dict[int, int], most: int | None) -> dict[int, int]:
    """The end offsets of a batch of at most ``most`` records: partitions get equal shares, and what others leave."""
    if most is None:
        return dict(ends)
    left, out = most, dict(start)
    open_ = sorted(p for p in ends if ends[p] > start.get(p, 0))
    for p in open_:
        out.setdefault(p, 0)
    while left and open_:
        part, more = divmod(left, len(open_))
        for i, p in enumerate(open_):
            taken = min(part + (i < more), ends[p] - out[p])
            out[p] += taken
            left -= taken
        open_ = [p for p in open_ if ends[p] > out[p]]
    return out


@dataclass
class OffsetRange:
    """The records of a partition from ``begin`` to before ``end``."""

    partition: int
    begin: int
    end: int
    #: The files that hold them; None: any of the partition's.
    files: list[str] | None = None


#: Offsets that a task reads at least, if there are as many: below that, starting it takes longer than reading.
TOGETHER = 10_000


@dataclass
class OffsetRanges(InputPartition):
    """What a task reads: one range, or several that are short."""

    ranges: list[OffsetRange]


def together(ranges: Sequence[OffsetRange], most: int = TOGETHER) -> list[OffsetRanges]:
    """The ranges by tasks; only those that fit ``most`` offsets in all share one."""
    tasks, room = [], 0
    for r in ranges:
        size = r.end - r.begin
        if tasks and size <= room:
            tasks[-1].ranges.append(r)
        else:
            tasks.append(OffsetRanges([r]))
            room = most
        room -= size
    return tasks


class LogReader(DataSourceStreamReader):
    """An offset is the end of each partition, {partition: offset}."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.most = int(options["maxrecords"]) if options.get("maxrecords") else None
        self.starting = options.get("starting", "earliest")
        self.at: dict | None = None
        self.known: dict[str, tuple[int, int]] = {}

    def _held(self) -> dict[int, list[tuple[str, int, int]]]:
        """Of each partition's files with records: path, first offset and the one after the last, from the footers; a file is looked at once."""
        system, path = folder(self.path)
        found: dict[int, list[tuple[str, int, int]]] = {}
        for partition, files in _partitions(system, path).items():
            for file in files:
                if file not in self.known:
                    about = pq.read_metadata(file, filesystem=system)
                    column = about.schema.names.index("offset")
                    held = [about.row_group(i).column(column).statistics for i in range(about.num_row_groups)]
                    self.known[file] = (min((s.min for s in held), default=0), max((s.max + 1 for s in held), default=0))
                low, high = self.known[file]
                if high > low:
                    found.setdefault(partition, []).append((file, low, high))
        return found

    def _bounds(self) -> dict[int, tuple[int, int]]:
        """First offset and the one after the last, per partition."""
        return {p: (min(low for _, low, _ in files), max(high for _, _, high in files)) for p, files in self._held().items()}

    def initialOffset(self) -> dict:
        bounds = self._bounds()
        if self.starting == "earliest":
            return {str(p): low for p, (low, _) in bounds.items()}
        if self.starting == "latest":
            return {str(p): high for p, (_, high) in bounds.items()}
        return {str(p): int(o) for p, o in json.loads(self.starting).items()}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
        bounds = self._bounds()
        begin = {p: max(int(self.at.get(str(p), low)), low) for p, (low, _) in bounds.items()}
        end = capped(begin, {p: max(high, begin[p]) for p, (_, high) in bounds.items()}, self.most)
        # Only partitions that advance change the offset; if none does, there is no batch.
        self.at = self.at | {str(p): e for p, e in end.items() if e > begin[p]}
        return self.at

    def partitions(self, start: dict, end: dict) -> Sequence[OffsetRanges]:
        # After a restart Spark plans the last batch of its log before it asks for more; that is where to go on.
        if self.at is None:
            self.at = end
        held = {str(p): files for p, files in self._held().items()}
        ranges = []
        for p, e in end.items():
            files = held.get(p, [])
            r = OffsetRange(int(p), int(start.get(p, min((low for _, low, _ in files), default=0))), int(e))
            r.files = [f for f, low, high in files if low < r.end and high > r.begin]
            ranges.append(r)
        return together([r for r in ranges if r.end > r.begin])

    def read(self, partition: OffsetRanges) -> Iterator[pa.RecordBatch]:
        """The records of the ranges, in Arrow batches; only files and row groups that meet a range are opened and read."""
        kind = to_arrow_schema(self.schema)
        system, root = folder(self.path)
        files = _partitions(system, root) if any(r.files is None for r in partition.ranges) else {}
        names = [f.name for f in kind if f.name != "partition"]
        for r in partition.ranges:
            inside = (ds.field("offset") >= r.begin) & (ds.field("offset") < r.end)
            log = ds.dataset(files.get(r.partition, []) if r.files is None else r.files, filesystem=system, format="parquet")
            for rows in log.to_batches(columns=names, filter=inside, use_threads=False):
                if rows.num_rows:
                    columns = {n: rows.column(n) for n in names} | {"partition": pa.array([r.partition] * rows.num_rows, pa.int32())}
                    yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in kind], schema=kind)


class PartitionedLog(DataSource):
    """Options: path, maxRecords per micro-batch, starting (earliest, latest, or JSON of offsets by partition)."""

    @classmethod
    def name(cls) -> str:
        return "partitioned_log"

    def schema(self) -> str:
        return "partition int, offset long, timestamp timestamp, value binary"

    def streamReader(self, schema: T.StructType) -> LogReader:
        return LogReader({k.lower(): v for k, v in self.options.items()}, schema)


def log_stream(spark: SparkSession, path: str, most: int | None = None, starting: str = "earliest") -> DataFrame:
    """(partition, offset, timestamp, value) of the log's records as they come, at most ``most`` per micro-batch.

    Run the query with a trigger: ``availableNow`` ends after the first micro-batch, since Spark then takes the first
    offset it is told for the last. A partition without records and one that appears later are read like the others.
    """
    spark.dataSource.register(PartitionedLog)
    reader = spark.readStream.format("partitioned_log").option("path", path).option("starting", starting)
    return (reader.option("maxRecords", most) if most else reader).load()
