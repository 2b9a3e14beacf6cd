"""Vehicle readings -> typed columns -> model looked up by vehicle -> delimited files per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weir.config import StreamOptions
from weir.operators.enrich import enrich_first, lookup_join
from weir.operators.parse import parse_json, split_bad
from weir.sinks.tables import write_delimited
from weir.streaming.run import triggered

# Field names of the payload, fixed by its wire form.
READING = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("outsideTemperature", T.IntegerType()),
    T.StructField("engineTemperature", T.IntegerType()),
    T.StructField("speed", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])
RENAMED = {"outsideTemperature": "outside_temp", "engineTemperature": "engine_temp"}


def readings(raw: DataFrame, payload: str) -> DataFrame:
    """Typed readings, ``_bad_record`` set where a field is missing. Batch or stream."""
    return parse_json(raw, payload, READING, RENAMED).select(
        "vin", "outside_temp", "engine_temp", "speed", "timestamp", "_bad_record"
    )


def enriched_readings(raw: DataFrame, payload: str, vehicles: DataFrame, tie: str) -> DataFrame:
    """Good readings of known vehicles with their model."""
    good, _ = split_bad(readings(raw, payload))
    return enrich_first(good, vehicles, ["vin"], tie, ["model"])


def store_readings(enriched: DataFrame, path: str, max_records: int | None = None) -> None:
    write_delimited(enriched, path, "model", max_records=max_records)


def stream_readings(
    sdf: DataFrame, payload: str, vehicles: DataFrame, path: str, options: StreamOptions, max_records: int | None = None
) -> StreamingQuery:
    """Keep good readings of known vehicles as delimited files, a folder per model; a replayed batch adds nothing.

    ``vehicles`` has one row (vin, model) per vehicle, as a stored ``first_per_key`` has, so that no micro-batch
    ranks the dimension again. Read ``path`` with Spark, which follows the sink's log.
    """
    good, _ = split_bad(readings(sdf, payload))
    enriched = lookup_join(good, vehicles.select("vin", "model"), ["vin"], "inner")
    writer = enriched.writeStream.format("csv").partitionBy("model").outputMode("append")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    return triggered(writer, options).start(path)
