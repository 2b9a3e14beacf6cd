"""Web requests -> counts per window and key pair -> ranking -> wide keyed table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.streaming import StreamingQuery

from weir.config import AggregationOptions, StreamOptions
from weir.functions.times import duration, parse_timestamp
from weir.operators.aggregate import windowed_key_agg
from weir.operators.keyed import CELL, to_cells
from weir.operators.parse import BAD, computed_once, extract_paths, split_bad
from weir.operators.rank import top_n
from weir.streaming.keyed_table import KeyedTable
from weir.streaming.run import to_batches, to_files


def keyed_events(raw: DataFrame, payload: str, options: AggregationOptions, arrival: Column | None = None) -> DataFrame:
    """(ts, pk, sk) of JSON payloads; ``_bad_record`` marks those without a readable timestamp.

    Without a timestamp field the ``arrival`` column (default: now) tells the time.
    """
    paths = {"pk": options.primary_key, "sk": options.secondary_key}
    if options.timestamp_field is None:
        found = extract_paths(raw, payload, paths)
        return found.withColumn("ts", F.current_timestamp() if arrival is None else arrival)
    found = extract_paths(raw, payload, {**paths, "_ts": options.timestamp_field})
    timed = computed_once(found, "ts", parse_timestamp(F.col("_ts"))).drop("_ts")
    unread = F.when(F.col("ts").isNull(), F.coalesce(F.col(payload), F.lit("")))
    return timed.withColumn(BAD, F.coalesce(F.col(BAD), unread))


def windowed_counts(raw: DataFrame, payload: str, options: AggregationOptions, policy: str = "drop") -> DataFrame:
    """(agg_ts, pk, sk, value) of a batch of payloads, all windows."""
    good, _ = split_bad(keyed_events(raw, payload, options).select("ts", "pk", "sk", BAD), policy)
    return windowed_key_agg(good, "ts", options.window, "pk", "sk")


def web_etl(raw: DataFrame, payload: str, options: AggregationOptions, ranked: bool = False) -> DataFrame:
    """Cells to store: (row_key, column_key, value), with ``ranked`` only the top secondary keys per window."""
    counts = windowed_counts(raw, payload, options)
    if ranked:
        counts = top_n(counts, ["agg_ts", "pk"], "value", "sk", options.top_n)
    return to_cells(counts)


def cell_table(path: str, buckets: int = 64) -> KeyedTable:
    """The stored table of cells at ``path``."""
    return KeyedTable(path, tuple(CELL), buckets)


def stream_web_etl(
    sdf: DataFrame,
    payload: str,
    options: AggregationOptions,
    cells: KeyedTable,
    quarantine: str,
    stream: StreamOptions,
    ranked: bool = False,
    mode: str = "add",
    late: str = "drop",
) -> list[StreamingQuery]:
    """Keep the cells of a stream of payloads in the stored table ``cells``, and bad payloads as files at ``quarantine``.

    ``drop``: a window is written once, ``options.emit_delay`` after the newest event has passed its end, with
    ``ranked`` only its top secondary keys. ``merge``: every micro-batch adds its counts, however old their
    windows. :func:`cell_table` makes the table. Two queries, each with a checkpoint of its own.
    """
    if mode not in ("add", "overwrite"):
        raise ValueError(f"mode must be add or overwrite, not {mode!r}")
    if late == "merge" and (ranked or mode != "add"):
        raise ValueError("late payloads can only be added to unranked cells")
    events = keyed_events(sdf, payload, options).select("ts", "pk", "sk", BAD)
    good, bad = split_bad(events, "quarantine")

    def ranked_cells(batch: DataFrame, batch_id: int) -> None:
        # A closed window is whole in one micro-batch, so it can be ranked there.
        counts = top_n(batch, ["agg_ts", "pk"], "value", "sk", options.top_n) if ranked else batch
        if mode == "add":
            cells.add(to_cells(counts), batch_id)
        else:
            cells.merge(to_cells(counts), batch_id)

    def added_cells(batch: DataFrame, batch_id: int) -> None:
        cells.add(to_cells(windowed_key_agg(batch, "ts", options.window, "pk", "sk")), batch_id)

    if late == "drop":
        timed = good.withWatermark("ts", duration(options.emit_delay))
        counting = to_batches(windowed_key_agg(timed, "ts", options.window, "pk", "sk"), ranked_cells, _part(stream, "cells"))
    elif late == "merge":
        counting = to_batches(good, added_cells, _part(stream, "cells"))
    else:
        raise ValueError(f"late must be drop or merge, not {late!r}")
    return [counting, to_files(bad, quarantine, _part(stream, "bad"))]


def _part(stream: StreamOptions, name: str) -> StreamOptions:
    return replace(stream, checkpoint=f"{stream.checkpoint}/{name}")
