"""Packing documents into bounded payloads for bulk upload."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upload limits.
MAX_DOCS = 200
MAX_CHARS = 50_000


# Characters of the payloads that a task hands over together.
_CHARS_TOGETHER = 4_000_000

_PAYLOADS = "bucket long, payload_no long, docs array<string>, n_docs long, n_chars long"


def _packer(max_docs: int, max_chars: int):
    """Walk sorted rows batch by batch, holding the payload being filled and a bounded number of full ones.

    Documents stay in Arrow; only their lengths become Python numbers.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, number, n_docs, n_chars = None, 0, 0, 0
        full: list[tuple] = []
        pieces: list[pa.Array] = []  # the documents of the full payloads, then those of the open one

        def handed_over(docs: list[pa.Array]) -> pa.RecordBatch:
            buckets, numbers, counts, chars = zip(*full, strict=True)
            ends = pa.array([0, *accumulate(counts)], pa.int32())
            longs = [pa.array(c, pa.int64()) for c in (buckets, numbers, counts, chars)]
            listed = pa.ListArray.from_arrays(ends, pa.concat_arrays(docs))
            return pa.RecordBatch.from_arrays([*longs[:2], listed, *longs[2:]], names=["bucket", "payload_no", "docs", "n_docs", "n_chars"])

        for batch in batches:
            docs, begin, together = batch.column("doc"), 0, 0
            lengths = pc.utf8_length(docs).to_pylist()
            for i, (row_bucket, length) in enumerate(zip(batch.column("bucket").to_pylist(), lengths, strict=True)):
                another = row_bucket is None or row_bucket != bucket  # rows without a bucket go alone
                if another or n_chars >= max_chars or n_docs == max_docs:
                    if n_docs:
                        full.append((bucket, number, n_docs, n_chars))
                        together += n_chars
                        if together >= _CHARS_TOGETHER:
                            yield handed_over([*pieces, docs.slice(begin, i - begin)])
                            full, pieces, begin, together = [], [], i, 0
                    bucket, number, n_docs, n_chars = row_bucket, 0 if another else number + 1, 0, 0
                n_docs += 1
                n_chars += length
            open_from = max(begin, len(docs) - n_docs)
            if full:
                yield handed_over([*pieces, docs.slice(begin, open_from - begin)])
                full, pieces = [], []
            # Copied, so that the batch it is cut from need not be kept.
            pieces.append(docs.take(pa.array(range(open_from, len(docs)), pa.int64())))
        if n_docs:
            full = [(bucket, number, n_docs, n_chars)]
            yield handed_over(pieces)

    return pack


def bulk_pack(
    docs: DataFrame,
    id: str,
    text: str,
    max_docs: int = MAX_DOCS,
    max_chars: int = MAX_CHARS,
    bucket: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """(bucket, payload_no, docs, n_docs, n_chars): documents in id order, packed greedily per bucket.

    The size is tested before a document is added, so a payload may pass ``max_chars`` by its last
    document. A NULL text is an empty document.

    Packing is sequential within a bucket, so the number of buckets is how many tasks can work: give
    ``buckets`` by the size of the data, and documents are dealt by the MD5 of their id as text (those
    without an id go to bucket 0), or give a ``bucket`` of your own. Rows stream through, only the open
    payload is held.
    """
    if (bucket is None) == (buckets is None):
        raise ValueError("give either bucket or buckets")
    if bucket is None:
        digest = F.conv(F.substring(F.md5(F.col(id).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
        bucket = F.coalesce(digest % buckets, F.lit(0))
    dealt = docs.select(
        bucket.cast("long").alias("bucket"), F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("doc")
    )
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "id").select("bucket", "doc")
    return ordered.mapInArrow(_packer(max_docs, max_chars), _PAYLOADS)
