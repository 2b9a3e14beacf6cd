"""Key functions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from weir.functions.times import ROW_KEY_TIMESTAMP_FORMAT

# Stored key layout and the stand-in for a missing key.
KEY_DELIMITER = "#"
COLUMN_FAMILY = "v"
MISSING_KEY = "null"
ID_LENGTH = 17


def default_null_key(key: Column, default: str = MISSING_KEY) -> Column:
    return F.coalesce(key.cast("string"), F.lit(default))


def row_key(pk: Column, ts: Column) -> Column:
    """NULL if either part is."""
    return F.concat(pk.cast("string"), F.lit(KEY_DELIMITER), F.date_format(ts, ROW_KEY_TIMESTAMP_FORMAT))


def column_key(sk: Column, family: str = COLUMN_FAMILY) -> Column:
    return F.concat(F.lit(f"{family}:"), sk)


def split_row_key(key: Column) -> tuple[Column, Column]:
    """(primary key, timestamp); the primary key may itself hold the delimiter. NULLs for a key of another form."""
    pattern = rf"(?s)^(.*){KEY_DELIMITER}(\d{{14}})$"
    return (
        F.when(key.rlike(pattern), F.regexp_extract(key, pattern, 1)),
        F.try_to_timestamp(F.regexp_extract(key, pattern, 2), F.lit(ROW_KEY_TIMESTAMP_FORMAT)),
    )


def key_partition(key: Column, partitions: int) -> Column:
    """Partition number from the first four characters: digits count their value, others their distance from A.

    NULL for keys shorter than four characters; the remainder keeps the sign of the sum.
    """

    def worth(position: int) -> Column:
        char = F.substring(key, position, 1)
        return F.ascii(char) - F.when(char.between("0", "9"), ord("0")).otherwise(ord("A"))

    return F.when(F.length(key) >= 4, reduce(add, map(worth, range(1, 5))) % partitions)


def repeat_id(seq: Column, length: int = ID_LENGTH) -> Column:
    """Fixed-length id: the sequence number repeated and cut."""
    return F.substring(F.repeat(seq.cast("string"), length), 1, length)


def lookup_key(value: Column, field: str) -> Column:
    """The named property when the value is a JSON object holding it, else the value itself."""
    return F.coalesce(F.get_json_object(value, f"$.{field}"), value)
