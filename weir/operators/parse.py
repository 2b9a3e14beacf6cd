"""Turning payload text into columns (P1, P2, P4) and lines into words (A8's input, C7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.keys import default_null_key
from weir.functions.payload import words

BAD = "_bad_record"


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for costly expressions that are filtered on afterwards.

    A filter moves below a plain projection and repeats the expression for every use; it does not move
    below a generator, here one that yields exactly one row.
    """
    return df.withColumn(name, F.explode(F.array(value)))


_CORRUPT = "_corrupt"


def _object(text: Column, schema: T.StructType, options: Mapping[str, str] | None = None) -> Column:
    """The JSON object that is the whole text, else NULL.

    The parser stops at an object's end. Where a brace is followed by more than blanks, the text is read once more inside
    brackets: then whatever stands after the object is an error or another object. Flat payloads are parsed once.
    """
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {**(options or {}), "columnNameOfCorruptRecord": _CORRUPT}
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema), options)
    alone = F.when(text.rlike(r"\}\s*[^\s]"), F.coalesce(F.size(listed) == 1, F.lit(False))).otherwise(F.lit(True))
    whole = text.rlike(r"^\s*\{") & alone
    # An array of one, so that what is parsed can be looked at before it is passed on.
    return F.transform(F.array(F.from_json(text, marked, options)), lambda o: F.when(o[_CORRUPT].isNull() & whole, o))[0]


def parse_json(
    df: DataFrame,
    col: str,
    schema: T.StructType,
    rename: Mapping[str, str] | None = None,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Typed columns out of a JSON text column, which is replaced by them.

    Keys may be unquoted. Values are read as text and cast, so ``"55"`` is a valid INT. ``_bad_record``
    holds the text of rows that do not parse or lack a required field (default: every field), else NULL.
    """
    rename = rename or {}
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = _object(F.col("_text"), text, {"allowUnquotedFieldNames": "true"})
    typed = computed_once(df.withColumnRenamed(col, "_text"), "_parsed", parsed).withColumns({
        rename.get(f.name, f.name): F.col(f"_parsed.`{f.name}`").try_cast(f.dataType) for f in schema
    })
    missing = F.col("_parsed").isNull()
    for name in schema.names if required is None else required:
        missing = missing | F.col(rename.get(name, name)).isNull()
    bad = F.when(missing, F.coalesce("_text", F.lit("")))
    return typed.withColumn(BAD, bad).drop("_parsed", "_text")


def split_bad(df: DataFrame, policy: str = "drop") -> tuple[DataFrame, DataFrame | None]:
    """(good rows, bad rows) of a parsed frame.

    ``drop`` discards bad rows, ``quarantine`` returns them as the second frame, ``fail`` makes the
    query fail on the first one so the batch is replayed.
    """
    good = df.where(F.col(BAD).isNull()).drop(BAD)
    if policy == "drop":
        return good, None
    if policy == "quarantine":
        return good, df.where(F.col(BAD).isNotNull()).select(BAD)
    if policy == "fail":
        problem = F.raise_error(F.concat(F.lit("unparseable record: "), F.col(BAD)))
        checked = df.withColumn(BAD, F.when(F.col(BAD).isNotNull(), problem).cast("string"))
        return checked.where(F.col(BAD).isNull()).drop(BAD), None
    raise ValueError(f"policy must be drop, quarantine or fail, not {policy!r}")


def _text_schema(paths: Sequence[str]) -> T.StructType:
    """Struct of text leaves covering dotted paths, so that all of them come out of one parse."""
    heads: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        heads.setdefault(head, []).extend([rest] if rest else [])
    return T.StructType([
        T.StructField(head, _text_schema(rests) if rests else T.StringType()) for head, rests in heads.items()
    ])


def extract_paths(df: DataFrame, col: str, paths: Mapping[str, str], default: str | None = "null") -> DataFrame:
    """Add one text column per configured path; a missing value becomes ``default``.

    Rows that are not JSON objects carry their text in ``_bad_record``. Array steps such as ``a[0]`` and
    a path that is also the parent of another are read one by one, all others in a single parse.
    """
    listed = list(paths.values())
    clash = any(p != q and q.startswith(f"{p}.") for p in listed for q in listed)
    if clash or any("[" in path for path in listed):
        values = {out: F.get_json_object(F.col(col), f"$.{path}") for out, path in paths.items()}
        found = computed_once(df, "_found", _object(F.col(col), T.StructType([T.StructField(BAD, T.StringType())])))
        bad = F.col("_found").isNull()
    else:
        found = computed_once(df, "_found", _object(F.col(col), _text_schema(listed)))
        values = {out: F.col(f"_found.{path}") for out, path in paths.items()}
        bad = F.col("_found").isNull()
    values = {out: value if default is None else default_null_key(value, default) for out, value in values.items()}
    return found.withColumns({**values, BAD: F.when(bad, F.coalesce(F.col(col), F.lit("")))}).drop("_found")


def split_words(df: DataFrame, text: str, drop_empty: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """One row per word with its first letter."""
    split = df.select(*keep, F.explode(words(F.col(text))).alias("word"))
    if drop_empty:
        split = split.where("word <> ''")
    return split.withColumn("first_letter", F.substring("word", 1, 1))
