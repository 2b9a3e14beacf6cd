"""Column functions and payload parsing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.catalog import query
from weir.catalog.frames import naive, table, vehicle_json, web_log
from weir.config import AggregationOptions
from weir.functions import keys, payload, times
from weir.operators import parse
from weir.operators.select import append_column
from weir.operators.user import row_operator
from weir.plans import vehicle_enrich, web_etl

SEVEN_MINUTES = timedelta(minutes=7)

# Arithmetic of spans counted from year 1, in microseconds.
_SINCE_YEAR_ONE = "(epoch_us(ts) + 62135596800000000)"
_SPAN = 7 * 60 * 1_000_000


def _floored(us: str) -> str:
    return f"make_timestamp({us} // {_SPAN} * {_SPAN} - 62135596800000000)"


@query(f"SELECT event_id, {_floored(_SINCE_YEAR_ONE)} AS floored FROM events")
def c1_floor_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", naive(times.floor_ts(F.col("ts"), SEVEN_MINUTES)).alias("floored"))


@query(f"SELECT event_id, {_floored(f'({_SINCE_YEAR_ONE} + {_SPAN - 1})')} AS ceiled FROM events")
def c2_ceil_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", naive(times.ceil_ts(F.col("ts"), SEVEN_MINUTES)).alias("ceiled"))


@query(f"SELECT event_id, {_floored(f'({_SINCE_YEAR_ONE} + {_SPAN // 2})')} AS rounded FROM events")
def c3_round_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", naive(times.round_ts(F.col("ts"), SEVEN_MINUTES)).alias("rounded"))


@query("SELECT event_id, event_type || '#' || strftime(ts, '%Y%m%d%H%M%S') AS row_key FROM events")
def c4_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", keys.row_key(F.col("event_type"), F.col("ts")).alias("row_key"))


@query("SELECT event_id, 'v:' || user_id AS column_key FROM events")
def c5_column_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", keys.column_key(F.col("user_id").cast("string")).alias("column_key"))


@query("SELECT event_id, event_type || '#' || user_id AS pk, date_trunc('second', ts) AS ts FROM events")
def c6_split_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary key holds the delimiter too."""
    key = keys.row_key(F.concat_ws("#", "event_type", F.col("user_id").cast("string")), F.col("ts"))
    pk, ts = keys.split_row_key(F.col("key"))
    keyed = table(spark, sf_dir, "events").select("event_id", key.alias("key"))
    return keyed.select("event_id", pk.alias("pk"), naive(ts).alias("ts"))


@query("""
    SELECT doc_id, word, substr(word, 1, 1) AS first_letter
    FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''
""")
def c7_split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.split_words(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def c8_epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.epoch_millis(F.col("ts")).alias("millis"))


@query("""
    SELECT event_id, '"' || event_type || '"' AS single,
           '[' || event_id || ',"' || event_type || '",' || value || ',null]' AS several
    FROM events
""")
def c9_to_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col("event_id"), F.col("event_type"), F.col("value"), F.lit(None).cast("string")]
    return table(spark, sf_dir, "events").select(
        "event_id",
        payload.to_json_payload([F.col("event_type")]).alias("single"),
        payload.to_json_payload(fields).alias("several"),
    )


@query("""
    SELECT event_id, '0 = ' || event_id || ', 1 = ' || event_type AS numbered,
           'Id=' || event_id || ',Type=' || event_type AS named
    FROM events
""")
def c10_render_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col("event_id"), F.col("event_type")]
    return table(spark, sf_dir, "events").select(
        "event_id",
        payload.render_fields(fields).alias("numbered"),
        payload.render_fields(fields, ["Id", "Type"], sep=",", eq="=").alias("named"),
    )


_WORTH = "ascii(substr(k, {0}, 1)) - CASE WHEN substr(k, {0}, 1) BETWEEN '0' AND '9' THEN 48 ELSE 65 END"


@query(f"""
    SELECT p_partkey, CASE WHEN length(k) >= 4 THEN ({" + ".join(_WORTH.format(i) for i in range(1, 5))}) % 32 END AS part
    FROM (SELECT p_partkey, upper(p_name) AS k FROM part
          UNION ALL SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS k FROM part)
""")
def c11_key_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    named = parts.select("p_partkey", F.upper("p_name").alias("k"))
    numbered = parts.select("p_partkey", F.col("p_partkey").cast("string").alias("k"))
    return named.unionByName(numbered).select("p_partkey", keys.key_partition(F.col("k"), 32).alias("part"))


@query("SELECT page_id, url_encode(url) AS encoded FROM pages")
def c12_url_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", payload.url_encode(F.col("url")).alias("encoded"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def c13_struct_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    sent = customers.select(payload.struct_to_json(F.struct("*")).alias("json"))
    return sent.select(payload.struct_from_json(F.col("json"), customers.schema).alias("row")).select("row.*")


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, substr(repeat('abcdefghijklmnopqrstuvwxyz0123456789', 3), 1, 100) AS message
    FROM orders
""")
def c14_fixed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), payload.fixed_payload(100).alias("message")
    )


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS ts FROM events
""")
def c15_parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log format, ISO for signups, junk for errors."""
    text = (
        F.when(F.col("event_type") == "error", "not a time")
        .when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", times.LOG_TIMESTAMP_FORMAT))
    )
    return table(spark, sf_dir, "events").select("event_id", naive(times.parse_timestamp(text)).alias("ts"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS vin, c_mktsegment AS model, CAST(NULL AS VARCHAR) AS year FROM customer")
def c16_csv_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment")
    return table(spark, sf_dir, "customer").select(*payload.csv_fields(line, ["vin", "model", "year"]))


@query("SELECT o_orderkey, substr(repeat(CAST(o_orderkey AS VARCHAR), 17), 1, 17) AS vin FROM orders")
def c17_repeat_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.repeat_id(F.col("o_orderkey")).alias("vin"))


_READINGS = """
    SELECT substr(repeat(CAST(o_custkey AS VARCHAR), 17), 1, 17) AS vin,
           CAST(o_orderkey % 100 AS INTEGER) AS outside_temp, CAST(180 + o_custkey % 100 AS INTEGER) AS engine_temp,
           CAST(o_orderkey % 100 AS INTEGER) AS speed, epoch_ms(o_orderdate) AS "timestamp"
    FROM orders WHERE o_orderkey % 10 <> 0
"""


@query(_READINGS)
def p1_parse_json_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse.split_bad(vehicle_enrich.readings(vehicle_json(spark, sf_dir), "payload"))
    return good


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k, 'null' AS missing, 'null' AS deep FROM events
""")
def p2_extract_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {"k": "k", "missing": "nope", "deep": "a.b"}
    found = parse.extract_paths(table(spark, sf_dir, "events"), "props", paths)
    return found.select("event_id", *paths)


@query("""
    SELECT date_trunc('day', ts) AS agg_ts, event_type AS pk,
           CASE WHEN event_type = 'purchase' THEN 'null' ELSE CAST(user_id AS VARCHAR) END AS sk,
           CAST(count(*) AS DOUBLE) AS value
    FROM events GROUP BY ALL
""")
def p3_default_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases carry no client."""
    return web_etl.windowed_counts(web_log(spark, sf_dir), "payload", AggregationOptions(window=timedelta(days=1)))


@query("""
    SELECT '{vin:"' || substr(repeat(CAST(o_custkey AS VARCHAR), 17), 1, 17) || '",speed' AS _bad_record
    FROM orders WHERE o_orderkey % 10 = 0
""")
def p4_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = parse.split_bad(vehicle_enrich.readings(vehicle_json(spark, sf_dir), "payload"), "quarantine")
    return bad


@query("SELECT *, year(o_orderdate) AS order_year FROM orders")
def p5_append_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append_column(table(spark, sf_dir, "orders"), "order_year", F.year("o_orderdate"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') ELSE event_type END AS lookup
    FROM events
""")
def p14_json_first_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") == "click", F.col("props")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", keys.lookup_key(value, "k").alias("lookup"))


@query("""
    SELECT word, substr(word, 1, 1) AS first_letter
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) WHERE word <> ''
""")
def f1_row_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word splitter written by a user over Arrow batches; c7 is the built-in form."""

    def split(batch):
        words = batch["text"].str.split(" ").explode().dropna()
        words = words[words != ""].to_frame("word")
        return words.assign(first_letter=words["word"].str[0])

    texts = table(spark, sf_dir, "conversations").select("text")
    return row_operator(texts, split, "word string, first_letter string")
