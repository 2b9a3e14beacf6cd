"""Sinks and file sources: what is written to the shared folder is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.catalog import query
from weir.catalog.columns import _WORTH
from weir.catalog.frames import DAILY_CELLS, daily_cells, lines, table, vehicle_json, vehicles
from weir.functions.keys import key_partition
from weir.operators import keyed, words
from weir.operators.packing import bulk_pack
from weir.plans import vehicle_enrich
from weir.sinks import payloads, tables
from weir.sources import files
from weir.workspace import scratch


@query("SELECT * FROM lineitem")
def k1_delimited_files_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    path = scratch(spark, "delimited")
    tables.write_delimited(items, path, "l_returnflag", max_records=20_000)
    in_files = T.StructType([f for f in items.schema if f.name != "l_returnflag"])
    return spark.read.schema(in_files.add("l_returnflag", T.StringType())).csv(path)


@query("SELECT * FROM lineitem")
def k1_rolled_files_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a megabyte, a folder per flag."""
    items = table(spark, sf_dir, "lineitem")
    path = scratch(spark, "rolled")
    tables.write_rolled(items, path, "l_returnflag")
    return tables.read_rolled(spark, path, items.schema, "l_returnflag")


@query("SELECT * FROM orders")
def k2_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = tables.Target(scratch(spark, "appended"))
    for open_orders in (True, False):
        tables.append_table(orders.where((F.col("o_orderstatus") == "O") == F.lit(open_orders)), target)
    return tables.read_table(spark, target)


@query("SELECT s_suppkey, s_acctbal + 1 AS s_acctbal FROM supplier")
def k3_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    target = tables.Target(scratch(spark, "replaced"))
    tables.replace_table(balances, target)
    tables.replace_table(balances.withColumn("s_acctbal", F.col("s_acctbal") + 1), target)
    return tables.read_table(spark, target)


@query("SELECT * FROM customer")
def k4_create_if_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created once, then left alone."""
    customers = table(spark, sf_dir, "customer")
    target = tables.Target(scratch(spark, "ensured"))
    tables.ensure_table(spark, target, customers.schema)
    tables.append_table(customers, target)
    tables.ensure_table(spark, target, customers.schema)
    return tables.read_table(spark, target)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'd:' || name AS column_key, value
    FROM (UNPIVOT (SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
                          CAST(c_acctbal AS VARCHAR) AS balance, c_mktsegment AS segment FROM customer)
          ON name, nation, balance, segment INTO NAME name VALUE value)
""")
def k8_batched_row_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["name", "nation", "balance", "segment"]
    target = tables.Target(scratch(spark, "records"))
    tables.append_table(keyed.record_cells(table(spark, sf_dir, "customer"), "row_key", names, family="d"), target)
    return tables.read_table(spark, target)


@query("""
    SELECT '"' || c_name || '"' AS document FROM customer UNION ALL SELECT CAST(c_acctbal AS VARCHAR) FROM customer
""")
def k9_document_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "documents")
    payloads.to_documents(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"]).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "document")


def _packed(bucket: str) -> str:
    return f"""
    WITH RECURSIVE docs AS (
        SELECT {bucket} AS bucket, row_number() OVER (PARTITION BY {bucket} ORDER BY doc_id) AS place,
               text, length(text) AS chars
        FROM documents),
    packed AS (
        SELECT bucket, place, text, 0 AS payload_no, 1 AS held, chars AS filled FROM docs WHERE place = 1
        UNION ALL
        SELECT d.bucket, d.place, d.text,
               CASE WHEN p.filled >= 50000 OR p.held = 200 THEN p.payload_no + 1 ELSE p.payload_no END,
               CASE WHEN p.filled >= 50000 OR p.held = 200 THEN 1 ELSE p.held + 1 END,
               CASE WHEN p.filled >= 50000 OR p.held = 200 THEN d.chars ELSE p.filled + d.chars END
        FROM packed p JOIN docs d ON d.bucket = p.bucket AND d.place = p.place + 1)
    SELECT bucket, CAST(payload_no AS BIGINT) AS payload_no, count(*) AS n_docs,
           CAST(sum(length(text)) AS BIGINT) AS n_chars, md5(string_agg(text, chr(1) ORDER BY place)) AS docs_md5
    FROM packed GROUP BY ALL
"""


def _payload_digests(packed: DataFrame) -> DataFrame:
    joined = F.md5(F.array_join("docs", "\u0001").cast("binary")).alias("docs_md5")
    return packed.select("bucket", "payload_no", "n_docs", "n_chars", joined)


@query(_packed("doc_id // 250"))
def k10_bulk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _payload_digests(bulk_pack(docs, "doc_id", "text", bucket=F.expr("doc_id div 250")))


@query(_packed("CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 16"))
def k10_bulk_pack_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents dealt by their ids' hash."""
    return _payload_digests(bulk_pack(table(spark, sf_dir, "documents"), "doc_id", "text", buckets=16))


@query("""
    SELECT CAST(event_id % 4 AS INTEGER) AS "partition", '[' || event_id || ',"' || event_type || '",' || value || ']' AS value
    FROM events
""")
def k11_event_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = scratch(spark, "log")
    records = payloads.event_payload(events, ["event_id", "event_type", "value"], F.col("event_id") % 4)
    payloads.write_log_files(records, path)
    return spark.read.parquet(path)


@query(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS value,
           CASE WHEN length(k) >= 4 THEN ({" + ".join(_WORTH.format(i) for i in range(1, 5))}) % 32 END AS "partition"
    FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS k FROM orders)
""")
def k12_keyed_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in a log of files, in 32 partitions by their key; keys that are too short have none."""
    path = scratch(spark, "log")
    records = payloads.keyed_payload(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderpriority")
    payloads.write_log_files(records.withColumn("partition", key_partition(F.col("key"), 32)), path)
    return spark.read.parquet(path).select("key", "value", "partition")


@query("""
    SELECT 'row ' || row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id)
           || ': 0 = ' || event_id || ', 1 = ' || event_type || ', 2 = ' || value AS line
    FROM events
""")
def k13_console_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of four tasks, each numbering its own."""
    events, path = table(spark, sf_dir, "events"), scratch(spark, "lines")
    dealt = events.repartitionById(4, (F.col("event_id") % 4).cast("int")).sortWithinPartitions("event_id")
    payloads.write_lines(dealt.select("event_id", "event_type", "value"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("""
    SELECT source, count(*) AS lines, CAST(sum(len(string_split(line, ' '))) AS BIGINT) AS words
    FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
    GROUP BY source
""")
def s6_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files, a folder per source, read line by line."""
    by_source = lines(spark, sf_dir)
    counted = words.file_word_count(by_source, "source", "line")
    return by_source.groupBy("source").agg(F.count(F.lit(1)).alias("lines")).join(counted, "source")


@query("SELECT p_partkey, p_name FROM part")
def s7_csv_dimension_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delimited dimension file loaded over the table of the load before."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    path, target = scratch(spark, "csv"), tables.Target(scratch(spark, "dimension"))
    parts.write.csv(path)
    tables.replace_table(parts.withColumn("p_name", F.lit("outdated")), target)
    tables.replace_table(files.load_dimension(spark, path, parts.schema), target)
    return tables.read_table(spark, target)


def _stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "cells")
    keyed.write_cells(daily_cells(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(f"""
    SELECT * FROM ({DAILY_CELLS}) WHERE row_key >= 'click#20240110000000' AND row_key < 'click#20240120000000'
""")
def s8_key_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.key_range_scan(_stored_cells(spark, sf_dir), "click#20240110000000", "click#20240120000000")


@query(f"SELECT * FROM ({DAILY_CELLS}) WHERE row_key IN ('view#20240105000000', 'error#20240129000000')")
def s9_point_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.point_scan(_stored_cells(spark, sf_dir), ["view#20240105000000", "error#20240129000000"])


@query(f"""
    SELECT * FROM ({DAILY_CELLS})
    WHERE row_key IN (SELECT event_type || '#' || strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') FROM events WHERE extract('day' FROM ts) % 3 = 0)
""")
def s9_many_points_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row keys of every third day, some of which are not stored, each pushed into the scan."""
    types = ["click", "error", "purchase", "signup", "view", "none"]
    return keyed.point_scan(_stored_cells(spark, sf_dir), [f"{t}#202401{day:02d}000000" for t in types for day in range(3, 32, 3)])


@query("""
    SELECT c_mktsegment AS model, count(*) AS vehicles
    FROM (SELECT substr(repeat(CAST(o_custkey AS VARCHAR), 17), 1, 17) AS vin FROM orders WHERE o_orderkey % 10 <> 0)
    JOIN (SELECT substr(repeat(CAST(c_custkey AS VARCHAR), 17), 1, 17) AS vin, arg_min(c_mktsegment, c_custkey) AS c_mktsegment
          FROM customer GROUP BY ALL) USING (vin)
    GROUP BY ALL
""")
def plan_vehicle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per model, counted from the files stored per model."""
    path = scratch(spark, "readings")
    enriched = vehicle_enrich.enriched_readings(vehicle_json(spark, sf_dir), "payload", vehicles(spark, sf_dir), "tie")
    vehicle_enrich.store_readings(enriched, path)
    schema = "vin string, outside_temp int, engine_temp int, speed int, timestamp long, model string"
    return spark.read.schema(schema).csv(path).groupBy("model").agg(F.count(F.lit(1)).alias("vehicles"))
