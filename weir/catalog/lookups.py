"""Joins, upserts and deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.catalog import query
from weir.catalog.columns import _READINGS
from weir.catalog.frames import DAILY_CELLS, daily_cells, hourly, part_models, table, vehicle_json, vehicles
from weir.functions.keys import row_key
from weir.operators import enrich, keyed
from weir.plans import vehicle_enrich
from weir.streaming.keyed_table import KeyedTable
from weir.workspace import scratch

#: Buckets of the stored tables; the test tables are small.
_BUCKETS = 8

_ENRICHED = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name AS model
    FROM lineitem JOIN part ON l_partkey = p_partkey + 5
"""


@query(_ENRICHED)
def j1_enrich_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return enrich.enrich_first(items, part_models(spark, sf_dir), ["l_partkey"], "tie", ["model"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, p_name AS model FROM lineitem LEFT JOIN part ON l_partkey = p_partkey + 5
""")
def j1_enrich_first_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return enrich.enrich_first(items, part_models(spark, sf_dir), ["l_partkey"], "tie", ["model"], how="left")


@query("""
    SELECT c_custkey, json_object('c_custkey', o_custkey, 'o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus,
                                  'o_orderpriority', o_orderpriority)::VARCHAR AS document
    FROM customer JOIN orders ON c_custkey = o_custkey
""")
def j2_lookup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    return enrich.lookup_all(table(spark, sf_dir, "customer").select("c_custkey"), orders, ["c_custkey"])


@query(f"""
    SELECT key, events, column_key, cell.value
    FROM (SELECT event_type || '#' || strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') AS key, count(*) AS events
          FROM events GROUP BY ALL)
    JOIN ({DAILY_CELLS}) AS cell ON key = row_key
""")
def j3_lookup_rowkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored cells of every row key that events have, with the number of these events."""
    key = row_key(F.col("event_type"), F.date_trunc("day", F.col("ts"))).alias("key")
    wanted = table(spark, sf_dir, "events").groupBy(key).agg(F.count(F.lit(1)).alias("events"))
    return enrich.lookup_rowkey(wanted, daily_cells(spark, sf_dir), "key")


@query("""
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def j6_anti_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that never ordered urgently."""
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    buyers = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return enrich.anti_by_key(table(spark, sf_dir, "customer"), buyers, ["c_custkey"])


@query("""
    SELECT c_custkey, c_name, c_nationkey,
           round(c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 0 END, 2) AS c_acctbal, c_mktsegment
    FROM customer
    UNION ALL
    SELECT c_custkey + 10000000, c_name, c_nationkey, round(c_acctbal + 2, 2), c_mktsegment
    FROM customer WHERE c_custkey % 7 = 0
""")
def k5_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh customer changed twice, the second change wins, and copied under a new key."""
    base = table(spark, sf_dir, "customer")
    seventh = base.where("c_custkey % 7 = 0")
    targets = seventh.unionByName(seventh.withColumn("c_custkey", F.col("c_custkey") + 10_000_000))
    changes = targets.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "c_acctbal", F.col("c_acctbal") + F.col("version")
    )
    return keyed.upsert(base, changes, ["c_custkey"], ["version"]).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("""
    SELECT c_custkey, c_name, c_nationkey,
           round(c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 0 END, 2) AS c_acctbal, c_mktsegment
    FROM customer WHERE c_custkey % 11 <> 0
""")
def k5_k6_stored_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table after upserts and deletes, each batch delivered twice."""
    base = table(spark, sf_dir, "customer")
    stored = KeyedTable(scratch(spark, "merged"), ("c_custkey",), _BUCKETS)
    changes = base.where("c_custkey % 7 = 0").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "c_acctbal", F.round(F.col("c_acctbal") + F.col("version"), 2)
    )
    doomed = base.where("c_custkey % 11 = 0")
    for batch_id, (batch, order, deleted) in enumerate(((base, [], None), (changes, ["version"], None), (doomed, [], F.lit(True)))):
        for _ in range(2):
            stored.merge(batch, batch_id, "customers", order, deleted)
    return stored.read(spark).select(*base.columns).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT * FROM customer WHERE c_custkey % 11 <> 0")
def k6_delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer")
    return keyed.delete_by_key(base, base.where("c_custkey % 11 = 0"), ["c_custkey"])


def _january(first: str, last: str) -> str:
    return f"""
        SELECT event_type || '#' || strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') AS row_key,
               'v:' || user_id AS column_key, CAST(count(*) AS DOUBLE) AS value
        FROM events WHERE ts >= TIMESTAMP '{first}' AND ts < TIMESTAMP '{last}' GROUP BY ALL
    """


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cells of everything before the 20th, and of everything from the 15th."""
    events = table(spark, sf_dir, "events")
    before = events.where(F.col("ts") < F.expr("timestamp_ntz'2024-01-20'"))
    after = events.where(F.col("ts") >= F.expr("timestamp_ntz'2024-01-15'"))
    return keyed.to_cells(hourly(before)), keyed.to_cells(hourly(after))


_OLD, _NEW = _january("2024-01-01", "2024-01-20"), _january("2024-01-15", "2024-02-01")


@query(f"SELECT row_key, column_key, sum(value) AS value FROM ({_OLD} UNION ALL {_NEW}) GROUP BY ALL")
def j5_merge_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of both inputs are added: those of the 15th to the 19th double."""
    return keyed.wide_merge(*_merge_inputs(spark, sf_dir), mode="add")


@query(f"""
    WITH new AS ({_NEW})
    SELECT * FROM new UNION ALL SELECT * FROM ({_OLD}) AS old
    WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.row_key = old.row_key AND new.column_key = old.column_key)
""")
def k7_wide_merge_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the second input replace those of the first."""
    return keyed.wide_merge(*_merge_inputs(spark, sf_dir), mode="overwrite")


def _merged_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Both inputs written to a stored table, each twice under its batch id."""
    stored = KeyedTable(scratch(spark, "cells"), tuple(keyed.CELL), _BUCKETS)
    change = stored.add if mode == "add" else stored.merge
    for batch_id, cells in enumerate(_merge_inputs(spark, sf_dir)):
        for _ in range(2):
            change(cells, batch_id, "cells")
    return stored.read(spark)


@query(f"SELECT row_key, column_key, sum(value) AS value FROM ({_OLD} UNION ALL {_NEW}) GROUP BY ALL")
def j5_stored_merge_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_twice(spark, sf_dir, "add")


@query(f"""
    WITH new AS ({_NEW})
    SELECT * FROM new UNION ALL SELECT * FROM ({_OLD}) AS old
    WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.row_key = old.row_key AND new.column_key = old.column_key)
""")
def k7_stored_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_twice(spark, sf_dir, "overwrite")


@query(f"""
    SELECT reading.*, c_mktsegment AS model
    FROM ({_READINGS}) AS reading
    JOIN (SELECT substr(repeat(CAST(c_custkey AS VARCHAR), 17), 1, 17) AS vin, c_mktsegment,
                 row_number() OVER (PARTITION BY substr(repeat(CAST(c_custkey AS VARCHAR), 17), 1, 17)
                                    ORDER BY c_custkey) AS place
          FROM customer) AS vehicle
    ON reading.vin = vehicle.vin AND place = 1
""")
def plan_vehicle_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_enrich.enriched_readings(
        vehicle_json(spark, sf_dir), "payload", vehicles(spark, sf_dir), "tie"
    )
