"""What must not stand in a plan that has to scale."""

import pytest

from weir.catalog import load_all

RUNS_JOBS = ("s1_", "s2_", "s3_", "s6_", "s7_", "s8_", "s9_", "k1_", "k2_", "k3_", "k4_", "k8_", "k9_", "k11_", "k12_", "k13_", "t", "f2_", "p7_")
LAZY = [n for n in load_all() if not n.startswith(RUNS_JOBS) and n not in (
    "a7_running_total_stream", "a7_running_total_per_tick", "a17_throughput_stream", "plan_vehicle_files", "plan_vehicle_files_stream", "plan_web_etl_stream",
    "plan_event_counter_stream", "k5_k6_stored_merge", "k7_stored_merge", "j5_stored_merge_add",
)]


def plan(spark, sf_dir, name):
    return load_all()[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_of_all_rows_and_no_row_udf(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("a2_windowed_key_sum", "ts:timestamp_ntz,user_id:bigint,event_type:string,value:double"),
        ("a6_tick_global_count", "event_id:bigint,ts:timestamp_ntz"),
        ("a10_byte_total", "text:string"),
        ("w1_top_n_per_group", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
        ("j1_enrich_first", "l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double"),
    ],
)
def test_scans_read_only_what_is_used(spark, sf_dir, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, sf_dir, name)


@pytest.mark.parametrize(
    ("name", "filters"),
    [
        ("p8_key_equals", "EqualTo(c_mktsegment,BUILDING)"),
        ("s5_start_time_filter", "GreaterThanOrEqual(ts,2024-01-15T06:00)"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, filters):
    assert filters in plan(spark, sf_dir, name)


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "a1_windowed_key_count")
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_count")


def final_plan(spark, sf_dir, name):
    df = load_all()[name].run(spark, sf_dir)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_running_words_shuffle_once_without_python(spark, sf_dir):
    text = final_plan(spark, sf_dir, "a9_running_word_count")
    assert "ReusedExchange" in text and "Python" not in text and "InArrow" not in text


def test_running_words_are_counted_without_sorting_them(spark, sf_dir):
    """Words per slice are counted by hash; only the numbering sorts all occurrences, led by a hash of the word."""
    text = final_plan(spark, sf_dir, "a9_running_word_count")
    assert text.count("row_number()") == 1 and "HashAggregate(keys=[_key" in text and "Sort [_key" in text


def test_updates_are_read_once(spark, sf_dir):
    """The base, and the two copies of it that the changes are made from."""
    assert final_plan(spark, sf_dir, "k5_upsert").count("Scan parquet") == 3


def test_payloads_are_parsed_once(spark, sf_dir):
    """Once as an object, and in brackets only where more follows it."""
    for name in ("p1_parse_json_typed", "plan_web_etl", "p2_extract_paths"):
        assert plan(spark, sf_dir, name).count("from_json(") == 2
