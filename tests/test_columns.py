"""Column functions and parsing on literal inputs."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.config import AggregationOptions
from weir.functions import keys, payload, times
from weir.operators import parse
from weir.plans import vehicle_enrich, web_etl

REQUEST = '{"Timestamp":"2/15/2015 2:10:23 AM","Client":"127.0.0.1","Uri":"/foo/bar","Method":"DELETE","Result":"NotFound"}'
READING = '{vin:"ABCDEFGHIJKLMNOP",outsideTemperature:78,engineTemperature:250,speed:55,timestamp:123456789}'


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_key_partition(spark):
    expected = {"AAAABBBB": 0, "A100BADADFAFDSF": 1, "8888BADADFAFDSF": 0, "888CBADADFAFDSF": 26, "ABC": None, "": None}
    rows = spark.createDataFrame([(k,) for k in expected], "k string")
    found = rows.select("k", keys.key_partition(F.col("k"), 32).alias("p")).collect()
    assert {r.k: r.p for r in found} == expected


def test_key_partition_keeps_the_sign(spark):
    assert one(spark, keys.key_partition(F.lit("!!!!"), 32)) == 4 * (ord("!") - ord("A")) % -32


def test_stored_key(spark):
    key = keys.row_key(F.lit("NotFound"), F.lit("2015-02-15 00:55:00").cast("timestamp"))
    assert one(spark, key) == "NotFound#20150215005500"
    assert one(spark, keys.column_key(F.lit("127.0.0.1"))) == "v:127.0.0.1"


def test_split_row_key_at_the_last_delimiter(spark):
    pk, ts = keys.split_row_key(F.lit("a#b\n#c#20150215005500"))
    assert one(spark, pk) == "a#b\n#c"
    assert one(spark, ts.cast("string")) == "2015-02-15 00:55:00"


@given(st.integers(-(10**15), 4 * 10**15), st.integers(1, 10**7))
@settings(max_examples=25, deadline=None)
def test_multiples_count_from_year_one(spark, us, span_ms):
    span = timedelta(milliseconds=span_ms)
    ts = F.timestamp_micros(F.lit(us))
    row = spark.range(1).select(
        *[F.unix_micros(f(ts, span)) for f in (times.floor_ts, times.ceil_ts, times.round_ts)],
        F.unix_micros(times.window_of(ts, span).start),
    ).first()
    step, since = times.micros(span), us - times.YEAR_ONE_MICROS
    floor, ceil, nearest = since // step, -(-since // step), (since + step // 2) // step
    assert [v - times.YEAR_ONE_MICROS for v in row] == [floor * step, ceil * step, nearest * step, floor * step]


def test_exact_multiples_stay(spark):
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    for f in (times.floor_ts, times.ceil_ts, times.round_ts):
        assert one(spark, f(noon).cast("string")) == "2024-01-01 12:00:00"
    half = F.lit("2024-01-01 12:00:30").cast("timestamp")
    assert one(spark, times.round_ts(half).cast("string")) == "2024-01-01 12:01:00"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2/15/2015 2:10:23 AM", "2015-02-15 02:10:23"),
        ("2/15/2015 12:10:23 PM", "2015-02-15 12:10:23"),
        ("2015-02-15T02:10:23Z", "2015-02-15 02:10:23"),
        ("yesterday", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(times.parse_timestamp(F.col("t")).cast("string")).first()[0] == expected


def test_json_payload(spark):
    values = [F.lit(1), F.lit('a "b"'), F.lit(1.5), F.lit(None).cast("string"), F.lit(True)]
    assert one(spark, payload.to_json_payload(values)) == '[1,"a \\"b\\"",1.5,null,true]'
    assert one(spark, payload.to_json_payload([F.lit("x")])) == '"x"'


def test_rendering(spark):
    assert one(spark, payload.render_fields([F.lit("a"), F.lit(None).cast("int"), F.lit(3)])) == "0 = a, 1 = , 2 = 3"
    named = payload.render_fields([F.lit("V1"), F.lit(2015)], ["VIN", "Year"], sep=",", eq="=")
    assert one(spark, named) == "VIN=V1,Year=2015"


def test_url_encode(spark):
    assert one(spark, payload.url_encode(F.lit("a b/c?d=é"))) == "a+b%2Fc%3Fd%3D%C3%A9"


@pytest.mark.parametrize("size", [1, 36, 37, 100])
def test_fixed_payload(spark, size):
    assert one(spark, payload.fixed_payload(size)) == ("abcdefghijklmnopqrstuvwxyz0123456789" * 3)[:size]


def test_csv_fields(spark):
    vin, model, year = payload.csv_fields(F.lit("ABC,,"), ["vin", "model", "year"])
    assert [one(spark, c) for c in (vin, model, year)] == ["ABC", "", ""]
    assert one(spark, payload.csv_fields(F.lit("a.b.c"), ["x"], sep=".")[0]) == "a"


def test_words_keep_empty_pieces(spark):
    assert one(spark, payload.words(F.lit(" a  b "))) == ["", "a", "", "b", ""]


def test_repeat_id(spark):
    assert one(spark, keys.repeat_id(F.lit(123))) == "12312312312312312"


def test_lookup_key(spark):
    assert one(spark, keys.lookup_key(F.lit('{"id": "x7"}'), "id")) == "x7"
    assert one(spark, keys.lookup_key(F.lit("x7"), "id")) == "x7"


@pytest.mark.parametrize("wire", [READING, READING.replace("{vin", '{"vin"').replace("speed", '"speed"'), READING.replace("55", '"55"')])
def test_readings(spark, wire):
    good, _ = parse.split_bad(vehicle_enrich.readings(spark.createDataFrame([(wire,)], "payload string"), "payload"))
    assert [tuple(r) for r in good.collect()] == [("ABCDEFGHIJKLMNOP", 78, 250, 55, 123456789)]


def test_bad_readings(spark):
    wires = [READING, "junk", "", None, READING.replace("speed", "pace"), READING.replace("55", '"fast"'), READING[:-20]]
    raw = spark.createDataFrame([(w,) for w in wires], "payload string")
    parsed = vehicle_enrich.readings(raw, "payload")
    good, none = parse.split_bad(parsed)
    assert good.count() == 1 and none is None
    good, bad = parse.split_bad(parsed, "quarantine")
    assert good.count() == 1
    assert sorted(r[0] for r in bad.collect()) == sorted(w or "" for w in wires[1:])
    failing, _ = parse.split_bad(parsed, "fail")
    with pytest.raises(Exception, match="unparseable record"):
        failing.collect()
    with pytest.raises(ValueError, match="policy"):
        parse.split_bad(parsed, "ignore")


def test_field_named_like_the_payload(spark):
    raw = spark.createDataFrame([('{value: "1", other: "2"}',), ("{value",)], "value string")
    schema = T.StructType().add("value", "integer").add("other", "integer")
    good, bad = parse.split_bad(parse.parse_json(raw, "value", schema), "quarantine")
    assert [tuple(r) for r in good.collect()] == [(1, 2)] and [tuple(r) for r in bad.collect()] == [("{value",)]
    optional = parse.parse_json(raw, "value", schema.add("more", "integer"), required=["value"])
    assert [tuple(r) for r in parse.split_bad(optional)[0].collect()] == [(1, 2, None)]


def test_extract_paths(spark):
    rows = spark.createDataFrame([('{"a":{"b":1,"c":[7,8]},"d":"x"}',), ("{}",), ("nope",)], "j string")
    plain = parse.extract_paths(rows, "j", {"b": "a.b", "d": "d"}).collect()
    assert [(r.b, r.d, r._bad_record) for r in plain] == [("1", "x", None), ("null", "null", None), ("null", "null", "nope")]
    steps = parse.extract_paths(rows, "j", {"second": "a.c[1]", "a": "a"}, default=None).collect()
    assert [(r.second, r.a, r._bad_record) for r in steps] == [
        ("8", '{"b":1,"c":[7,8]}', None), (None, None, None), (None, None, "nope")
    ]


def test_request_log(spark):
    """The sample request, twice in its minute, one without a client, one without a time, one broken."""
    wires = [
        REQUEST, REQUEST.replace(":23", ":59"), REQUEST.replace('"Client":"127.0.0.1",', ""),
        REQUEST.replace("2/15/2015", "soon"), "{broken",
    ]
    raw = spark.createDataFrame([(w,) for w in wires], "payload string")
    cells = web_etl.web_etl(raw, "payload", AggregationOptions()).collect()
    assert sorted(map(tuple, cells)) == [
        ("NotFound#20150215021000", "v:127.0.0.1", 2.0), ("NotFound#20150215021000", "v:null", 1.0),
    ]
    swapped = web_etl.web_etl(raw, "payload", AggregationOptions().swapped()).collect()
    assert sorted(map(tuple, swapped)) == [
        ("127.0.0.1#20150215021000", "v:NotFound", 2.0), ("null#20150215021000", "v:NotFound", 1.0),
    ]
    marked = web_etl.keyed_events(raw, "payload", AggregationOptions()).where("_bad_record is not null")
    assert sorted(r.payload for r in marked.collect()) == sorted(wires[3:])


def test_arrival_time(spark):
    raw = spark.createDataFrame([(REQUEST, datetime(2024, 5, 1, 10, 0, 30))], "payload string, seen timestamp_ntz")
    options = AggregationOptions(timestamp_field=None)
    row = web_etl.keyed_events(raw, "payload", options, arrival=F.col("seen")).first()
    assert (row.ts, row.pk, row.sk) == (datetime(2024, 5, 1, 10, 0, 30), "NotFound", "127.0.0.1")


def test_keys_of_another_form_are_null(spark):
    row = spark.sql("SELECT 'p' AS pk, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS STRING) AS none, TIMESTAMP '2024-01-01' AS at, 'foreign' AS key")
    pk, ts = keys.split_row_key(F.col("key"))
    found = row.select(keys.row_key(F.col("pk"), F.col("ts")), keys.row_key(F.col("none"), F.col("at")), pk, ts).first()
    assert tuple(found) == (None, None, None, None)


def test_text_after_the_payload_is_bad(spark):
    texts = ['{"a":1}', '{"a":1} junk', '{"a":1},{"a":2}', '{"a":', "5", "", " ", '[{"a":1}]', None, ' {"a":{"b":1}} ']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    for paths in ({"a": "a"}, {"a": "a", "b": "a.b"}):
        found = parse.extract_paths(rows, "j", paths).where(f"{parse.BAD} IS NULL").orderBy("i").collect()
        assert [(r.i, r.a) for r in found] == [(0, "1"), (9, '{"b":1}')]
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert [r.i for r in parse.parse_json(rows, "j", schema).where(f"{parse.BAD} IS NULL").orderBy("i").collect()] == [0, 9]
