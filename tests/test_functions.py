import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions import dates, jsonpath, text
from weirstone.operators.masking import mask_type
from weirstone.sources.buckets import bucket_events, bucket_name, closed_buckets
from weirstone.sources.sinks import issuer_mapping_path, report_path

from helpers import rows, ts


def one(spark, column, **values):
    literals = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*literals).select(column).first()[0]


def test_document_values(spark):
    texts = [
        ('{"id":"5","p":{"n":10330,"flag":false,"t":"2024-05-29T20:34:13.334Z"}}',),
        ('{"id":7,"p":{"n":"none","flag":"x","t":null}}',),
        ('{"id":"5","p":{"n":1',),
        ("{'id':'5'}",),
        (None,),
        ("{}",),
    ]
    df = spark.createDataFrame(texts, "m string")
    parsed = jsonpath.with_document(df, F.col("m"), ["id", "p.n", "p.flag", "p.t"])
    got = parsed.select(
        jsonpath.field("id"), jsonpath.field("p.n", "int"), jsonpath.field("p.flag", "boolean"), jsonpath.field("p.t", "timestamp")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("5", 10330, False, ts("2024-05-29 20:34:13.334")),
        ("7", None, None, None),
        *[(None,) * 4] * 4,
    ]


def test_document_schema_rejects_nested_leaves():
    assert jsonpath.document_schema(["a", "b.c"]) == "struct<`a`:string,`b`:struct<`c`:string>>"
    with pytest.raises(ValueError):
        jsonpath.document_schema(["a", "a.b"])
    with pytest.raises(ValueError):
        jsonpath.document_schema(["a.b", "a"])


def test_can_json_parse(spark):
    df = spark.createDataFrame([('{"a":1}',), ("[1,2]",), ("{a",), (None,)], "t string")
    assert [r[0] for r in df.select(jsonpath.can_json_parse(F.col("t"))).collect()] == [True, True, False, None]


def test_json_helpers(spark):
    assert one(spark, jsonpath.json_extract_path_text(F.col("t"), "a.b"), t='{"a.b":"x"}') == "x"
    assert one(spark, jsonpath.json_extract_path_text(F.col("t"), "a"), t='{"a":null}') is None
    assert one(spark, jsonpath.first_array_element(F.col("t")), t='["email","x"]') == "email"
    assert one(spark, jsonpath.first_value_or_self(F.col("t")), t='{"events":{"urn:x":{"a":1}}}') == '{"a":1}'
    assert one(spark, jsonpath.first_value_or_self(F.col("t")), t='{"events":{}}') == '{"events":{}}'


def test_period_labels(spark):
    day = F.col("d")
    value = dt.date(2025, 9, 3)
    assert one(spark, dates.date_key(day), d=value) == 20250903 == dates.date_key_of(value)
    assert one(spark, dates.quarter_label(day), d=value) == "Q32025"
    assert one(spark, dates.month_tag(day), d=value) == "Sep-2025"
    assert one(spark, dates.period_start(day, "weekly"), d=value) == dt.date(2025, 9, 1)
    with pytest.raises(ValueError):
        dates.check_cadence("yearly")


@pytest.mark.parametrize(
    ("run", "back", "start", "end"),
    [
        ("2026-01-01", 2, "2025-10-01", "2026-01-01"),
        ("2025-04-02", 2, "2025-01-01", "2025-04-01"),
        ("2025-04-03", 2, "2025-04-01", "2025-07-01"),
        ("2025-12-31", 0, "2025-10-01", "2026-01-01"),
    ],
)
def test_quarter_of(run, back, start, end):
    assert dates.quarter_of(dt.date.fromisoformat(run), back) == (ts(start), ts(end))


def test_quarter_of_limits():
    with pytest.raises(ValueError):
        dates.quarter_of(dt.date(2025, 1, 1), 91)
    assert dates.month_of(dt.date(2024, 12, 5)) == (ts("2024-12-01"), ts("2025-01-01"))


def test_epoch_and_bucket(spark):
    assert one(spark, dates.epoch_seconds(F.col("s")), s=1_780_602_749.25) == ts("2026-06-04 19:52:29.25")
    assert one(spark, dates.bucket_floor(F.col("t")), t=ts("2024-01-01 10:09:59.9")) == ts("2024-01-01 10:05:00")
    assert one(spark, bucket_name(F.col("t")), t=ts("2024-01-01 10:09:59")) == "fraud-ops-events:2024-01-01T10:05:00Z"


def test_bucket_events_and_open_bucket(spark):
    names = [("fraud-ops-events:2024-01-01T23:55:00Z",), ("fraud-ops-events:2024-01-02T00:00:00Z",), ("odd",)]
    df = spark.createDataFrame(names, "bucket_name string")
    dated = bucket_events(closed_buckets(df, F.lit(ts("2024-01-02 00:03:00"))))
    assert rows(dated, "partition_dt") == [(dt.date(2024, 1, 1),), (None,)]


def test_instants_do_not_follow_the_machine_zone(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        shown = F.date_format(dates.instant(ts("2024-01-01 12:00:00")), "yyyy-MM-dd HH:mm")
        assert spark.range(1).select(shown).first()[0] == "2024-01-01 12:00"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_order_key_keeps_long_numbers(spark):
    key = text.order_key(F.col("g"), F.col("n"))
    assert one(spark, key, g="gtc1234", n=1) == "gtc1234-0001"
    assert one(spark, key, g="gtc", n=12345) == "gtc-12345"


def test_strict_integer(spark):
    cells = [("12",), (" 7 ",), ("",), ("   ",), (None,), ("2.5",), ("invalid_number",), ("-3",)]
    df = spark.createDataFrame(cells, "v string")
    got = df.select(text.strict_integer(F.col("v")), text.is_bad_integer(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [
        (12, False), (7, False), (None, False), (None, False), (None, False), (None, True), (None, True), (-3, False),
    ]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("{a,b}", ["a", "b"]),
        ("{}", []),
        ('{"x,y",NULL,"q\\"r"}', ["x,y", None, 'q"r']),
        ("{solo}", ["solo"]),
        ("plain", None),
        (None, None),
    ],
)
def test_pg_array(spark, source, expected):
    df = spark.createDataFrame([(source,)], "t string")
    assert df.select(text.pg_array_to_array(F.col("t"))).first()[0] == expected


def test_report_path():
    latest, dated = report_path("fraud", "csv", dt.date(2025, 11, 9), env="dev", directory="idp", subname="lg99")
    assert latest == "dev/idp/fraud/latest.fraud/lg99.csv"
    assert dated == "dev/idp/fraud/2025/2025-11-09.fraud/lg99.csv"
    assert issuer_mapping_path("dev") == "dev/portal/issuers_service_provider_id.json"
    assert report_path("x", "csv", dt.date(2025, 1, 2))[1] == "x/2025/2025-01-02.x.csv"


def test_mask_type():
    kinds = [T.StringType(), T.CharType(5), T.VarcharType(9), T.LongType(), T.DecimalType(9, 2), T.DateType(), T.TimestampNTZType(),
             T.BooleanType(), T.VariantType(), T.BinaryType()]
    assert [mask_type(k) for k in kinds] == [
        "VARCHAR(MAX)", "CHAR(5)", "VARCHAR(MAX)", "NUMERIC", "NUMERIC", "DATE", "TIMESTAMP", "BOOLEAN", "SUPER", "VARCHAR(MAX)",
    ]


def test_text_after_a_document_is_no_document(spark):
    texts = ['{"id":"d"}{"id":"e"}', '{"id":"a"} junk', ' {"id":"b"} \n', '{"id":"c","t":"} not the end {"}', '{"id":"f"}]', '{"id":"g"},', '{"id":"h","p":{"x":[{"y":1}, {"y":2}]}}']
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    got = jsonpath.with_document(df, F.col("m"), ["id"]).select(jsonpath.field("id")).collect()
    assert [r[0] for r in got] == [None, None, "b", "c", None, None, "h"]


def test_one_document_is_what_a_parser_reads_to_the_end(spark):
    rng = random.Random(2)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 4:
            return rng.choice([1, None, True, "", "}", "{", '"},{"', "\\", '\\"', "a,b", "]"])
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return {rng.choice(["id", "x", "}", 'q"']): value(depth - 1) for _ in range(rng.randrange(4))}

    def document():
        return json.dumps({"id": "d", **{f"k{n}": value(rng.choice([1, 3, 7])) for n in range(rng.randrange(3))}}, separators=rng.choice([(",", ":"), (" , ", " : ")]))

    behind = ["", "", "", " ", "\n", "}", "}}", "]", "]}", ",", ",1}", ',"junk"}', ',"k":1}', ',"k":{"b":2}', ",[{}]", ",null,{}", '"', " x", "{", ":{}"]
    texts = [document() + rng.choice([*behind, document(), "," + document(), ", [" + document() + "], " + document()]) for _ in range(1500)]
    texts += ['{"id":"d"},{"id":"e"}', '{"id":"d"}}', '{"id":"d"},"junk"}', '{"s":"{"}}', "[1]{}", "[1]", "{", ""]

    def whole(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, m string")
    parsed = jsonpath.with_document(df, F.col("m"), ["id"]).select("n", jsonpath.field("id").alias("id"))
    got = {r.n: r.id for r in parsed.collect()}
    assert [t for n, t in enumerate(texts) if (got[n] == "d") != whole(t) and t not in ("[1]",)] == []


def test_booleans_are_strict(spark):
    values = ["true", "false", "1", '"t"', '"yes"', '"true"', "null", "[true]"]
    df = spark.createDataFrame([(n, f'{{"p":{{"flag":{v}}},"q":"text"}}') for n, v in enumerate(values)], "n int, m string")
    typed = jsonpath.with_document(df, F.col("m"), ["p.flag", "q"], booleans=["p.flag"])
    assert rows(typed.filter(jsonpath.field_equals("p.flag", True)), "n") == [(0,)]
    assert rows(typed.filter(jsonpath.field_equals("p.flag", False)), "n") == [(1,)]
    assert typed.filter(jsonpath.field_equals("q", "text")).count() == len(values)
