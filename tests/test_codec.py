import datetime as dt
from decimal import Decimal

from clicktrail.functions.codec import (
    cast_columns,
    decode_clicks,
    decode_purchases,
    encode_rows,
    parse_topic,
    topic_values,
)
from clicktrail.schemas import CLICK_WIRE
from helpers import rows


def events(spark, *messages):
    return spark.createDataFrame(list(messages), "topic STRING, value STRING")


def test_topics_are_separated(spark):
    df = events(spark, ("clicks", "a"), ("purchases", "b"), ("clicks", "c"))
    assert rows(topic_values(df, "clicks")) == [("a",), ("c",)]


def test_binary_payload_becomes_text(spark):
    df = spark.createDataFrame([("clicks", bytearray(b"hello"))], "topic STRING, value BINARY")
    assert rows(topic_values(df, "clicks")) == [("hello",)]


def test_fields_match_case_and_columns_are_lower_case(spark):
    df = events(spark, ("clicks", '{"Click_ID":"1","user_id":"9","IP":"x"}'))
    parsed = parse_topic(df, "clicks", CLICK_WIRE)
    assert parsed.columns == ["click_id", "user_id", "click_time", "click_at", "source", "ip"]
    assert rows(parsed, *parsed.columns) == [("1", None, None, None, None, "x")]


def test_malformed_payload_is_a_row_of_nulls(spark):
    df = events(spark, ("clicks", "{broken"))
    assert rows(decode_clicks(df)) == [(None,) * 6]


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("1.5", "x"), ("oops", "y")], "a STRING, b STRING")
    assert rows(cast_columns(df, "double", ["a"]), "a", "b") == [(1.5, "x"), (None, "y")]


def test_times_without_seconds_and_with_nanoseconds(spark):
    df = events(
        spark,
        ("clicks", '{"Click_ID":"1","Click_time":"2024-01-01T10:20"}'),
        ("clicks", '{"Click_ID":"2","Click_time":"2024-01-01T10:20:30.123456789"}'),
    )
    assert rows(decode_clicks(df), "click_id", "click_time") == [
        ("1", dt.datetime(2024, 1, 1, 10, 20)),
        ("2", dt.datetime(2024, 1, 1, 10, 20, 30, 123456)),
    ]


def test_purchase_money_is_exact(spark):
    value = '{"Purchase_ID":"1","Discount":"0.15000000000000002","Shipping_cost":"2.18","Quantity":"3"}'
    row = decode_purchases(events(spark, ("purchases", value))).first()
    assert (row.discount, row.shipping_cost, row.quantity) == (
        Decimal("0.1500"),
        Decimal("2.1800"),
        Decimal("3.0000"),
    )


def test_encoding_keeps_microseconds(spark):
    data = [("1", dt.datetime(2024, 1, 1, 0, 0, 0, 123456))]
    df = spark.createDataFrame(data, "click_id STRING, click_time TIMESTAMP")
    encoded = encode_rows(df)
    assert encoded.columns == ["value"]
    assert '"2024-01-01T00:00:00.123456"' in encoded.first().value
