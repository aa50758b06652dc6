"""Topic payloads: JSON text to typed columns and back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.schemas import CLICK_WIRE, CLICKS, MONEY, PURCHASE_WIRE, PURCHASES, RATE, UNITS

#: Microseconds survive the trip; the default pattern stops at milliseconds.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def topic_values(events: DataFrame, topic: str) -> DataFrame:
    """Payload text of one topic out of a (possibly multi-topic) scan."""
    return events.where(F.col("topic") == topic).select(F.col("value").cast("string").alias("value"))


def parse_topic(events: DataFrame, topic: str, fields: Sequence[str]) -> DataFrame:
    """Columns of one topic, all strings, named in lower case.

    Field names match the payload case-sensitively. A payload that is not a
    JSON object gives a row of NULLs, which the inner joins and windows drop.
    """
    payload = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    parsed = topic_values(events, topic).select(F.from_json("value", payload).alias("payload"))
    return parsed.select([F.col(f"payload.`{name}`").alias(name.lower()) for name in fields])


#: Columns of checked rows beside the typed ones: the payload, and why it is rejected (empty if it is not).
PAYLOAD, REASONS = "value", "reasons"


def check_topic(
    events: DataFrame, topic: str, fields: Sequence[str], schema: T.StructType, required: Sequence[str]
) -> DataFrame:
    """Typed columns of a topic, the payload, and the reasons for which it should be rejected, out of one parse.

    A payload is rejected that is no JSON object, that lacks a required column
    (named in lower case) or has a field that does not fit its type. Optional
    fields that are absent are NULL. Names are those of the payload.
    """
    corrupt = "_corrupt"
    payload = T.StructType([T.StructField(name, T.StringType()) for name in (*fields, corrupt)])
    parsed = F.from_json(PAYLOAD, payload, {"columnNameOfCorruptRecord": corrupt})
    rows = topic_values(events, topic).select(PAYLOAD, parsed.alias("p"))
    types = {field.name: field.dataType for field in schema}
    whole = F.col(PAYLOAD).isNotNull() & F.col(PAYLOAD).rlike(r"^\s*\{") & F.col(f"p.`{corrupt}`").isNull()
    typed, reasons = [], [F.when(~whole, F.lit("no JSON object"))]
    for name in fields:
        column, text = name.lower(), F.col(f"p.`{name}`")
        value = text.try_cast(types[column])
        typed.append(value.alias(column))
        if column in required:
            reasons.append(F.when(whole & text.isNull(), F.lit(f"{name} is missing")))
        reasons.append(F.when(whole & text.isNotNull() & value.isNull(), F.lit(f"{name} is no {types[column].simpleString()}")))
    return rows.select(*typed, PAYLOAD, F.array_compact(F.array(*reasons)).alias(REASONS))


def check_clicks(events: DataFrame, topic: str = "clicks", time_type: T.DataType | None = None) -> DataFrame:
    """Clicks with their payload and reasons; a click needs its id, user and time."""
    schema = T.StructType([T.StructField(f.name, time_type if time_type and f.name == "click_time" else f.dataType) for f in CLICKS.schema])
    return check_topic(events, topic, CLICK_WIRE, schema, ("click_id", "user_id", "click_time"))


def check_purchases(events: DataFrame, topic: str = "purchases") -> DataFrame:
    """Purchases with their payload and reasons; a purchase needs its id, user, product and time."""
    required = ("purchase_id", "user_id", "product_id", "purchase_time")
    return check_topic(events, topic, PURCHASE_WIRE, PURCHASES.schema, required)


def accepted(checked: DataFrame) -> DataFrame:
    """The typed rows of checked ones that have no reason against them."""
    return checked.where(F.size(REASONS) == 0).drop(PAYLOAD, REASONS)


def rejected(checked: DataFrame) -> DataFrame:
    """Payload and reasons of the others."""
    return checked.where(F.size(REASONS) > 0).select(PAYLOAD, REASONS)


def cast_columns(df: DataFrame, dtype: T.DataType | str, columns: Iterable[str]) -> DataFrame:
    """Cast the listed columns in one projection; values that do not fit become NULL."""
    return df.withColumns({name: F.col(name).try_cast(dtype) for name in columns})


def encode_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in a single ``value`` column."""
    return df.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def decode_clicks(
    events: DataFrame,
    topic: str = "clicks",
    fields: Sequence[str] = CLICK_WIRE,
    time_type: T.DataType | str = "timestamp",
) -> DataFrame:
    """Typed clicks of a topic scan."""
    return cast_columns(parse_topic(events, topic, fields), time_type, ["click_time"])


def decode_purchases(
    events: DataFrame,
    topic: str = "purchases",
    fields: Sequence[str] = PURCHASE_WIRE,
    time_type: T.DataType | str = "timestamp",
) -> DataFrame:
    """Typed purchases of a topic scan; money and rates are exact decimals."""
    purchases = parse_topic(events, topic, fields)
    purchases = cast_columns(purchases, MONEY, ["shipping_cost", "total_cost"])
    purchases = cast_columns(purchases, RATE, ["discount"])
    purchases = cast_columns(purchases, UNITS, ["quantity"])
    return cast_columns(purchases, time_type, ["purchase_time"])


def decode_rows(events: DataFrame, topic: str, schema: T.StructType) -> DataFrame:
    """Rows of a topic the engine itself published, typed by a table contract."""
    rows = parse_topic(events, topic, schema.fieldNames())
    return rows.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])
