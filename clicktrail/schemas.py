"""Entity schemas and result-table contracts.

On the wire every field is a string; the ``*_WIRE`` tuples are the payload
field names exactly as producers spell them (matching is case-sensitive).
The ``StructType`` contracts give the column order, types and key of every
table the engine writes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Payload field names of the two producer topics.
CLICK_WIRE = ("Click_ID", "User_ID", "Click_time", "Click_at", "Source", "IP")
PURCHASE_WIRE = (
    "Purchase_ID",
    "User_ID",
    "Product_ID",
    "Shipping_cost",
    "Discount",
    "Total_cost",
    "Payment_method",
    "Quantity",
    "Payment_status",
    "Description",
    "Purchase_time",
)

# Topics published by the engine itself carry lower-case field names.
CLICK_COLUMNS = tuple(name.lower() for name in CLICK_WIRE)
PURCHASE_COLUMNS = tuple(name.lower() for name in PURCHASE_WIRE)

#: Click columns that survive attribution (the user key comes from the purchase).
CLICK_PAYLOAD = tuple(name for name in CLICK_COLUMNS if name != "user_id")

# Exact arithmetic widths: price * quantity * (1 - discount) + shipping needs
# 36 digits at scale 12, and the profit product of an ORDER_TOTAL needs 31.
MONEY = T.DecimalType(14, 4)
RATE = T.DecimalType(5, 4)
UNITS = T.DecimalType(13, 4)
ORDER_TOTAL = T.DecimalType(24, 8)
#: Stored sums of money.
AMOUNT = T.DecimalType(38, 12)


@dataclass(frozen=True)
class TableContract:
    """Column order and types of a table plus the columns that identify a row.

    Where a key may come more than once, ``first_by`` says which row a stored
    table keeps: the first in that order. ``settled`` says that a query sends
    each key once, so that only other queries can have stored it before.
    """

    schema: T.StructType
    key: tuple[str, ...]
    event_time: str | None = None
    first_by: tuple[str, ...] = ()
    settled: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def zoneless(self) -> TableContract:
        """The same table with zone-less timestamps, as batch tables often have them."""
        return replace(self, schema=_retyped(self.schema, {T.TimestampType(): T.TimestampNTZType()}))


def _retyped(schema: T.StructType, types: dict[T.DataType, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(f.name, types.get(f.dataType, f.dataType)) for f in schema])


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _TS, _D, _F = T.StringType(), T.TimestampType(), T.DateType(), T.DoubleType()

# Names, order, types and keys of the tables, which other programs read.

USERS = TableContract(
    _struct(
        user_id=_S,
        name=_S,
        email=_S,
        gender=_S,
        birth_day=_D,
        location=_S,
        phone=_S,
        registration_date=_D,
    ),
    key=("user_id",),
)

PRODUCTS = TableContract(
    _struct(
        product_id=_S,
        product_name=_S,
        category=_S,
        brand=_S,
        price=MONEY,
        commission_rate=RATE,
    ),
    key=("product_id",),
)

CLICKS = TableContract(
    _struct(click_id=_S, user_id=_S, click_time=_TS, click_at=_S, source=_S, ip=_S),
    key=("click_id",),
    event_time="click_time",
)

PURCHASES = TableContract(
    _struct(
        purchase_id=_S,
        user_id=_S,
        product_id=_S,
        shipping_cost=MONEY,
        discount=RATE,
        total_cost=MONEY,
        payment_method=_S,
        quantity=UNITS,
        payment_status=_S,
        description=_S,
        purchase_time=_TS,
    ),
    key=("purchase_id",),
    event_time="purchase_time",
)

CHECKOUTS = TableContract(
    _struct(
        product_id=_S,
        user_id=_S,
        purchase_id=_S,
        total_cost=_F,
        payment_method=_S,
        quantity=_F,
        payment_status=_S,
        description=_S,
        purchase_time=_TS,
        name=_S,
        email=_S,
        gender=_S,
        birth_day=_D,
        location=_S,
        phone=_S,
        registration_date=_D,
        product_name=_S,
        category=_S,
        brand=_S,
        profit=_F,
        click_id=_S,
        click_time=_TS,
        click_at=_S,
        source=_S,
        ip=_S,
    ),
    key=("purchase_id",),
    event_time="purchase_time",
    first_by=("click_time", "click_id"),
)

#: Checkouts on their topic: money and quantity stay exact until a table stores them.
CHECKOUT_MESSAGE = T.StructType(
    [
        T.StructField(f.name, T.DecimalType(31, 12) if isinstance(f.dataType, T.DoubleType) else f.dataType)
        for f in CHECKOUTS.schema
    ]
)


#: Earliest click times on their topic.
MIN_CLICK_MESSAGE = _struct(min_user_id=_S, min_click_time=_TS)


def _count_contract(dimension: str) -> TableContract:
    fields = {dimension: _S, "count": T.LongType(), "time": _TS}
    return TableContract(_struct(**fields), key=("time", dimension), event_time="time")


REVENUE = TableContract(
    _struct(revenue=AMOUNT, profit=AMOUNT, quantity=T.LongType(), time=_TS),
    key=("time",),
    event_time="time",
)

#: The cube that all roll-ups are taken from.
CUBE = TableContract(
    _struct(
        payment_status=_S,
        source=_S,
        description=_S,
        category=_S,
        gender=_S,
        count=T.LongType(),
        revenue=AMOUNT,
        profit=AMOUNT,
        quantity=AMOUNT,
        time=_TS,
    ),
    key=("payment_status", "source", "description", "category", "gender", "time"),
    event_time="time",
)

#: The five roll-up tables.
ROLLUPS: dict[str, TableContract] = {
    "source_count": _count_contract("source"),
    "fail_count": _count_contract("description"),
    "category_count": _count_contract("category"),
    "gender_count": _count_contract("gender"),
    "revenue": REVENUE,
}
