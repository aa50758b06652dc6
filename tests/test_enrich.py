from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clicktrail.operators.enrich import _is_small, enrich_purchases, of_micro_batches, row_bytes
from clicktrail.session import work_dir
from helpers import NOON, products, purchases, rows, users


def test_total_and_profit_are_recomputed(spark):
    row = enrich_purchases(purchases(spark, ("1", "u", NOON)), users(spark, "u"), products(spark, "p1")).first()
    assert row.total_cost == Decimal("23")  # 10 x 2 x 0.9 + 5
    assert row.profit == Decimal("0.9")  # (23 - 5) x 0.05
    assert not {"price", "discount", "shipping_cost", "commission_rate"} & set(row.asDict())


def test_unknown_user_or_product_is_dropped(spark):
    p = purchases(spark, ("1", "u", NOON), ("2", "nobody", NOON))
    assert rows(enrich_purchases(p, users(spark, "u"), products(spark, "p1")), "purchase_id") == [("1",)]
    assert rows(enrich_purchases(p, users(spark, "u"), products(spark, "p2"))) == []


def test_failed_payments_are_kept(spark):
    p = purchases(spark, ("1", "u", NOON), payment_status="failure", description="Card Expired")
    assert rows(enrich_purchases(p, users(spark, "u"), products(spark, "p1")), "description") == [("Card Expired",)]


def test_salted_join_gives_the_same_rows(spark):
    p = purchases(spark, *[(str(i), "u" if i % 3 else "v", NOON) for i in range(30)])
    plain = enrich_purchases(p, users(spark, "u", "v"), products(spark, "p1", "p2"))
    salted = enrich_purchases(p, users(spark, "u", "v"), products(spark, "p1", "p2"), salts=4)
    assert rows(plain) == rows(salted)
    assert plain.columns == salted.columns


def test_fractional_quantity_and_null_input(spark):
    p = purchases(spark, ("1", "u", NOON), quantity=Decimal("1.5"))
    assert enrich_purchases(p, users(spark, "u"), products(spark, "p1")).first().total_cost == Decimal("18.5")
    p = purchases(spark, ("1", "u", NOON), quantity=None)
    row = enrich_purchases(p, users(spark, "u"), products(spark, "p1")).first()
    assert row.total_cost is None and row.profit is None


def test_absurd_values_give_null_not_an_error(spark):
    p = purchases(spark, ("1", "u", NOON), quantity=Decimal("999999999"))
    costly = products(spark, "p1").withColumn("price", F.lit("9999999999.0000").cast("decimal(14,4)"))
    row = enrich_purchases(p, users(spark, "u"), costly).first()
    assert row.purchase_id == "1" and row.total_cost is None


@pytest.fixture
def little_broadcast(spark):
    """A broadcast threshold of 100,000 bytes."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    yield
    spark.conf.set(key, before)


def stored_names(spark, n):
    path = work_dir(spark, "names")
    spark.range(n).select(F.col("id").cast("string").alias("user_id"), F.lit("x" * 200).alias("name")).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_a_dimension_is_small_by_its_rows_not_by_its_compressed_files(spark, little_broadcast):
    large, small = stored_names(spark, 2000), stored_names(spark, 20)
    assert int(str(large._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100_000 < row_bytes(large)
    assert _is_small(small) and not _is_small(large)
    facts = large.select("user_id")
    plans = [facts.join(of_micro_batches(d), "user_id")._jdf.queryExecution().toString() for d in (large, small)]
    assert ["strategy=merge" in p for p in plans] == [True, False]
    assert ["strategy=broadcast" in p for p in plans] == [False, True]


def test_row_bytes_count_nulls_and_no_rows(spark):
    assert row_bytes(spark.createDataFrame([], "a string, b int")) == 0
    assert row_bytes(spark.createDataFrame([(None, None), ("xyz", 12)], "a string, b int")) == 2 * 16 + 5
