"""Rejects, late rows and incremental roll-ups: replays, days read, odd payloads."""

import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import functions as F

from clicktrail.functions.codec import accepted, check_clicks, rejected
from clicktrail.operators.rollups import rollup
from clicktrail.schemas import CHECKOUTS, CLICKS, ROLLUPS
from clicktrail.session import work_dir
from clicktrail.sinks.incremental import refresh_cube, touched_rows
from clicktrail.sinks.tables import write_batch
from clicktrail.sources.tables import read_rows
from clicktrail.streaming.pipeline import provisional_rollup
from clicktrail.streaming.side_outputs import read_rejects, side_output_writer
from helpers import NOON, rows

MINUTE, DAY = dt.timedelta(minutes=1), dt.timedelta(days=1)


def click(i, when, **changes):
    fields = {"Click_ID": f"c{i}", "User_ID": "u", "Click_time": when.isoformat(), "Click_at": "Product", "Source": "Google", "IP": "10.0.0.1"}
    return json.dumps({k: v for k, v in (fields | changes).items() if v != "absent"})


def messages(spark, *values):
    return spark.createDataFrame([("clicks", v) for v in values], "topic string, value string")


def test_faults_have_reasons(spark):
    good = [click(1, NOON), click(2, NOON, Source=None, IP="absent", extra="x")]
    bad = {
        None: "no JSON object", "": "no JSON object", "[1]": "no JSON object", "7": "no JSON object", "null": "no JSON object",
        click(3, NOON)[:30]: "no JSON object", "{}": "Click_ID is missing; User_ID is missing; Click_time is missing",
        click(4, NOON, Click_time="soon", User_ID=None): "User_ID is missing; Click_time is no timestamp",
        click(5, NOON, Click_ID="absent"): "Click_ID is missing",
    }
    checked = check_clicks(messages(spark, *good, *bad))
    assert rows(accepted(checked), "click_id", "source") == [("c1", "Google"), ("c2", None)]
    found = {r.value: "; ".join(r.reasons) for r in rejected(checked).collect()}
    assert found == bad


def test_a_replayed_batch_replaces_its_side_outputs(spark):
    root = work_dir(spark, "side")
    write = side_output_writer(spark, root, "clicks", CLICKS, "10 minutes")
    parts = [
        [click(1, NOON), "broken"],
        [click(2, NOON + 30 * MINUTE), click(3, NOON - 9 * MINUTE), click(4, NOON - 11 * MINUTE)],
        [],
        [click(5, NOON + 20 * MINUTE), click(6, NOON + 19 * MINUTE)],
    ]
    for n in (0, 1, 1, 2, 3, 3):
        write(check_clicks(messages(spark, *parts[n])), n)
    assert rows(read_rows(spark, f"{root}/clicks", CLICKS), "click_id") == [("c1",), ("c2",), ("c3",), ("c5",)]
    assert rows(read_rows(spark, f"{root}/clicks_late", CLICKS), "click_id") == [("c4",), ("c6",)]
    assert rows(read_rejects(spark, root, "clicks"), "value") == [("broken",)]


def checkout(spark, *data):
    """Checkouts of (purchase_id, purchase_time, source)."""
    nulls = dict.fromkeys(CHECKOUTS.columns)
    full = [tuple((nulls | {"purchase_id": p, "purchase_time": t, "source": s, "payment_status": "success", "quantity": 1.0}).values()) for p, t, s in data]
    return spark.createDataFrame(full, CHECKOUTS.schema)


def test_refreshes_equal_one_run_and_read_touched_days_only(spark):
    path, root = work_dir(spark, "checkouts"), work_dir(spark, "cube")
    table = replace(CHECKOUTS, first_by=())
    parts = [
        [("p1", NOON, "a"), ("p2", NOON + DAY, "a"), ("p3", NOON + 2 * DAY, "b")],
        [("p4", NOON + dt.timedelta(seconds=20), "a"), ("p5", NOON + 5 * MINUTE, "b")],
        [("p6", NOON + 2 * DAY, "b"), ("p7", dt.datetime(2024, 1, 3, 23, 59, 59), "a")],
    ]
    for n, part in enumerate(parts):
        write_batch(checkout(spark, *part), path, table, n)
        new = refresh_cube(spark, path, table, root)
        assert new and refresh_cube(spark, path, table, root) == []
        so_far = read_rows(spark, path, CHECKOUTS)
        got = provisional_rollup(spark, f"{root}/cube", "source_count")
        assert rows(got) == rows(rollup(so_far, "source_count"))
        days = {name.split("/")[0] for name in new}
        read = touched_rows(spark, path, table, new, "1 minute").inputFiles()
        assert {f.split("/date=")[1][:10] for f in read} == {d.removeprefix("date=") for d in days}
    assert provisional_rollup(spark, f"{root}/cube", "source_count").count() == 5
    assert set(provisional_rollup(spark, f"{root}/cube", "revenue").columns) == set(ROLLUPS["revenue"].columns)
    assert spark.read.text(f"{root}/seen").where(F.col("value").startswith("date=")).count() == 5
