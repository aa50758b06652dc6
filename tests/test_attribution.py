import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clicktrail.functions.temporal import micros
from clicktrail.operators.attribution import (
    final_clicks,
    final_clicks_second_join,
    first_click_per_window,
    interval_attribution,
    min_click,
    trailing_first_click,
)
from helpers import NOON, at, clicks, purchases, rows

MICRO = dt.timedelta(microseconds=1)


def windowed(p, c, lookback="10 minutes", **options):
    return interval_attribution(p, first_click_per_window(c, lookback), lookback, **options)


def both(p, c):
    """Attribution pairs of the windowed and the trailing form."""
    return [rows(f(p, c), "purchase_id", "click_id") for f in (windowed, trailing_first_click)]


@pytest.mark.parametrize(
    "after_click, matches",
    [
        (dt.timedelta(0), True),
        (dt.timedelta(minutes=10), True),
        (dt.timedelta(minutes=10) + MICRO, False),
        (-MICRO, False),
    ],
)
def test_lookback_is_closed_at_both_ends(spark, after_click, matches):
    expected = [("p", "c")] if matches else []
    pairs = both(purchases(spark, ("p", "u", NOON + after_click)), clicks(spark, ("c", "u", NOON)))
    assert pairs == [expected, expected]


def test_other_users_clicks_do_not_count(spark):
    pairs = both(purchases(spark, ("p", "u", at("12:01"))), clicks(spark, ("c", "v", at("12:00"))))
    assert pairs == [[], []]


def test_null_user_or_time_never_matches(spark):
    p = purchases(spark, ("p1", None, at("12:01")), ("p2", "u", None))
    c = clicks(spark, ("c1", None, at("12:00")), ("c2", "u", None))
    assert both(p, c) == [[], []]


def test_click_straddling_a_window_edge(spark):
    c = clicks(spark, ("c1", "u", at("00:09:59")), ("c2", "u", at("00:10:01")))
    p = purchases(spark, ("p", "u", at("00:11")))
    assert rows(windowed(p, c), "purchase_id", "click_id") == [("p", "c1"), ("p", "c2")]
    assert rows(trailing_first_click(p, c), "purchase_id", "click_id") == [("p", "c1")]


def test_trailing_sees_past_a_windows_first_click(spark):
    c = clicks(spark, ("c1", "u", at("00:00:10")), ("c2", "u", at("00:05:00")))
    p = purchases(spark, ("p", "u", at("00:12")))
    assert rows(windowed(p, c), "purchase_id", "click_id") == []
    assert rows(trailing_first_click(p, c), "purchase_id", "click_id") == [("p", "c2")]


def test_clicks_of_one_second(spark):
    c = clicks(spark, ("c2", "u", at("12:00:00.1")), ("c1", "u", at("12:00:00.7")), ("c3", "u", at("12:00:02")))
    assert rows(final_clicks(c), "click_id") == [("c2",)]
    assert rows(final_clicks_second_join(c), "click_id") == [("c1",), ("c2",)]


def test_ties_go_to_the_smaller_click_id(spark):
    c = clicks(spark, ("c2", "u", NOON), ("c1", "u", NOON))
    p = purchases(spark, ("p", "u", at("12:03")))
    assert both(p, c) == [[("p", "c1")]] * 2
    sliced = trailing_first_click(p, c, slice_width="1 second")
    assert rows(sliced, "purchase_id", "click_id") == [("p", "c1")]


def test_min_click_has_one_row_per_user_and_window(spark):
    same_window = [("1", "u", at("12:01")), ("2", "u", at("12:09"))]
    c = clicks(spark, *same_window, ("3", "u", at("12:11")), ("4", "v", at("12:01")))
    assert rows(min_click(c), "min_user_id", "min_click_time") == [
        ("u", at("12:01")),
        ("u", at("12:11")),
        ("v", at("12:01")),
    ]


def test_purchases_at_one_instant_all_keep_their_rows(spark):
    c = clicks(spark, ("c", "u", at("12:00")))
    p = purchases(spark, ("p1", "u", at("12:01")), ("p2", "u", at("12:01")), ("p3", "u", at("12:01")))
    expected = [("p1", "c"), ("p2", "c"), ("p3", "c")]
    for width in ("10 minutes", "30 seconds"):
        assert rows(trailing_first_click(p, c, slice_width=width), "purchase_id", "click_id") == expected


def random_events(seed, seconds, n):
    """Events of three users, one of them in a third or more of the rows, on coarse times."""
    rng = random.Random(seed)

    def one(kind, i):
        user = rng.choice(["hot", "hot", "a", "b"])
        step = rng.choice([1, 30, 60])
        when = NOON + dt.timedelta(seconds=rng.randrange(seconds) // step * step, microseconds=rng.choice([0, 0, 1]))
        return (f"{kind}{i:03d}", user, when)

    return [one("c", i) for i in range(n)], [one("p", i) for i in range(n)]


def brute_trailing(c, p, lookback):
    answer = []
    for purchase, user, when in p:
        reach = [(t, i) for i, u, t in c if u == user and when - lookback <= t <= when]
        if reach:
            answer.append((purchase, min(reach)[1]))
    return sorted(answer)


def brute_windowed(c, p, lookback):
    firsts = {}
    for i, user, t in c:
        key = (user, int((t - dt.datetime(1970, 1, 1)) // lookback))
        firsts[key] = min(firsts.get(key, (t, i)), (t, i))
    return sorted(
        (purchase, i)
        for purchase, user, when in p
        for (u, _), (t, i) in firsts.items()
        if u == user and t <= when <= t + lookback
    )


@pytest.mark.parametrize("seed", range(3))
def test_random_events_against_brute_force(spark, seed):
    c, p = random_events(seed, seconds=5400, n=120)
    lookback, text = dt.timedelta(minutes=10), "10 minutes"
    cdf, pdf = clicks(spark, *c).cache(), purchases(spark, *p).cache()
    expected = brute_trailing(c, p, lookback)
    for options in (
        {},
        {"slice_width": "1 minute"},
        {"slice_width": "7 seconds"},
        {"slice_width": "6 minutes 30 seconds"},
        {"slice_width": "1 hour"},
    ):
        assert rows(trailing_first_click(pdf, cdf, text, **options), "purchase_id", "click_id") == expected
    expected = brute_windowed(c, p, lookback)
    for options in ({}, {"salts": 5}):
        assert rows(windowed(pdf, cdf, text, **options), "purchase_id", "click_id") == expected


@pytest.mark.parametrize("lookback", ["25 minutes", "1 hour 10 minutes"])
def test_lookbacks_longer_than_a_slice(spark, lookback):
    c, p = random_events(7, seconds=40_000, n=150)
    length = dt.timedelta(microseconds=micros(lookback))
    got = trailing_first_click(purchases(spark, *p), clicks(spark, *c), lookback)
    assert rows(got, "purchase_id", "click_id") == brute_trailing(c, p, length)


def test_durations():
    assert micros("1 hour 30 minutes") == 5_400_000_000
    assert micros("0.5 seconds") == 500_000 and micros("2 weeks") == 14 * 86_400_000_000
    for wrong in ("", "5", "1 month"):
        with pytest.raises(ValueError):
            micros(wrong)


def test_attribution_works_on_zoneless_times(spark):
    c = clicks(spark, ("c", "u", NOON)).withColumn("click_time", F.col("click_time").cast("timestamp_ntz"))
    p = purchases(spark, ("p", "u", at("12:10"))).withColumn(
        "purchase_time", F.col("purchase_time").cast("timestamp_ntz")
    )
    assert both(p, c) == [[("p", "c")]] * 2
    assert rows(trailing_first_click(p, c, slice_width="1 second"), "purchase_id") == [("p",)]
