"""First-click attribution.

Two questions are answered here:

* *windowed*: the first click of each user in each tumbling window, joined to
  the purchases that follow within the lookback (``first_click_per_window`` and
  ``interval_attribution``);
* *trailing*: for every purchase the one earliest click in the lookback just
  before it (``trailing_first_click``).

Clicks are totally ordered by ``(click_time, click_id)``, so each first click
is one well-defined row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.functions.temporal import bucket_start, interval, micros
from clicktrail.operators.skew import Salts, copied, salted, tasks_of
from clicktrail.schemas import CLICK_COLUMNS, CLICK_PAYLOAD

LOOKBACK = "10 minutes"


def min_click(clicks: DataFrame, window: str = LOOKBACK) -> DataFrame:
    """Earliest click time per user and tumbling window."""
    return (
        clicks.groupBy(F.col("user_id").alias("min_user_id"), F.window("click_time", window))
        .agg(F.min("click_time").alias("min_click_time"))
        .drop("window")
    )


def first_click_per_window(clicks: DataFrame, window: str = LOOKBACK) -> DataFrame:
    """The whole first click of each user and tumbling window.

    One aggregate with map-side combine: a hot user costs one row per window
    and map task, and no join back to the clicks is needed. On a stream the
    row appears once, when the watermark closes the window. ``closes_at`` is
    the last instant of that window and the event time of a streamed result;
    adding a zero interval keeps ``click_time`` from being marked as a second
    event time.
    """
    first = F.col("first")
    return (
        clicks.groupBy("user_id", F.window("click_time", window))
        .agg(F.min(_click_struct()).alias("first"))
        .select(
            "user_id",
            F.window_time("window").alias("closes_at"),
            (first["click_time"] + interval("0 seconds")).alias("click_time"),
            *[first[name].alias(name) for name in CLICK_PAYLOAD if name != "click_time"],
        )
    )


def final_clicks(clicks: DataFrame, window: str = LOOKBACK) -> DataFrame:
    """First clicks in the layout of the clicks themselves."""
    return first_click_per_window(clicks, window).select(*CLICK_COLUMNS)


def final_clicks_second_join(clicks: DataFrame, window: str = LOOKBACK) -> DataFrame:
    """First clicks recovered by joining on user and whole second.

    Clicks of one user that share the second of the minimum all come back,
    which is the difference from :func:`final_clicks`. The minima are unique
    per user and second for windows of a second or more, so the join never
    multiplies clicks.
    """
    minima = min_click(clicks, window).select(
        F.col("min_user_id").alias("user_id"),
        F.date_trunc("second", "min_click_time").alias("_second"),
    )
    return (
        clicks.withColumn("_second", F.date_trunc("second", "click_time"))
        .join(minima, ["user_id", "_second"])
        .select(*CLICK_COLUMNS)
    )


def interval_attribution(
    purchases: DataFrame, first_clicks: DataFrame, lookback: str = LOOKBACK, salts: Salts = 1
) -> DataFrame:
    """Purchases joined to first clicks with click <= purchase <= click + lookback.

    ``first_clicks`` holds at most one row per user and tumbling window of the
    lookback length. A click can only serve purchases of its own bucket and
    the next, so each click is listed under those two and the join is an
    equi-join on (user, bucket) with the range as a residual: a user's history
    is cut into buckets, a purchase meets at most two candidates, and batch
    skew handling can split a hot bucket's purchases. Micro-batches have no
    skew handling, so streams may spread the purchases of hot users (or of all)
    over the tasks that ``salts`` names and repeat their few first clicks once
    per task; other users' clicks are not copied.

    The event time of streamed :func:`first_click_per_window` rows is
    ``closes_at``. The range on it follows from the range on ``click_time``
    and never changes the result; a stream needs it to bound the join state.
    """
    length = interval(lookback)
    start = bucket_start("click_time", lookback)
    bought = F.col("purchase_time")
    windowed = "closes_at" in first_clicks.columns
    candidates = first_clicks.select(
        F.col("user_id").alias("_user"),
        F.explode(F.array(start, start + length)).alias("_reach"),
        *(["closes_at"] if windowed else []),
        *CLICK_PAYLOAD,
    )
    keyed = purchases.withColumn("_bucket", bucket_start("purchase_time", lookback))
    condition = (
        (F.col("user_id") == F.col("_user"))
        & (F.col("_bucket") == F.col("_reach"))
        & bought.between(F.col("click_time"), F.col("click_time") + length)
    )
    if windowed:
        condition = condition & bought.between(F.col("closes_at") - length, F.col("closes_at") + length)
    tasks = tasks_of(salts, "user_id")
    if tasks is not None:
        candidates = copied(candidates, tasks_of(salts, "user_id", "_user"), "_copy")
        keyed = salted(keyed, tasks, "purchase_id")
        condition = condition & (F.col("_salt") == F.col("_copy"))
    return keyed.join(candidates, condition).select(*purchases.columns, *CLICK_PAYLOAD)


def trailing_first_click(
    purchases: DataFrame,
    clicks: DataFrame,
    lookback: str = LOOKBACK,
    slice_width: str = "10 minutes",
) -> DataFrame:
    """Every purchase with the earliest click in the lookback before it.

    The earliest click in ``[t - lookback, t]`` is the next click at or after
    ``t - lookback``, if it is not later than ``t``. That turns the range
    question into a running scan over narrow rows: purchases contribute the
    instant ``t - lookback``, clicks their own time, and reading each user
    backwards in time the last click seen is the answer. The purchases
    themselves only meet the result in a final equi-join on user and time,
    many-to-one, where Spark may broadcast or split skewed keys.

    Every user is read in time slices of ``slice_width`` (of the lookback, if
    that is shorter), so one user's rows are spread over as many tasks as they
    have slices. What a slice cannot answer is the first click of a later one,
    at most one lookback on: it is carried over one row per slice, within
    groups of as many slices as make up a lookback. A group also lists the
    slices of the next one, and none further is needed. So a carry holds at
    most two lookbacks of slices of one user, whatever time the data spans.
    Clicks and purchases are read, shuffled and sorted once for all of this.
    """
    width = min(micros(slice_width), micros(lookback))
    slices = -(-micros(lookback) // width)
    length = interval(lookback)
    points = (
        _scan_points(purchases, clicks, length)
        .withColumn("_slice", bucket_start("_at", f"{width} microseconds"))
        .where("_slice IS NOT NULL")  # as the join on it would ask of one of the two uses only
        .repartition("user_id", "_slice")
    )
    carried = _carry(points, f"{width * slices} microseconds")
    resolved = (
        _scan_backwards(points)
        .join(carried, ["user_id", "_slice"], "left")
        .select(
            "user_id",
            (F.col("_at") + length).alias("purchase_time"),
            F.coalesce("_within", "_carry").alias("_click"),
        )
    )
    attributed = resolved.select(
        "user_id", "purchase_time", *[F.col(f"_click.{name}").alias(name) for name in CLICK_PAYLOAD]
    ).where(F.col("click_time") <= F.col("purchase_time"))
    return purchases.join(attributed, ["user_id", "purchase_time"]).select(
        *purchases.columns, *CLICK_PAYLOAD
    )


def _click_struct() -> Column:
    """A click as one value whose order is (click_time, click_id)."""
    rest = [name for name in CLICK_PAYLOAD if name not in ("click_time", "click_id")]
    return F.struct("click_time", "click_id", *rest)


def _scan_points(purchases: DataFrame, clicks: DataFrame, length: Column) -> DataFrame:
    """Clicks, and the old end of every purchase's lookback, as (user, instant) rows."""
    seen = clicks.where("user_id IS NOT NULL AND click_time IS NOT NULL").select(
        "user_id",
        F.col("click_time").alias("_at"),
        _click_struct().alias("_click"),
        F.lit(False).alias("_asked"),
    )
    asked = purchases.where("user_id IS NOT NULL AND purchase_time IS NOT NULL").select(
        "user_id",
        (F.col("purchase_time") - length).alias("_at"),
        F.lit(None).cast(seen.schema["_click"].dataType).alias("_click"),
        F.lit(True).alias("_asked"),
    )
    return seen.unionByName(asked)


def _scan_backwards(points: DataFrame) -> DataFrame:
    """Asked instants, once per user, with the first click at or after them in their slice.

    Clicks sort before questions of the same instant because both ends of the
    lookback count, and the smallest click of an instant comes last.
    """
    order = Window.partitionBy("user_id", "_slice").orderBy(
        F.desc("_at"), F.asc("_asked"), F.desc("_click")
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    repeated = (F.lag("_at").over(order) == F.col("_at")) & F.lag("_asked").over(order)
    return (
        points.withColumns(
            {
                "_within": F.last("_click", ignorenulls=True).over(so_far),
                "_repeated": F.coalesce(repeated, F.lit(False)),
            }
        )
        .where("_asked AND NOT _repeated")
        .select("user_id", "_slice", "_at", "_within")
    )


def _carry(points: DataFrame, group_width: str) -> DataFrame:
    """For slices with questions, the first click of the nearest later slice that has one.

    ``group_width`` is a whole number of slices and at least a lookback. A
    slice with clicks is listed in its own group and in the one before.
    """
    slices = (
        points.groupBy("user_id", "_slice")
        .agg(
            F.min("_click").alias("_head"),
            F.max("_asked").alias("_asked"),
            F.max("_at").alias("_newest"),
        )
        # always true; it keeps this branch on the columns of the scan, so that both share one shuffle
        .where("_newest IS NOT NULL")
        .withColumn("_own", bucket_start("_slice", group_width))
    )
    before = F.col("_own") - interval(group_width)
    listed = F.when(F.col("_head").isNotNull(), F.array(F.col("_own"), before)).otherwise(F.array("_own"))
    later = (
        Window.partitionBy("user_id", "_group")
        .orderBy(F.desc("_slice"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        slices.withColumn("_group", F.explode(listed))
        .withColumn("_carry", F.last("_head", ignorenulls=True).over(later))
        .where("_asked AND _group = _own AND _carry IS NOT NULL")
        .select("user_id", "_slice", "_carry")
    )
