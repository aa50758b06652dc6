"""Attributed checkouts: the operators composed end to end.

Purchases are attributed before they are enriched: all joins are inner, so the
order does not change the result, but the large joins then carry narrow rows
and the dimensions meet attributed purchases only. The windowed plan works on
batch tables and on streams alike; on a stream, clicks and purchases carry
watermarks before they come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clicktrail.operators.attribution import (
    LOOKBACK,
    first_click_per_window,
    interval_attribution,
    trailing_first_click,
)
from clicktrail.operators.enrich import enrich_purchases
from clicktrail.operators.skew import Salts
from clicktrail.schemas import CHECKOUTS


def windowed_checkouts(
    clicks: DataFrame,
    purchases: DataFrame,
    users: DataFrame,
    products: DataFrame,
    lookback: str = LOOKBACK,
    salts: Salts = 1,
) -> DataFrame:
    """Checkouts against the first click of each tumbling window.

    A purchase can match the first clicks of two neighbouring windows and then
    appears twice.
    """
    firsts = first_click_per_window(clicks, lookback)
    return checkouts_of_first_clicks(firsts, purchases, users, products, lookback, salts)


def checkouts_of_first_clicks(
    first_clicks: DataFrame,
    purchases: DataFrame,
    users: DataFrame,
    products: DataFrame,
    lookback: str = LOOKBACK,
    salts: Salts = 1,
) -> DataFrame:
    """Checkouts against first clicks that were picked before."""
    attributed = interval_attribution(purchases, first_clicks, lookback, salts)
    return enrich_purchases(attributed, users, products, salts).select(*CHECKOUTS.columns)


def trailing_checkouts(
    clicks: DataFrame,
    purchases: DataFrame,
    users: DataFrame,
    products: DataFrame,
    lookback: str = LOOKBACK,
) -> DataFrame:
    """Checkouts against the one earliest click in the lookback before each purchase."""
    attributed = trailing_first_click(purchases, clicks, lookback)
    return enrich_purchases(attributed, users, products).select(*CHECKOUTS.columns)
