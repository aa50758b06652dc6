"""Hard negatives against brute force; the curve and the bounds against what they promise."""

import itertools
import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktrail.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, row long, low long, strip string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, "clash") for r in rows], SCHEMA).repartition(3)


def mined(spark, rows, **options):
    out = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, **options)
    return Counter(tuple(r) for r in out.collect())


def vectors():
    rng = random.Random(6)
    rows = [(n, [rng.gauss(0, 1) + (n % 4) for _ in range(6)], n % 4) for n in range(500)]
    rows += [(n, [0.5] * 6, 1) for n in range(500, 560)] + [(600 + n, [0.5] * 6, 2) for n in range(40)]
    rows += [(700, [1.0] * 6, 2), (700, [1.0] * 6, 2), (None, [0.9] * 6, 2), (None, [0.9] * 6, 1), (-100, [0.25] * 6, 7)]
    rows += [(800, None, 1), (801, [], 1), (802, [None] * 6, 1), (803, [float("nan")] * 6, 1), (900, [float("-inf")] * 6, 1), (1000, [1.0] * 6, None)]
    rows += [(1100, [0.1] * 3, 1), (1101, [0.2] * 3, 1), (1102, [0.3] * 3, 0), (1200, [0.7] * 5, 1), (1300, [-1.0] * 4, 3), (1301, [1.0] * 4, 3)]
    rows += [(1302, [1.0] * 4, 2), (1400, [0.0] * 2, 3), (1401, [1.0] * 2, 3), (1402, [-1.0, 1.0], 1), (1500, [3.0e4] * 6, 2), (1501, [-3.0e4] * 6, 1)]
    return rows


@pytest.mark.parametrize("layout", [hn.Layout(), hn.Layout(block=7, strip=3, pack=2, boxes=4), hn.Layout(1, 1, 1, 1000)])
def test_mining_equals_brute_force(spark, layout):
    rows = vectors() if layout.block > 1 else vectors()[::5]
    assert mined(spark, rows, layout=layout) == Counter(brute.hard_negatives(rows))


def test_numbers_and_shares_are_parameters(spark):
    rows = vectors()
    got = mined(spark, rows, positives=2, negatives=3, least_share=95, layout=hn.Layout(block=16, strip=2))
    assert got == Counter(brute.hard_negatives(rows, 2, 3, 95))


def test_products_beyond_doubles_are_told_apart(spark):
    big = 2.0**22
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big, 0.5], 2), (3, [big, 0.75], 2), (4, [big - 2.0**10, 0.0], 2), (5, [1.0, 1.0], 2)]
    assert mined(spark, rows, layout=hn.Layout(block=2, strip=1)) == Counter(brute.hard_negatives(rows))


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == mined(spark, [(0, [1.0], 1)]) == Counter()


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hn.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-50, 50, (6, 9, 5)), rng.integers(-50, 50, (7, 9, 5))
    products = np.einsum("ixd,jyd->ijxy", a, b)
    least, most = hn.box_bounds(a.min(1).astype(float), a.max(1).astype(float), b.min(1).astype(float), b.max(1).astype(float))
    assert (least[:, :, None, None] <= products).all() and (products <= most[:, :, None, None]).all()
    least, most = hn.point_bounds(a[:, 0].astype(float), b.min(1).astype(float), b.max(1).astype(float))
    assert (least[:, :, None] <= products[:, :, 0]).all() and (products[:, :, 0] <= most[:, :, None]).all()


def test_boxes_leave_strips_unread(spark):
    """Clusters far apart: the packs of one need few strips of the others."""
    rng = random.Random(1)
    centre = lambda c: [5.0 * (c == d) for d in range(6)]
    rows = [(n, [x + rng.gauss(0, 0.05) for x in centre(n % 6)], n % 2) for n in range(1_200)]
    layout = hn.Layout(block=25, strip=1)
    numbered = hn.stored(hn.labelled_vectors(frame(spark, rows), F.col("vec_id") % 100 == 0, "vec_id", "embedding", "label", 256), "t")
    blocks = hn.hilbert_blocks(numbered, layout)
    zones = hn.in_arrow(blocks.select("strip", "dim", "label", "lo", "hi"), hn._zones, hn.ZONES)
    packs = hn.stored(hn.in_arrow(blocks.drop("block", "lo", "hi"), hn._packs_of(layout), hn.PACKS), "t")
    windows = packs.select("pack", F.lit(256 * 256 * 20).alias("low"), F.lit(hn.HIGHEST).alias("high"))
    pairs = hn.chosen_strips(zones, packs, windows, layout.boxes, same=True).count()
    assert 0 < pairs <= 0.5 * packs.count() * zones.count()
    assert mined(spark, rows, layout=layout) == Counter(brute.hard_negatives(rows))
