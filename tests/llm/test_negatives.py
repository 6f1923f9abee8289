"""Hard negatives against scoring every pair with Python's integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import hard_negatives
from tallyfield.llm.hard_negatives import planes_of, scores, subset_sums, values_of

SCHEMA = "vec_id long, embedding array<double>, label int, row int, rank string, score double, bands int"


def plain(rows):
    used = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [min(max(math.floor(256 * x), -(1 << 63)), (1 << 63) - 1) for x in vector]
        used.append((vec_id, ints, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    out = []
    for a, (anchor, mine, label) in enumerate(used):
        if anchor is None or anchor % 100:
            continue
        scored = []
        for b, (vec_id, its, other) in enumerate(used):
            total = sum(x * y for x, y in zip(mine, its, strict=False))
            total = (total + (1 << 63)) % (1 << 64) - (1 << 63)
            if a != b:
                scored.append((-total, vec_id is None, vec_id or 0, other == label, vec_id))
        scored.sort(key=lambda s: s[:3])
        for minus, *_, positive in [s for s in scored if s[3]][:5]:
            band = [s for s in scored if not s[3] and 30 * -minus <= -100 * s[0] <= 90 * -minus][:10]
            out += [(anchor, positive, rank, s[4], -minus, -s[0]) for rank, s in enumerate(band, 1)]
    return sorted(map(str, out))


def mined(spark, rows):
    full = [(*row, 1, "x", 0.5, 3) for row in rows]
    frame = spark.createDataFrame(full, SCHEMA)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, label_col=moved)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(str(tuple(r[c] for c in columns)) for r in found.collect())


def drawn(seed, n, dims=11, step=0.25):
    draw = random.Random(seed)
    return [(i, [draw.randint(-3, 6) * step for _ in range(dims)], draw.randint(0, 3)) for i in range(n)]


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(hard_negatives, "CELL_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 30)
    monkeypatch.setattr(hard_negatives, "OPEN_ANCHORS", 2)


def test_scores_by_look_up():
    draw = np.random.default_rng(1)
    for bits, dims in ((1, 8), (9, 64), (17, 16), (40, 24), (64, 8)):
        low, high = -(1 << bits - 1), (1 << bits - 1) - 1
        a, b = (draw.integers(low, high, (n, dims), endpoint=True) for n in (13, 2100))
        planes = planes_of(b, bits)
        assert (values_of(planes) == b).all()
        kind = hard_negatives._score_type(bits, dims)
        with np.errstate(over="ignore"):
            assert (scores(subset_sums(a, kind), planes) == a @ b.T).all()


@pytest.mark.parametrize("seed,dims,step", [(1, 11, 0.25), (2, 64, 0.003), (3, 1, 1.0)])
def test_every_pair(spark, small_cells, seed, dims, step):
    rows = drawn(seed, 420, dims, step)
    got = mined(spark, rows)
    assert got == plain(rows)
    assert len(got) > 20


def test_ties_copies_and_bad_rows(spark, small_cells):
    rows = [(i % 120 * 10, [1.0, float(i % 3), 0.5], i % 2) for i in range(360)]
    rows += [(None, [1.0, 1.0, 0.5], 1), (None, [1.0, 1.0, 0.5], 1), (1000, None, 1), (1100, [1.0, None, 2.0], 1), (1200, [math.nan], 0)]
    rows += [(1300, [math.inf, 1.0], 0), (1400, [1.0, 1.0], None), (1500, [2.0], 1), (1600, [], 0), (1700, [0.0, 0.0, 0.0, 4.0], 0)]
    assert mined(spark, rows) == plain(rows)


def test_one_label_holds_most(spark, small_cells):
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in drawn(6, 500)]
    assert mined(spark, rows) == plain(rows)


def test_scores_beyond_one_sort_key(spark, small_cells):
    draw = random.Random(8)
    rows = [(i * 20, [draw.uniform(-1, 1) * 1e8 for _ in range(5)], i % 3) for i in range(60)]
    rows += [(i * 20 + 1, [draw.choice([1.0, 2.0])] * 5, i % 3) for i in range(60)]
    assert mined(spark, rows) == plain(rows)
    assert len(mined(spark, [(0, [1e300, -1e300], 1), (100, [1e300, 1.0], 1), (1, [1.0, 1.0], 2)])) >= 0


def test_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == plain([(0, [], 1), (1, [], 1), (2, [], 2)])
