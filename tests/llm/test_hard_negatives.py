"""Hard negatives against a plain version that scores every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinreach.llm import hard_negatives as hn
from twinreach.llm import queries
from twinreach.plans.compare import compare, duckdb_connection

SCHEMA = "vec_id long, embedding array<float>, label int, score int, row string"


def plain(rows, low=30, high=90):
    """Sorted result rows, by scoring each anchor with every row."""
    used = []
    for place, (i, vec, label) in enumerate(rows):
        if i is None or label is None or vec is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vec):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vec]
        used.append((place, i, q, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for place, i, q, label in used:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, r)), j, k, m) for k, j, r, m in used if k != place]
        for minus, j, _, _ in sorted(s for s in scored if s[3] == label)[:5]:
            near = [s for s in sorted(scored) if s[3] != label
                    and low * -minus <= 100 * -s[0] <= high * -minus]
            out += [(i, j, n, s[1], -minus, -s[0]) for n, s in enumerate(near[:10], 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, m, 1, "x") for i, v, m in rows], SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hn.hard_negatives(df, F.col("vec_id") % 100 == 0, label, **kw)
    return sorted(tuple(r) for r in out.collect())


def random_rows(n, width, seed, span=1.0):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-span, span) for _ in range(width)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"block_rows": 17, "group": 2}, {"block_rows": 64, "window": (10, 100)}])
def test_equals_scoring_every_pair(spark, kw):
    rows = random_rows(520, 20, 1)
    assert run(spark, rows, **kw) == plain(rows, *kw.get("window", (30, 90)))


def test_ties_repeats_and_rows_that_take_no_part(spark):
    few = [[1.0, 0.5], [0.5, 1.0], [0.25, 0.25], [-1.0, 0.0]]
    rows = [(i, few[i % 4], i % 3) for i in range(150)]  # many equal scores
    rows += [(100, few[0], 1), (100, few[0], 1), (200, few[1], None), (None, few[0], 1), (300, None, 1),
             (301, [None, 1.0], 1), (302, [float("nan"), 1.0], 1), (303, [float("inf"), 1.0], 1),
             (304, [], 1), (400, [], 1), (305, [1.0], 2), (306, [1.0, 0.5, 3.0], 2), (-100, few[0], 0)]
    assert run(spark, rows, block_rows=40) == plain(rows)


def test_hot_label_and_one_vector_for_a_third(spark):
    rng = random.Random(7)
    rows = [(i, v if i % 3 else [0.5] * 8, 1 if i % 2 else m) for i, v, m in random_rows(600, 8, 2)]
    rng.shuffle(rows)
    assert run(spark, rows, block_rows=50, group=3) == plain(rows)


def test_nothing_to_find(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert run(spark, [(100, [1.0], 1), (2, [1.0], 2)]) == []  # no positive
    assert run(spark, [(100, [-1.0], 1), (3, [1.0], 1), (2, [1.0], 2)]) == []  # empty windows


def test_bounds_never_refuse_a_row():
    rng = np.random.default_rng(4)
    cells = rng.integers(-200, 200, (12, 300))
    block = hn.Block(cells, np.arange(300), np.arange(300), np.zeros(300, np.int64),
                     np.zeros(300, np.uint8), cells.min(axis=1), cells.max(axis=1))
    q = rng.integers(-200, 200, 12)
    exact = q @ cells

    def keep(least, most):
        assert (least <= most).all()
        return most >= 20_000

    places, score = hn.scanned(block, q, np.ones(300, bool), keep)
    assert (score == exact[places]).all()
    assert set(places) == set(np.flatnonzero(exact >= 20_000))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_its_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert compare(queries.op13_hard_negatives(spark, sf_dir), duckdb_connection(sf_dir),
                   queries.ORACLE["op13_hard_negatives"]) == []
