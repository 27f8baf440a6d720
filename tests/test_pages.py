"""Pages as groups: neighbours and words in one pass, from items that are shuffled once."""

import random

import numpy as np
import pytest

from quireon.operators import boxes as B
from quireon.operators import layout as Y
from quireon.plans import layout, queries as Q  # noqa: F401  register their queries

SF = "/root/testdata/sf0.001"


def test_beside_equals_all_pairs():
    rng = random.Random(5)
    for n in (0, 1, 2, 30, 700):
        x, top = (np.array([rng.randrange(60) for _ in range(n)], "int64") for _ in range(2))
        z, bottom = x + np.array([rng.randrange(1, 9) for _ in range(n)], "int64"), top + np.array([rng.randrange(1, 30) for _ in range(n)], "int64")
        ids = np.array(rng.sample(range(9999), n), "int64")
        left, right = B.beside(x, z, top, bottom, ids, block=64)
        for i in range(n):
            met = [j for j in range(n) if top[i] < bottom[j] and top[j] < bottom[i]]
            a = min(((x[i] - x[j], ids[j], j) for j in met if x[j] < x[i]), default=None)
            b = min(((x[j] - x[i], ids[j], j) for j in met if x[j] > x[i]), default=None)
            assert left[i] == (a[2] if a and z[a[2]] > x[i] - (z[i] - x[i]) else -1)
            assert right[i] == (b[2] if b and x[b[2]] < z[i] + (z[i] - x[i]) else -1)


def test_boxes_without_corners_have_no_neighbours(spark):
    rows = [(1, 0, 0, 0, 5, 9), (1, 1, 6, 0, 11, 9), (1, 2, None, 0, None, 9), (2, 0, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, box_id long, anchor_x int, anchor_y int, antipod_x int, antipod_y int")
    assert sorted(map(tuple, B.neighbours(df).collect()), key=str) == [(1, 0, None, 1), (1, 1, 0, None), (1, 2, None, None), (2, 0, None, None)]
    assert sorted((r.page_id, r.box_id, r.word, r.place) for r in Y.in_words(df).collect()) == [(1, 0, 0, 0), (1, 1, 0, 1), (1, 2, 1, 0), (2, 0, 0, 0)]


@pytest.mark.parametrize(("name", "most"), [("q_words", 1), ("q_lines", 1), ("q_neighbors", 1), ("q_ray_stops", 5), ("q_reading_order", 4), ("q_segments", 4), ("q_wordy_boxes", 2), ("q_font_sizes", 6), ("q_component_stats", 2)])
def test_items_are_shuffled_by_pages(spark, name, most):
    """Nothing is written between the items and a page's result but small tables, so the plan has all shuffles of boxes."""
    plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= most
    assert "characters-" not in plan and "chains-" not in plan and "neighbours-" not in plan and "labels-" not in plan
