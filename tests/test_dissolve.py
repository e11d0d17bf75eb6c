"""Unions of polygons as boundaries."""

import random

import pytest

from cinderframe.operators.dissolve import union_area, union_boundary


def box(x0, y0, x1, y1, back=False):
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return ring[::-1] if back else ring


def measured(spark, rows, tile=2.0):
    df = spark.createDataFrame([(c, [[tuple(map(float, p)) for p in ring] for ring in rings]) for c, rings in rows], "case_id long, rings array<array<struct<x:double,y:double>>>")
    return {r.case_id: (round(r.area, 6), round(r.length, 6), r.edges) for r in union_area(union_boundary(df, tile)).collect()}


def test_small_unions(spark):
    rows = [
        (1, [box(0, 0, 4, 4)]), (1, [box(2, 2, 6, 6, back=True)]),  # two that overlap
        (2, [box(0, 0, 2, 2)]), (2, [box(2, 0, 4, 2)]),  # neighbours with a common edge
        (3, [box(0, 0, 2, 2)]), (3, [box(2, 1, 4, 3)]),  # neighbours along half an edge
        (4, [box(0, 0, 9, 9)]), (4, [box(3, 3, 5, 5)]),  # one within another
        (5, [box(0, 0, 9, 9), box(2, 2, 7, 7)]), (5, [box(3, 3, 4, 4)]),  # an island in a hole
        (6, [box(0, 0, 2, 2)]), (6, [box(0, 0, 2, 2)]),  # the same twice
        (7, [box(0, 0, 1, 1)]), (7, [box(500, 500, 501, 502)]),  # far apart
        (8, [box(0, 0, 2, 2)]), (8, [box(2, 2, 4, 4)]),  # touching in a corner
        (9, [box(0, 0, 2, 4)]), (9, [box(0, 1, 2, 3)]),  # common edges on the same side
        (10, [[(0, 0), (1, 1)]]), (10, [box(0, 0, 1, 1)]),  # a ring that is none
    ]
    got = measured(spark, rows)
    assert {c: v[:2] for c, v in got.items()} == {1: (28.0, 24.0), 2: (8.0, 12.0), 3: (8.0, 14.0), 4: (81.0, 36.0), 5: (57.0, 60.0), 6: (4.0, 8.0), 7: (3.0, 10.0), 8: (8.0, 16.0), 9: (8.0, 12.0), 10: (1.0, 4.0)}
    assert got[1][2] == 8 and got[4][2] == 4


def test_boundaries_close(spark):
    """Each corner of a boundary is left as often as it is reached, for polygons at odd angles."""
    rng = random.Random(5)
    rows = []
    for case in range(4):
        for _ in range(6):
            x, y = rng.uniform(0, 10), rng.uniform(0, 10)
            rows.append((case, [[(x, y), (x + rng.uniform(1, 9), y + rng.uniform(-2, 2)), (x + rng.uniform(-2, 2), y + rng.uniform(1, 9))]]))
    df = spark.createDataFrame(rows, "case_id long, rings array<array<struct<x:double,y:double>>>")
    edges = union_boundary(df, 2.0).collect()
    assert {e.case_id for e in edges} == {0, 1, 2, 3}
    assert sorted((e.case_id, e.x1, e.y1) for e in edges) == sorted((e.case_id, e.x2, e.y2) for e in edges)
    for case in range(4):
        own = [r for c, r in rows if c == case]
        # Counts of a fine grid's centres within any triangle.
        step, n = 0.02, 0
        sides = [[(a, b) for a, b in zip(r[0], r[0][1:] + r[0][:1])] for r in own]
        for i in range(-200, 1000, 4):
            for j in range(-200, 1000, 4):
                p = (i * step, j * step)
                n += any(len({(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) > 0 for a, b in s}) == 1 for s in sides)
        area = sum(e.x1 * e.y2 - e.x2 * e.y1 for e in edges if e.case_id == case) / 2
        assert area == pytest.approx(n * (4 * step) ** 2, rel=0.03)


def test_nothing_to_join(spark):
    assert measured(spark, []) == {}
