"""Hard negatives against brute force, and what the bounds save."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import empty
from tidemark.llm import negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(seed, count=400, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for at in range(count):
        vector = centres[rng.integers(12)] + rng.normal(scale=0.4, size=dims)
        vector /= np.linalg.norm(vector)
        rows.append((at, [float(np.float32(x)) for x in vector], int(rng.integers(4))))
    same = rows[50][1]
    rows += [(1000 + i, same, rows[50][2]) for i in range(8)] + [(2000 + i, same, (rows[50][2] + 1) % 4) for i in range(8)]
    rows += [(50, same, rows[50][2]), (50, same, rows[50][2]), (None, rows[100][1], rows[100][2]), (None, rows[100][1], 3)]
    rows += [
        (3000, None, 1), (3050, same, None), (3100, [1.0, None] + [0.0] * (dims - 2), 1), (3150, [float("nan")] * dims, 1),
        (3200, [float("inf")] * dims, 1), (3250, [], 1), (3251, [], 1), (3300, [0.0] * dims, 1), (3350, [1.0, 2.0], 1),
        (3351, [1.0, 2.0], 1), (3352, [0.8, 1.5], 2), (3353, [0.5, 0.9], 3), (3400, [-x for x in same], 2),
    ]
    return rows


def brute(rows):
    usable = [
        (nr, i, label, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for nr, (i, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    order = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    for a in usable:
        if a[1] is None or a[1] % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a[3], c[3])), c[1], c[0], c[2]) for c in usable if c[0] != a[0] and len(c[3]) == len(a[3])]
        scored = [s for s in scored if abs(s[0]) < 2**63]
        good = sorted((s for s in scored if s[3] == a[2]), key=order)[:5]
        for p in good:
            fit = sorted((s for s in scored if s[3] != a[2] and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=order)[:3]
            for rank, n in enumerate(fit):
                out[a[1], p[1], rank + 1, n[1], p[0], n[0]] += 1
    return out


@pytest.mark.parametrize("seed, block, near", [(1, negatives.BLOCK, 1024), (2, 16 * 40, 3), (3, 16 * 200, 1)])
def test_against_brute_force(spark, seed, block, near):
    rows = vector_rows(seed)
    if seed == 2:
        rows += [(5000 + 25 * i, [3e4 * x for x in rows[i][1]], 1) for i in range(20)]
    if seed == 3:
        rows += [(5000 + 25 * i, [3e7 * x for x in rows[i][1]], 1) for i in range(20)] + [(6000, [1e30] * 16, 2), (6050, [1e30] * 16, 2)]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS row", "2 AS block", "3 AS near", "4 AS dims", "5 AS score")
    got = negatives.mine(negatives.usable(frame), F.col("vec_id") % 50 == 0, block=block, near=near)
    expected = brute(rows[:-2] if seed == 3 else rows)
    found = Counter(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert found == expected and len(expected) > 80


def test_trees():
    points = np.random.default_rng(5).integers(-100, 100, (60, 4))
    place, parent, length = negatives.spanning_tree(points)
    assert sorted(place) == list(range(60)) and (parent < 0).sum() == 1
    assert all(place[parent[i]] < place[i] for i in range(60) if parent[i] >= 0)
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    inside, total = {0}, 0.0
    while len(inside) < 60:
        cost, new = min((far[i, j], j) for i in inside for j in range(60) if j not in inside)
        inside.add(new)
        total += cost
    assert abs(length.sum() - total) < 1e-3
    assert [len(x) for x in negatives.spanning_tree(points[:1])] == [1, 1, 1]


def test_bounds_leave_rows_out():
    """Near anchors share what their parent knows: few rows are scored again."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=32) * 50
    vectors = np.floor(base + rng.normal(scale=1, size=(40, 32))).astype(np.int64)
    rows = np.floor(rng.normal(size=(3000, 32)) * 50).astype(np.int64)
    place, parent, length = negatives.spanning_tree(vectors)
    anchors = sorted(
        ({"vector": v, "place": p, "parent": place[u] if u >= 0 else -1, "length": d, "label": 0, "row": -1}
         for v, p, u, d in zip(vectors, place, parent, length)), key=lambda a: a["place"],
    )
    block = {"row": np.arange(3000), "vec_id": np.arange(3000), "label": np.arange(3000) % 2, "matrix": negatives.Matrix(rows)}
    scored = []
    plain = negatives.Matrix.scores
    block["matrix"].scores = lambda v, n, some=None: scored.append(len(rows) if some is None else len(some)) or plain(block["matrix"], v, n, some)
    found = list(negatives.positives_of(anchors, block, 5))
    assert len(found) == 200 and sum(scored) < 0.3 * 40 * 3000
    expected = [(-s, i) for a in anchors for s, i in sorted(zip(-(rows[::2] @ a["vector"]), range(0, 3000, 2)))[:5]]
    assert [(f[2], f[3]) for f in found] == expected


def test_windows():
    assert negatives.windows(100) == (50, 95) and negatives.windows(101) == (51, 95)
    assert negatives.windows(0) == (0, 0) and negatives.windows(-100) == (-50, -95)


def test_empty_table(spark):
    nothing = negatives.usable(empty(spark, VECTORS))
    assert negatives.mine(nothing, F.col("vec_id") % 50 == 0).count() == 0
