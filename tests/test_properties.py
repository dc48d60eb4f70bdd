"""Property test: the Spark fit equals a plain NumPy Lloyd with the same rules on random inputs.

Points sit on a coarse grid, so exact distance ties, duplicate points and empty clusters all occur.
"""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from centroidal.operators.lloyd import fit_kmeans

X, Y = "pickup_longitude", "pickup_latitude"

grid = st.tuples(st.integers(0, 8), st.integers(0, 6)).map(lambda p: (-75.0 + 0.25 * p[0], 40.0 + 0.25 * p[1]))


def reference_lloyd(points, centres, max_iter):
    """Sequential Lloyd: strict < keeps the first minimum, micro-unit means, empty clusters stay."""
    cs = [list(c) for c in centres]
    prev = None
    counts = [0] * len(cs)
    history = []
    for it in range(max_iter):
        assign = []
        for x, y in points:
            best, bk = float("inf"), 0
            for k, (cx, cy) in enumerate(cs):
                d = (x - cx) * (x - cx) + (y - cy) * (y - cy)
                if d < best:
                    best, bk = d, k
            assign.append(bk)
        moved = len(points) if prev is None else sum(a != b for a, b in zip(assign, prev))
        history.append(moved)
        for k in range(len(cs)):
            members = [p for p, a in zip(points, assign) if a == k]
            counts[k] = len(members)
            if members:
                sx = sum(int(np.floor(p[0] * 1e6 + 0.5)) for p in members)
                sy = sum(int(np.floor(p[1] * 1e6 + 0.5)) for p in members)
                cs[k] = [float(sx) / float(len(members)) / 1e6, float(sy) / float(len(members)) / 1e6]
        prev = assign
        if moved == 0:
            break
    return [tuple(c) for c in cs], history


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points=st.lists(grid, min_size=1, max_size=40),
       centres=st.lists(grid, min_size=1, max_size=4, unique=True),
       max_iter=st.integers(1, 6),
       parts=st.integers(1, 4),
       method=st.sampled_from(["partials", "arrow", "expr"]))
def test_fit_equals_sequential_lloyd(spark, points, centres, max_iter, parts, method):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)],
                               "id bigint, pickup_longitude double, pickup_latitude double").repartition(parts)
    m = fit_kmeans(df, len(centres), max_iter, key="id", initial_centres=centres, method=method)
    expected, history = reference_lloyd(points, centres, max_iter)
    assert m.centres == expected
    assert [h["n_moved"] for h in m.history] == history
    assert sum(m.counts) == len(points)
