import numpy as np
import plain
from pyspark.sql import functions as F

from vitrine.llm import projections

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """(links, component) of (id, vector or None, label) rows with different identifiers."""
    def sound(v, label):
        return v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.float32(v).astype(float) if sound(v, label) else None for _, v, label in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
             and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    links = np.bincount(np.array(pairs, int).reshape(-1), minlength=len(rows)).tolist()
    root = plain.roots(len(rows), pairs)
    least = {}
    for (i, _, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    return {i: (n, least[r]) for (i, _, _), n, r in zip(rows, links, root)}


def found(df, **options):
    return {r["_id"]: (r["n_links"], r["component_id"]) for r in projections.near_vectors(df, **options).collect()}


def vectors(n, groups, seed=1, dim=32, noise=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    out = [(centres[k % groups] + noise * rng.standard_normal(dim)).astype(np.float32).tolist() for k in range(n)]
    return [(i, v, i % 3) for i, v in enumerate(out)]


def test_recall_and_counts(spark):
    rows = vectors(900, 60, noise=0.12)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_an_identifier_with_several_vectors(spark):
    a, b = vectors(1, 1)[0][1], vectors(1, 1, seed=9)[0][1]
    near = [(np.array(v) * (1 + 0.01 * np.arange(32) / 32)).astype(np.float32).tolist() for v in (a, b)]
    rows = [(1, a, 1), (1, b, 1), (2, near[0], 1), (3, near[1], 1), (4, b, 2), (4, b, 2), (0, near[1], 3)]
    got = sorted((r["_id"], r["n_links"], r["component_id"]) for r in projections.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4)]


def test_dense_group_is_counted_whole(spark):
    rows = [(i, v, 1) for i, v, _ in vectors(500, 1, noise=0.05)] + [(1000 + i, vectors(1, 1)[0][1], 1) for i in range(50)]
    got, want = found(spark.createDataFrame(rows, SCHEMA), window=8, block=64), brute(rows)
    assert got == want


def test_edges(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0] * 3, 1), (8, [0.0] * 3, 1), (9, [1.0, None, 3.0], 1),
            (10, [1.0, None, 3.0], 1), (11, [nan, 1.0, 1.0], 1), (12, [nan, 1.0, 1.0], 1), (13, [inf, 1.0, 1.0], 1), (14, [1.0, 2.0], 1),
            (15, [2.0, 4.0, 6.0], 1), (16, [3e38, 3e38, 0.0], 1), (17, [1e-38, 1e-38, 0.0], 1), (18, [-1.0, -2.0, -3.0], 1), (19, v, None),
            (20, [1.0, None, 2.0, 3.0], 1), (21, [1.0, 2.0, 3.0, None], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert found(df) == want and want[1] == (2, 1) and want[17] == (1, 16)
    more = df.withColumn("node", F.lit(1)).withColumn("root", F.lit("r")).union(df.limit(1).withColumn("node", F.lit(2)).withColumn("root", F.lit("s")))
    assert found(more)[1] == (3, 1)
    assert found(df.limit(0)) == {}
    null = projections.near_vectors(df.withColumn("vec_id", F.lit(None).cast("long")))
    assert {(r["n_links"], r["component_id"]) for r in null.collect()} == {(0, None)}


def test_what_the_windows_leave_out_is_found(spark):
    """Pairs planted in a tight label: with one pass and a window of one, none may be lost."""
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    rows = []
    for k in range(300):
        v = centre + 0.33 * rng.standard_normal(64)
        rows += [(2 * k, v.astype(np.float32).tolist(), 1), (2 * k + 1, (v + 0.1 * rng.standard_normal(64)).astype(np.float32).tolist(), 1)]
    rows += [(1_000 + i, v, 2) for i, v, _ in vectors(100, 20, noise=0.12)]
    want = brute(rows)
    assert sum(n for n, _ in want.values()) >= 600
    for compared in (50, 4_096):
        assert found(spark.createDataFrame(rows, SCHEMA), passes=1, window=1, compared=compared) == want
