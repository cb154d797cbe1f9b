import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import catalog, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, components=32):
    """Whitening with fractions for the matrix: (n, deviations, whitened, explained)."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    centred = [[r[i] - mean[i] for i in range(d)] for r in x]
    matrix = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(-values)[:components]
    white = np.array([[float(c) for c in r] for r in centred]) @ axes[:, order] / np.sqrt(values[order])
    far = [int(sum((n * c) ** 2 for c in r)) for r in centred]
    return n, far, white, values[order] / np.trace(matrix)


def gathered(rows):
    out = {}
    for r in rows:
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


def test_query_equals_plain_whitening(spark, tmp_path):
    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(40, 40)) * np.linspace(0.5, 4, 40)
    vectors = (rng.normal(size=(300, 40)) @ mixing).tolist()
    bad = [(1000, None, 1), (1001, [1.0, None] + [0.0] * 38, 1), (1002, [float("nan")] * 40, 1), (1003, [float("inf")] + [0.0] * 39, 1), (1004, [], 2)]
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)] + bad
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1)).withColumn("vector", F.lit("v")).withColumn("_id", F.lit(0))
    df.repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    result = catalog.op12(spark, str(tmp_path))
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(result.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    got = gathered(result.collect())
    n, far, white, explained = plain(vectors)
    assert sorted(got) == list(range(300)) and all(sorted(c) == list(range(1, 33)) for c in got.values())
    found = np.array([[got[i][c]["whitened"] for c in range(1, 33)] for i in range(300)])
    signs = np.sign((found * white).sum(axis=0))
    assert np.allclose(found, white * signs, atol=1e-8)
    assert all(got[i][1]["deviation"] == far[i] and got[i][1]["n"] == n for i in range(300))
    assert np.allclose([got[0][c]["explained"] for c in range(1, 33)], explained, rtol=1e-9)
    errors = {r["identity_error"] for c in got.values() for r in c.values()}
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert np.abs(np.cov(found.T, bias=True) - np.eye(32)).max() < 1e-9


def test_exact_squares_at_every_size():
    rng = random.Random(5)
    for bits in (8, 20, 30, 40, 47, 55, 62):
        values = [[rng.randint(-(1 << bits) + 1, (1 << bits) - 1) for _ in range(3)] for _ in range(2000)]
        want = [sum(r[i] ** 2 for r in values) for i in range(3)]
        assert whitening.exact_squares(np.array(values, np.int64)) == want
        total = sum(want) * (-1 if bits % 2 else 1)
        assert sum(p << (whitening.PIECE * k) for k, p in enumerate(whitening.pieces_of(total))) == total


def test_covariance_by_polarisation_is_exact():
    rng = random.Random(6)
    x = [[rng.randint(-10**9, 10**9) for _ in range(5)] for _ in range(50)]
    sums = [sum(r[i] for r in x) for i in range(5)]
    y = [[50 * r[i] - sums[i] for i in range(5)] for r in x]
    squares = {(i, j): sum(((r[i] + r[j]) if i < j else r[i]) ** 2 for r in y) for i in range(5) for j in range(i, 5)}
    found = whitening.covariance(50, squares, 5)
    for i in range(5):
        for j in range(5):
            assert found[i, j] == float(Fraction(sum(r[i] * r[j] for r in y), 50**3))


def test_defined_cases(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()

    assert run([]) == [] and run([(1, None, 1), (2, [], 1), (3, [float("nan")], 1)]) == []
    # One vector, and equal vectors, have no variance.
    for rows in ([(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 5):
        for r in run(rows):
            assert r["whitened"] == [0.0, 0.0] and r["explained"] == [0.0, 0.0] and r["deviation"] == 0 and r["identity_error"] == 0.0
    # Repeated rows count each; two lengths have fits of their own; huge entries stay exact.
    rows = [(1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (None, [1.0, 0.0], None), (2, [3.0], 1), (3, [5.0], 1), (4, [1e30, 0.0], 1), (5, [-1e17, 2.0], 1)]
    got = run(rows)
    assert len(got) == 7 and {len(r["whitened"]) for r in got} == {1, 2}
    assert [r["n"] for r in got if len(r["whitened"]) == 1] == [2, 2]
    assert {round(r["whitened"][0] ** 2, 9) for r in got if len(r["whitened"]) == 1} == {1.0}
    assert all(np.isfinite(r["whitened"]).all() for r in got)
    # A dimension that never varies leaves a component without variance out of the check.
    flat = run([(i, [float(i), 7.0, float(i * i % 5)], 1) for i in range(20)])
    assert all(r["whitened"][2] == 0.0 and r["identity_error"] < 1e-9 for r in flat)
    with pytest.raises(ValueError, match="lengths"):
        run([(i, [0.5] * i, 1) for i in range(1, 20)])


def test_whole_table(spark, folder):
    result = catalog.op12(spark, folder)
    vectors = [r["embedding"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    n, far, white, explained = plain(vectors)
    got = gathered(result.collect())
    found = np.array([[got[i][c]["whitened"] for c in range(1, 33)] for i in sorted(got)])
    ids = [r["vec_id"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    white = white[np.argsort(ids)]
    assert np.allclose(found, white * np.sign((found * white).sum(axis=0)), atol=1e-7)
    assert [got[i][1]["deviation"] for i in sorted(got)] == [far[k] for k in np.argsort(ids)]
