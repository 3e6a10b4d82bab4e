"""Whitening against plain linear algebra over exact whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesmith.llm.queries import QUERIES
from pagesmith.llm.whitening import solved, whiten

SF = "/root/testdata/sf0.01"


def whole(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def check(rows, found, components=16, close=1e-7):
    """Every value of ``found`` against a plain version over ``rows`` (key, vector)."""
    rows = [(k, whole(v)) for k, v in rows if usable(v)]
    fit = np.array(sorted({tuple(x) for _, x in rows}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    far = np.array((n * fit - sums).tolist(), float) / n
    _, spread, turned = np.linalg.svd(far)
    values, vectors = np.zeros(far.shape[1]), turned.T
    values[: len(spread)] = spread**2 / n
    has = values > 1e-12 * values[0]
    k = min(components, len(sums))
    by_key = {}
    for r in found:
        by_key.setdefault(r.vec_id, []).append(r)
    assert len(found) == k * len(rows) and set(by_key) == {key for key, _ in rows}
    signs = {}
    for key, x in rows:
        mine = sorted(by_key[key], key=lambda r: r.component)
        a = np.array([float(Fraction(n * v - s, n)) for v, s in zip(x, sums.tolist(), strict=True)])
        for r in mine:
            assert r.n == n and r.deviation == sum((n * v - s) ** 2 for v, s in zip(x, sums.tolist(), strict=True))
            i = r.component - 1
            if not has[i]:
                assert r.whitened is None and r.explained == (0.0 if values[0] > 0 else None)
                continue
            assert abs(r.explained - values[i] / values.sum()) <= 1e-4 * r.explained
            assert r.identity_error <= 1e-6
            want = a @ vectors[:, i] / math.sqrt(values[i])
            gap = min([abs(values[i] - values[j]) for j in (i - 1, i + 1) if 0 <= j < len(values)], default=1.0) / values[0]
            if gap > 1e-3:  # else the component isn't determined
                sign = signs.setdefault(i, 1 if want * r.whitened > 0 else -1) if abs(want) > 1e-3 else signs.get(i, 1)
                assert abs(want) < 1e-3 or abs(r.whitened - sign * want) < close
    white = np.array([[r.whitened for r in sorted(by_key[key], key=lambda r: r.component)][: int(has[:k].sum())]
                      for key in {tuple(x): key for key, x in rows}.values()], float)
    if white.size:
        assert np.abs(white.T @ white / n - np.eye(white.shape[1])).max() < 1e-6


def test_query_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = QUERIES["op11_whitening"](spark, SF).collect()
    assert found[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    check(rows, found)


def test_nearly_dependent_and_constant_directions(spark):
    """Variances over twelve orders of magnitude, a constant and a doubled dimension."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)) * 10.0 ** np.arange(4, -4, -1) / 4
    table = np.column_stack([base, base[:, 0] + base[:, 1] / 64, np.full(300, 3.0), base[:, 2]])
    rows = [(i, v) for i, v in enumerate(table.tolist())]
    check(rows, whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), close=1e-4)


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0], [1.0, 2.0]], [[1.0], [2.0], [4.0]], [[1.0, 2.0, 3.0], [2.0, 3.0, 5.0]]])
def test_few_vectors(spark, vectors):
    rows = list(enumerate(vectors))
    check(rows, whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), float(i * i % 7), 0.5 * i]) for i in range(30)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 0.0, 0.0]), (103, [0.0, -inf, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0])]
    more = [(3, good[3][1]), (3, good[4][1]), (200, good[5][1])] + [(300 + i, good[0][1]) for i in range(50)]
    rows = [*good, *odd, *more, (None, good[7][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("x", "key", "n", "part")})
    found = whiten(frame).collect()
    ids = {r.vec_id for r in found}
    assert ids == {k for k, _ in good} | {k for k, _ in more} | {None}
    kept = [*good, *[m for m in more if m[0] != 3]]
    check(kept, [r for r in found if r.vec_id not in (None, 3)] + _first(found, good[3][1], kept))
    assert sum(r.vec_id == 3 for r in found) == 3 * 3 and sum(r.vec_id is None for r in found) == 3
    assert whiten(frame.limit(0)).collect() == [] and whiten(frame.where("vec_id IN (100, 102)")).collect() == []


def _first(found, vector, kept):
    """The rows of the key 3 that belong to ``vector``: those with the same deviation as the plain one."""
    fit = {tuple(whole(v)) for _, v in kept}
    n, sums = len(fit), np.array(sorted(fit)).sum(axis=0).tolist()
    deviation = sum((n * v - s) ** 2 for v, s in zip(whole(vector), sums, strict=True))
    mine = {}
    for r in found:
        if r.vec_id == 3 and r.deviation == deviation:
            mine.setdefault(r.component, r)
    return list(mine.values())


def test_wide_deviation_is_null(spark):
    rows = [(i, [float(i % 2) * 1e13, float(i)]) for i in range(10)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 20 and {r.deviation for r in found} == {None} and {r.n for r in found} == {10}
    assert found[0].identity_error < 1e-6 and abs(sum(r.whitened for r in found if r.component == 1)) < 1e-9


def test_solved():
    rng = np.random.default_rng(0)
    factor = np.triu(rng.normal(size=(20, 20))) + 5 * np.eye(20)
    rows = rng.normal(size=(7, 20))
    assert np.allclose(solved(rows, factor) @ factor, rows)
