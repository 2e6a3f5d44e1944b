"""Whitening against the covariance worked out directly."""

import numpy as np
import pytest

from scrollwork.llm.queries import QUERIES
from scrollwork.llm.whitening import COMPONENTS, brute_force, fit, integers


def rows(spark, folder):
    return sorted(QUERIES["op13_whitening"](spark, folder).collect(), key=lambda r: (r["vec_id"] is not None, r["vec_id"] or 0, r["component"]))


def agree(got, vectors):
    """`got`: the query's rows, those of each vector in the order of `vectors`."""
    deviations, whitened, explained = brute_force(vectors)
    k = len({r["component"] for r in got})
    assert len(got) == k * len(vectors) and {r["n"] for r in got} == {len(vectors)}
    assert [r["deviation"] for r in got[::k]] == deviations
    z = np.array([r["whitened"] for r in got]).reshape(len(vectors), k)
    signs = np.sign((z * whitened[:, :k]).sum(0))
    assert np.abs(z - signs * whitened[:, :k]).max() < 1e-9
    assert np.allclose([r["explained"] for r in got[:k]], explained[:k], rtol=1e-9)
    assert max(r["identity_error"] for r in got) < 1e-9
    return k


def test_more_dimensions_than_components(spark, write):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 40)) * np.linspace(0.1, 3, 40) + 7).astype(np.float32).tolist()
    assert agree(rows(spark, write([], embeddings=list(enumerate(vectors)))), vectors) == COMPONENTS


def test_directions_without_variance_are_no_components(spark, write):
    rng = np.random.default_rng(2)
    # 1/64 steps, so that the sum of two entries is kept exactly
    a, b = (rng.integers(-200, 200, 50) / 64 for _ in range(2))
    vectors = np.stack([a, b, a + b, np.full(50, 3.0)], 1).tolist()
    assert agree(rows(spark, write([], embeddings=list(enumerate(vectors)))), vectors) == 2


def test_unusable_repeated_and_unnamed_vectors(spark, write):
    good = [(1, [0.5, 1.0]), (2, [-3.0, 0.25]), (2, [-3.0, 0.25]), (None, [4.0, -9.0]), (3, [0.0, 0.0])]
    bad = [(4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [1.0, float("inf")]), (8, [float("-inf"), 0.0]), (9, [])]
    got = rows(spark, write([], embeddings=[*bad[:3], *good, *bad[3:]]))
    order = [g[1] for g in sorted(good, key=lambda g: (g[0] is not None, g[0] or 0))]
    got.sort(key=lambda r: (r["vec_id"] is not None, r["vec_id"] or 0))  # equal rows are equal, so any order among them will do
    k = len({r["component"] for r in got})
    by_vector = [got[at : at + 2 * k] if got[at]["vec_id"] == 2 else got[at : at + k] for at in (0, k, 2 * k, 4 * k)]
    flat = [r for part in by_vector for r in (sorted(part, key=lambda r: r["component"]) if len(part) == k else [*sorted(part, key=lambda r: r["component"])[::2], *sorted(part, key=lambda r: r["component"])[1::2]])]
    assert agree(flat, order) == 2


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, write, vectors):
    assert rows(spark, write([], embeddings=vectors)) == []


def test_what_cannot_be_exact_is_an_error(spark, write):
    with pytest.raises(ValueError, match="different lengths"):
        rows(spark, write([], embeddings=[(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="too large"):
        rows(spark, write([], embeddings=[(1, [1e30]), (2, [1.0])]))
    with pytest.raises(Exception, match="does not fit"):
        rows(spark, write([], embeddings=[(1, [1e9]), (2, [-1e9])]))


def test_result_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(rng.normal(size=(200, 6)).tolist())], "vec_id long, embedding array<double>")
    one, many = (fit(integers(frame.repartition(n))) for n in (1, 7))
    assert one.n == many.n == 200 and (one.sums == many.sums).all() and one.total_variance == many.total_variance
    assert np.allclose(one.eigenvalues, many.eigenvalues, rtol=1e-12)
