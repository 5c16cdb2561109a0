import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int"


def clusters(seed=4, width=24):
    """Single vectors, pairs near the threshold, and a large class of near copies."""
    draw = np.random.default_rng(seed)
    rows = [draw.normal(size=width) for _ in range(300)]
    for i in range(0, 120, 2):
        noise = draw.normal(size=width)
        noise -= noise @ rows[i] / (rows[i] @ rows[i]) * rows[i]
        angle = np.arccos(0.86 + 0.14 * draw.random())
        unit = rows[i] / np.linalg.norm(rows[i])
        rows[i + 1] = 5 * (np.cos(angle) * unit + np.sin(angle) * noise / np.linalg.norm(noise))
    rows += [rows[200] + 0.02 * draw.normal(size=width) for _ in range(90)]
    return [np.float32(r) for r in rows]


def truth(rows):
    x = np.array(rows, float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    return close


def test_recall_and_no_false_link(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 32)
    rows = clusters()
    close = truth(rows)
    df = spark.createDataFrame([(i * 7, [float(v) for v in r], 0) for i, r in enumerate(rows)], SCHEMA).repartition(4)
    found = {r.vec_id // 7: r for r in pivots.near_vectors(df).collect()}
    assert len(found) == len(rows)
    n = np.array([found[i].n_links for i in range(len(rows))])
    assert (n <= close.sum(axis=1)).all()
    assert n.sum() / close.sum() >= 0.9
    singles = close.sum(axis=1) == 0
    assert all(found[i].component_id == i * 7 and found[i].kept for i in np.flatnonzero(singles))
    big = {found[i].component_id for i in [200, *range(300, 390)]}
    assert big == {200 * 7} and sum(found[i].kept for i in range(300, 390)) == 0


def test_equal_vectors_and_bad_ones(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(1, same, 0), (2, same, 0), (2, same, 0), (3, [2.0, 4.0, 6.0], 1), (4, None, 0), (5, [], 0), (6, [0.0] * 3, 0),
            (7, [1.0, None, 3.0], 0), (8, [float("nan"), 1.0, 1.0], 0), (9, [float("inf"), 1.0, 1.0], 0),
            (10, [1.0, 2.0], 0), (None, same, 0), (11, [-1.0, -2.0, -3.0], 0), (12, [1e-30, 2e-30, 3e-30], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit("clash"))
    found = pivots.near_vectors(df).collect()
    assert len(found) == len(rows)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=str)
    linked = {1, 2, 3, 12, None}
    assert all(n == 5 and c == 1 and k == (v == 1) for v, n, c, k in got if v in linked)
    assert all((n, c, k) == (0, v, True) for v, n, c, k in got if v not in linked)


def test_empty_table(spark):
    assert pivots.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = pivots.near_vectors(spark.createDataFrame([(3, None, 1)], SCHEMA)).collect()
    assert [tuple(r) for r in alone] == [(3, 0, 3, True)]


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def correlated(n, mean, seed=1, width=64):
    """Unit vectors of this mean cosine; a fifth are pairs at 0.9 to 0.99."""
    draw = np.random.default_rng(seed)
    common = unit(draw.normal(size=(1, width)))
    across = lambda x, *to: unit(x - sum((x * t).sum(axis=1)[:, None] * t for t in to))
    own = across(draw.normal(size=(n, width)), common)
    k = n // 10
    cosine = (draw.uniform(0.9, 0.99, k)[:, None] - mean) / (1 - mean)
    own[k:2 * k] = cosine * own[:k] + np.sqrt(1 - cosine ** 2) * across(draw.normal(size=(k, width)), common, own[:k])
    return np.sqrt(mean) * common + np.sqrt(1 - mean) * own


def shared_pivots(space, rows, a, b):
    near = space.nearest(rows)
    return np.concatenate([(near[a[i:i + 20_000], :, None] == near[b[i:i + 20_000], None, :]).any(axis=2).sum(axis=1)
                           for i in range(0, len(a), 20_000)])


def cells(space, rows):
    """Pairs that the lists compare."""
    near = np.sort(space.nearest(rows), axis=1).astype(np.int64)
    i, j = np.triu_indices(near.shape[1], 1)
    _, lengths = np.unique(near[:, i] * (1 << 32) + near[:, j], return_counts=True)
    return (lengths * (lengths - 1) / 2).sum()


@pytest.mark.parametrize("mean", [0, 0.5, 0.8])
def test_vectors_with_a_common_direction(mean):
    rows = correlated(8500, mean)
    space = pivots.fitted(rows, len(rows), 0.9, 0)
    assert space.points is not None and cells(space, rows) < 0.3 * len(rows) ** 2 / 2
    a, b = np.nonzero(np.triu(rows @ rows.T >= 0.9, 1))
    assert (shared_pivots(space, rows, a, b) >= 2).mean() >= 0.95


def test_where_nearly_all_is_close_every_pair_is_looked_at_once():
    """Mean cosine 0.87: every thirtieth pair links. No plan finds them for less than all pairs."""
    rows = correlated(5000, 0.87)
    space = pivots.fitted(rows, len(rows), 0.9, 0)
    assert space.points is None and cells(space, rows) == 5000 * 4999 / 2


@pytest.mark.parametrize("mean, most", [(0, 5), (0.3, 5), (0.5, 6)])
def test_work_grows_with_the_vectors(mean, most):
    """Four times the vectors: about as many comparisons a vector, somewhat more where more pivots are needed."""
    few, many = correlated(10_000, mean, seed=2), correlated(40_000, mean, seed=2)
    spaces = [pivots.fitted(x[:8_000], len(x), 0.9, 0) for x in (few, many)]
    assert cells(spaces[1], many) <= most * cells(spaces[0], few)


def test_each_length_has_its_index(spark):
    draw = np.random.default_rng(7)
    wide, narrow = correlated(1200, 0.5, width=32), correlated(40, 0.5, width=5)
    rows = [*wide, *narrow, np.array([1.0, 2.0]), np.array([2.0, 4.0]), np.array([3.0])]
    order = draw.permutation(len(rows))
    df = spark.createDataFrame([(int(i), [float(v) for v in rows[i]], 0) for i in order], SCHEMA).repartition(4)
    found = {r.vec_id: r.n_links for r in pivots.near_vectors(df).collect()}
    close = [truth([np.float32(r) for r in x]).sum(axis=1) for x in (wide, narrow)]
    mine = np.array([found[i] for i in range(1240)])
    assert (mine <= np.concatenate(close)).all() and mine[:1200].sum() >= 0.95 * close[0].sum()
    assert (mine[1200:] == close[1]).all()
    assert [found[i] for i in range(1240, 1243)] == [1, 1, 0]


def test_copies_are_one_vector_with_a_weight(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=8)
    near = base + 0.01 * draw.normal(size=8)
    rows = [(i, base.tolist(), 0) for i in range(3000)] + [(3000 + i, near.tolist(), 0) for i in range(3)] + [(9000, (-base).tolist(), 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {(r.n_links, r.component_id) for r in pivots.near_vectors(df).collect()}
    assert found == {(3002, 0), (0, 9000)}


def test_recall_near_the_threshold_with_the_most_points():
    """Pairs at cosine 0.90 to 0.93 among ``MAX_POINTS`` points, as a table of many millions of rows has them."""
    draw = np.random.default_rng(8)
    sample, x, other = (unit(draw.normal(size=(n, 64))) for n in (2 * pivots.MAX_POINTS + 2_000, 1500, 1500))
    other = unit(other - (other * x).sum(axis=1)[:, None] * x)
    cosine = np.linspace(0.9, 0.93, 1500)[:, None]
    space = pivots.fitted(sample, 10 ** 9, 0.9, 0)
    assert len(space.points) == pivots.MAX_POINTS
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine ** 2) * other])
    assert (shared_pivots(space, both, np.arange(1500), np.arange(1500, 3000)) >= 2).mean() >= 0.95


def test_recall_against_brute_force_with_many_points(spark, monkeypatch):
    """All of the query, its number of points forced to 2,048."""
    monkeypatch.setattr(pivots, "points_wanted", lambda n, kept, length, width: 2_048)
    draw = np.random.default_rng(9)
    rows = draw.normal(size=(4200, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    noise = draw.normal(size=(2100, 64))
    noise -= (noise * rows[::2]).sum(axis=1)[:, None] * rows[::2]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = np.linspace(0.9001, 0.93, 2100)[:, None]
    rows[1::2] = cosine * rows[::2] + np.sqrt(1 - cosine ** 2) * noise
    rows = np.float32(rows)
    close = truth(rows)
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)], SCHEMA).repartition(4)
    found = {r.vec_id: r for r in pivots.near_vectors(df).collect()}
    n = np.array([found[i].n_links for i in range(len(rows))])
    assert (n <= close.sum(axis=1)).all() and close.sum() >= 4200
    assert n.sum() / close.sum() >= 0.97
