"""Whitening against plain numpy over the whole list of vectors."""

import numpy as np
import pytest

from tradewind.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, component int, x binary"  # extra columns with clashing names


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, b"x") for i, v in rows], SCHEMA).repartition(5)


def scaled(vectors):
    return np.floor(64 * np.asarray(vectors, np.float32).astype(float)) + 1_000_000


def plain(x, fit):
    z = fit - fit.mean(0)
    e, u = np.linalg.eigh(z.T @ z / len(fit))
    e, u = e[::-1], u[:, ::-1]
    return (x - fit.mean(0)) @ u / np.sqrt(e), e / e.sum()


def compare(rows, ids, vectors, fit, components):
    want, explained = plain(scaled(vectors), scaled(fit))
    k = min(components, want.shape[1])
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, []).append(r)
    assert set(got) == set(ids) and len(rows) == k * len(ids)
    table = np.array([[r.whitened for r in sorted(got[i], key=lambda r: r.component)] for i in ids])
    signs = np.sign((table * want[:, :k]).sum(0))
    assert table * signs == pytest.approx(want[:, :k], abs=1e-7)
    first = sorted(got[ids[0]], key=lambda r: r.component)
    assert [r.component for r in first] == list(range(1, k + 1))
    assert [r.explained for r in first] == pytest.approx(explained[:k], rel=1e-9)
    assert {r.n for r in rows} == {len(fit)} and max(r.identity_error for r in rows) < 1e-9
    x, f = scaled(vectors).astype(int), scaled(fit).astype(int)
    dev = ((len(fit) * x - f.sum(0)) ** 2).sum(1)
    assert [got[i][0].deviation for i in ids] == dev.tolist()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 6)) * np.array([9, 7, 5, 3, 2, 1]) + np.array([40, -3, 0, 0, 100, 1])
    return np.concatenate([base, np.repeat(base[:1], 200, axis=0), np.repeat(base[1:9], 3, axis=0)]).astype(np.float32)


@pytest.mark.parametrize("components", [4, 32])
def test_counts_weigh_as_all_rows(spark, vectors, components, monkeypatch):
    monkeypatch.setattr(whitening, "SALTED_ROWS", 20)  # the copied vector is dealt over several keys
    ids = list(range(len(vectors)))
    rows = whitening.whiten(frame(spark, [(i, v.tolist()) for i, v in zip(ids, vectors)]), components).collect()
    compare(rows, ids, vectors, vectors, components)


def test_weight_one_fits_distinct_vectors(spark, vectors):
    ids = list(range(len(vectors)))
    rows = whitening.whiten(frame(spark, [(i, v.tolist()) for i, v in zip(ids, vectors)]), weights="one").collect()
    compare(rows, ids, vectors, np.unique(scaled(vectors), axis=0) / 64 - 1_000_000 / 64, 32)
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, []), weights="two")


def test_odd_rows_are_left_out(spark, vectors):
    some = vectors[:40]
    rows = [(i, v.tolist()) for i, v in enumerate(some)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5),
           (105, [1.0, 2.0]), (106, [3e30] * 6)]
    compare(whitening.whiten(frame(spark, rows + odd)).collect(), list(range(40)), some, some, 32)


def test_repeated_and_null_ids_stay_rows(spark, vectors):
    rows = [(i % 10 if i % 5 else None, v.tolist()) for i, v in enumerate(vectors[:60])]
    got = whitening.whiten(frame(spark, rows), 2).groupBy("vec_id").count().collect()
    assert {r.vec_id: r["count"] for r in got} == {None: 24, **{i: 12 for i in (1, 2, 3, 4, 6, 7, 8, 9)}}


def test_no_variance_and_empty_tables(spark):
    got = whitening.whiten(frame(spark, [(i, [1.5, 2.0]) for i in range(5)])).collect()
    assert len(got) == 10
    assert {(r.whitened, r.deviation, r.explained, r.identity_error) for r in got} == {(0.0, 0, 0.0, 1.0)}
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0]) for i in range(5)])).collect()
    assert all(r.whitened == 0 for r in flat if r.component == 2) and any(r.whitened for r in flat if r.component == 1)
    for rows in ([], [(1, None), (2, [])]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_deviation_beyond_a_long_is_null():
    model = whitening.Model(3, [0, 0])
    assert model.deviations(np.array([[10**11, 0], [2, 1]])) == [None, 45]
    assert model.deviations(np.array([[5, 0], [2, 1]])) == [225, 45]
    model = whitening.Model(3, [10, -10])
    assert model.deviations(np.array([[1, 2]])) == [(3 - 10) ** 2 + (6 + 10) ** 2]


def test_sums_stay_exact():
    x = np.array([[2**61, 1], [2**61 + 1, 2]])
    assert whitening._exact_dot(np.array([10, 10]), x).tolist() == [10 * (2**62 + 1), 30]
