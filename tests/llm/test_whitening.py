from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import whitening


def scatter(x):
    centred = x - x.mean(0)
    return centred.T @ centred


def close(spectrum, x):
    """The spectrum is that of the vectors' centred scatter."""
    want = scatter(x)
    scale = max(1.0, np.abs(want).max())
    got = spectrum.vectors @ np.diag(spectrum.values) @ spectrum.vectors.T
    assert np.abs(got - want).max() <= 1e-11 * scale
    assert np.abs(spectrum.vectors.T @ spectrum.vectors - np.eye(x.shape[1])).max() <= 1e-11
    assert (np.diff(spectrum.values) >= 0).all() and (spectrum.sums == x.sum(0)).all() and spectrum.n == len(x)


def of(x):
    out = whitening.Spectrum.empty(x.shape[1])
    for row in x:
        out.add(row)
    return out


def tables():
    rng = np.random.default_rng(7)
    return {
        "plain": rng.integers(-60, 60, (400, 16)),
        "repeated eigenvalues": np.vstack([np.eye(12, dtype=int) * 5, -np.eye(12, dtype=int) * 5] * 3),
        "low rank": np.c_[rng.integers(-9, 9, (200, 3)), np.zeros((200, 6), int)],
        "one entry": rng.integers(-9, 9, (300, 1)),
        "one vector many times": np.repeat(rng.integers(-60, 60, (1, 8)), 40, 0),
        "fewer vectors than entries": rng.integers(-60, 60, (5, 16)),
        "far apart": (rng.normal(size=(300, 20)) * np.logspace(0, 6, 20)).astype(int),
        "far from zero": rng.integers(-3, 3, (300, 10)) + 10**6,
    }


@pytest.mark.parametrize("name", list(tables()))
def test_rank_one_updates_give_the_spectrum(name):
    close(of(tables()[name]), tables()[name])


def test_joined_spectra():
    rng = np.random.default_rng(8)
    x, y = rng.integers(-60, 60, (90, 12)), rng.integers(0, 90, (70, 12))
    both = of(x)
    both.join(of(y))
    close(both, np.vstack([x, y]))
    alone = whitening.Spectrum.empty(12)
    alone.join(of(x))
    alone.join(whitening.Spectrum.empty(12))
    close(alone, x)


def test_roots_of_the_secular_equation():
    rng = np.random.default_rng(9)
    for k in (1, 2, 5, 40):
        poles = np.sort(rng.normal(size=k)) * 10.0 ** rng.integers(-3, 6)
        z = rng.normal(size=k) * 10.0 ** rng.integers(-6, 3, k)
        origin, tau = whitening.secular_roots(poles, z**2)
        want = np.linalg.eigvalsh(np.diag(poles) + np.outer(z, z))
        scale = max(np.abs(poles).max(), z @ z)
        assert np.abs(poles[origin] + tau - want).max() <= 1e-13 * k * scale


def brute(x, rows, k=4):
    """Per row and component, up to the sign: deviation, whitened, explained; and n."""
    distinct = np.unique(x, axis=0)
    n, sums, mean = len(distinct), distinct.sum(0), distinct.mean(0)
    values, vectors = np.linalg.eigh((distinct - mean).T @ (distinct - mean) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, row in zip(rows, x):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        for c in range(min(k, x.shape[1])):
            out[i, c + 1] = exact, (row - mean) @ vectors[:, c] / math.sqrt(values[c]), values[c] / values.sum()
    return n, out


def held_to(rows, x, ids, spread=1e-9):
    n, want = brute(x, ids)
    assert sorted((r["vec_id"], r["component"]) for r in rows) == sorted(want)
    signs = {}
    for r in rows:
        deviation, value, explained = want[r["vec_id"], r["component"]]
        assert r["n"] == n and int(r["deviation"]) == deviation
        assert abs(r["explained"] - explained) <= 1e-12
        assert 0 <= r["identity_error"] < 1e-9
        if abs(value) > 1e-6:
            sign = math.copysign(1, value) * math.copysign(1, r["whitened"])
            assert signs.setdefault(r["component"], sign) == sign
        assert abs(abs(r["whitened"]) - abs(value)) <= spread * max(1, abs(value))


def flat(df):
    return df.select("row.*", *[c for c in df.columns if c != "row"]).collect()


def test_as_brute_force_over_slices(spark, monkeypatch):
    """Many slices, joined over several levels; a third of the rows are one vector."""
    monkeypatch.setattr(whitening, "SLICE", 16)
    monkeypatch.setattr(whitening, "MERGED", 3)
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(300, 8)) * np.arange(1, 9) + 0.3
    vectors[200:] = vectors[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    held_to(flat(whitening.whitened(docs)), np.floor(256 * vectors).astype(np.int64), range(300))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(11)
    good = [[float(c) for c in v] for v in rng.normal(size=(30, 5))]
    rows = [(i, v, 1, "x") for i, v in enumerate([*good, good[0], good[0], [-0.0] * 5])]
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [-inf] * 5]
    rows += [(100 + i, v, None, "y") for i, v in enumerate(odd)] + [(None, good[1], 1, None), (None, good[1], 1, None)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, `a.component` string")
    got = whitening.whitened(docs).collect()
    held = [r for r in got if r["row"]["vec_id"] is not None]
    x = np.floor(256 * np.array([*good, good[0], good[0], [0.0] * 5])).astype(np.int64)
    _, want = brute(x, range(33))
    assert sorted((r["row"]["vec_id"], r["component"]) for r in held) == sorted(want) and len(got) - len(held) == 8
    assert all(int(r["deviation"]) == want[r["row"]["vec_id"], r["component"]][0] for r in held)
    assert {r["row"]["n"] for r in got} == {1}


def test_tables_without_variance(spark):
    docs = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    got = flat(whitening.whitened(docs))
    assert sorted(tuple(r)[:3] for r in got) == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 2, 1)]
    assert {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in got} == {(None, None, None, 0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)], "vec_id long, embedding array<float>")
    got = flat(whitening.whitened(line))
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["identity_error"] < 1e-9 for r in got)
    assert whitening.whitened(docs.where("false")).collect() == []
    with pytest.raises(ValueError, match="of 1 to 2 entries"):
        whitening.whitened(docs.union(docs.select("vec_id", F.array(F.lit(1.0).cast("float")))))


def test_deviations_beyond_64_bits():
    x = np.array([[10**9, -(10**9)], [5, 7]])
    got = whitening._deviations(10**6, np.array([3, 4]), x)
    assert got == [(10**15 - 3) ** 2 + (-(10**15) - 4) ** 2, (5 * 10**6 - 3) ** 2 + (7 * 10**6 - 4) ** 2]
