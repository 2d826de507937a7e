"""Imputation with the defaults of production."""

import numpy as np
import pytest

from wavetide.operators import grid

READ = "station string, channel string, date string, start_us long, rate double, data array<float>"


@pytest.mark.parametrize(("gap", "period"), [(5, 20), (20, 20), (40, 20), (40, 60), (100, 60), (300, 50), (600, 40)])
def test_defaults_converge_over_a_gap(gap, period):
    t = np.arange(grid.BLOCK)
    x = np.sin(2 * np.pi * t / period)[None]
    known = np.ones(x.shape, bool)
    known[0, 240 : 240 + gap] = False
    guess = np.interp(t, t[known[0]], x[0][known[0]])[None]
    values, settled, modelled = grid.imputed(guess, known, np.array([grid.BLOCK]))
    assert settled.all() and modelled.all()
    assert np.abs(values - x).max() < 1e-2 < np.abs(guess - x).max()


def test_result_is_at_rest_under_plain_replacement():
    rng = np.random.default_rng(0)
    t = np.arange(grid.BLOCK)
    x = (np.sin(t / 9) + rng.normal(size=len(t)) / 2)[None]
    known = np.ones(x.shape, bool)
    known[0, 60:100] = known[0, 300:303] = known[0, -22:] = False
    full = grid.impute(np.interp(t, t[known[0]], x[0][known[0]])[None], known)
    centre = x[known].mean()
    hankel = np.lib.stride_tricks.sliding_window_view(full[0] - centre, grid.WINDOW)
    lead = np.linalg.svd(hankel, full_matrices=False)[2][: grid.RANK]
    low = hankel @ lead.T @ lead
    means = [np.mean(low[::-1].diagonal(s - len(low) + 1)) for s in range(len(t))]
    assert np.abs(np.array(means) + centre - full[0])[~known[0]].max() < 1e-4
    assert (full[known] == x[known]).all()


def test_a_fill_that_runs_away_is_not_given_out():
    """A long gap between two short noisy stretches: the values stay in the order of the known ones, or the line stays."""
    rng = np.random.default_rng(5)
    x, known = rng.normal(size=(20, 700)), np.zeros((20, 700), bool)
    for r in range(20):
        known[r, : 30 + 4 * r] = known[r, -20:] = True
        x[r] = np.interp(np.arange(700), np.flatnonzero(known[r]), x[r, known[r]])
    values, settled, modelled = grid.imputed(x, known, np.full(20, 700))
    assert modelled.all() and (values[~settled] == x[~settled]).all()
    assert np.abs(values).max() <= grid.RUNAWAY * 1.1 * np.abs(x[known]).max()


def test_rows_of_any_length_side_by_side_equal_each_alone():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 9, 30, 47, 48, 100, 400, 700, 30, 10])
    x, known = np.zeros((len(lengths), 700)), np.zeros((len(lengths), 700), bool)
    for r, n in enumerate(lengths):
        x[r, :n] = np.sin(np.arange(n) / rng.uniform(2, 20)) + rng.normal(size=n) / 5
        known[r, :n] = rng.random(n) < 0.8
        known[r, [0, n - 1]] = True
        x[r, :n] = np.interp(np.arange(n), np.flatnonzero(known[r, :n]), x[r, known[r]])
    x[8, :30], known[9, :9] = 5.0, False
    values, settled, modelled = grid.imputed(x, known, lengths)
    assert modelled.tolist() == [False, True, True, True, True, True, True, True, True, False]
    assert settled[8] and (values[8] == x[8]).all() and (values[9] == x[9]).all()  # no spread; one reading
    for r, n in enumerate(lengths):
        alone, rest, _ = grid.imputed(x[r : r + 1, :n], known[r : r + 1, :n], lengths[r : r + 1])
        assert rest[0] == settled[r]
        assert not rest[0] or np.abs(alone[0] - values[r, :n]).max() < 1e-3
        assert (values[r, :n][known[r, :n]] == x[r, :n][known[r, :n]]).all() and (values[r, n:] == 0).all()


@pytest.mark.parametrize("gap", [5, 60, 300, 600])
def test_series_follows_a_wave_over_gaps_and_blocks(spark, gap):
    """Gaps within a block and over the border of two; the line between the neighbours is far off."""
    n = 4 * grid.BLOCK
    wave = np.sin(2 * np.pi * np.arange(n) / 40) + 3
    held = np.ones(n, bool)
    held[300 : 300 + gap] = held[2 * grid.BLOCK - 30 : 2 * grid.BLOCK - 30 + gap] = False
    starts = np.flatnonzero(held & ~np.concatenate([[False], held[:-1]]))
    ends = np.flatnonzero(held & ~np.concatenate([held[1:], [False]])) + 1
    told = [("A", "Z", "d", int(a) * grid.SECOND, 1.0, wave[a:b].tolist()) for a, b in zip(starts, ends)]
    got = grid.regular_series(spark.createDataFrame(told, READ).repartition(3)).toPandas().sort_values("slot")
    assert len(got) == n and (got.filled.to_numpy() == ~held).all() and set(got.how) == {"read", "imputed"}
    error = np.abs(got.value.to_numpy() - wave)[~held]
    line = np.abs(np.interp(np.arange(n), np.flatnonzero(held), wave[held]) - wave)[~held]
    assert np.sqrt((error**2).mean()) < 0.1 * np.sqrt((line**2).mean())


def test_line_over_a_silent_block_ends_at_the_slots_means(spark):
    """Two rows share the edge slot on each side: means 2 and 6."""
    b = 3 * grid.BLOCK
    at = lambda slot, v: ("A", "Z", "d", slot * grid.SECOND, 1.0, [v])
    told = [at(0, 1.0), at(0, 3.0), at(b, 9.0), at(b, 3.0)]
    df = spark.createDataFrame(told, READ).repartition(4)
    got = {r.slot: r for r in grid.regular_series(df).collect()}
    assert len(got) == b + 1 and all(abs(r.value - (2 + 4 * s / b)) < 1e-9 for s, r in got.items())
    assert {s for s, r in got.items() if r.how == "read"} == {0, b} and {r.how for r in got.values()} == {"read", "line"}
    assert {r.slot for r in grid.regular_series(df, only_filled=True).collect()} == set(got) - {0, b}


def test_a_block_of_many_rows_is_summed_as_it_comes(spark, monkeypatch):
    monkeypatch.setattr(grid, "BLOCKS", 3)
    told = [("A", None, "d", k % 50 * grid.SECOND, 1.0, [float(k)]) for k in range(1, 400) if k % 50 != 7]
    batches = spark.createDataFrame(told, READ).repartition(20)
    got = {r.slot: r.value for r in grid.regular_series(batches).collect()}
    assert all(abs(v - np.mean([k for k in range(1, 400) if k % 50 == s])) < 1e-9 for s, v in got.items() if s != 7) and len(got) == 50
