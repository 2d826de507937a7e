"""Irregular readings onto a regular grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.functions.arrays import first_of_source, flat, pieces, place_in_row

SECOND = 1_000_000
#: Slots of one block; gaps are imputed block by block, so no task holds a whole series. Each block also sees so many slots on both sides.
BLOCK, CONTEXT = 1024, 64
WIDTH = BLOCK + 2 * CONTEXT
#: Length of the embedded windows, components kept, and the movement (in standard deviations) still to come at which it ends.
WINDOW, RANK, CHANGE = 24, 3, 1e-4
#: Rounds at most with one number of components, and how many times the largest known deviation a filled value may reach;
#: beyond either the block is tried with fewer components, and without rest even with one keeps its line as unsettled.
ROUNDS, RUNAWAY = 300, 10.0
SOURCE = ("station", "channel", "date")
#: Samples handled at a time within a task.
SAMPLES = 2_000_000
#: Blocks, and embedded windows, that are imputed side by side.
BLOCKS, SIDE_BY_SIDE = 512, 40_000
SUMS = "station string, channel string, date string, block long not null, slots array<smallint>, totals array<double>, ns array<int>, ends array<struct<slot:long,total:double,n:long>>"
SERIES = "station string, channel string, date string, slot long, value double, filled boolean, how string"
READ, IMPUTED, UNSETTLED, LINE = "read", "imputed", "unsettled", "line"


def slot_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable readings summed per source and second, as one row per source and block with a list of its seconds (from the
    block's first), those of the neighbouring blocks that it sees included; ``ends``: the first and last of its own."""
    for whole in batches:
        for batch in pieces(whole, "data", SAMPLES):
            values, lengths = flat(batch.column("data"))
            row, i, _ = place_in_row(lengths)
            start = batch.column("start_us").to_numpy(zero_copy_only=False)
            rate = batch.column("rate").to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                offset = np.floor(i * 1e6 / rate[row])
            ok = np.isfinite(values) & (offset < 9e15)
            row, values = row[ok], values[ok]
            slot = (start[row] + offset[ok].astype(np.int64)) // SECOND
            if not len(slot):
                continue
            which = first_of_source(batch, SOURCE)[row]
            if (np.diff(which) < 0).any() or ((np.diff(slot) < 0) & (np.diff(which) == 0)).any():
                order = np.lexsort((slot, which))
                which, slot, values = which[order], slot[order], values[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(slot) != 0) | (np.diff(which) != 0)]))
            total, n = np.add.reduceat(values, first), np.diff(np.append(first, len(slot)))
            which, slot = which[first], slot[first]
            own, place = slot // BLOCK, slot % BLOCK
            early, late = place < CONTEXT, place >= BLOCK - CONTEXT
            block, at = np.concatenate([own, own[early] - 1, own[late] + 1]), np.concatenate([np.arange(len(own)), np.flatnonzero(early), np.flatnonzero(late)])
            order = np.lexsort((at, block, which[at]))
            block, at = block[order], at[order]
            begin = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 0) | (np.diff(which[at]) != 0)]))
            offsets = pa.array(np.append(begin, len(at)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((slot[at] - block * BLOCK).astype(np.int16), total[at], n[at].astype(np.int32))]
            inner = np.flatnonzero(own[at] == block)
            run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(at))))[inner]
            edge = np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))
            edges = np.stack([inner[edge], inner[np.append(edge[1:], len(inner)) - 1]], 1).ravel() if len(inner) else inner
            has = np.zeros(len(begin), np.int32)
            has[run[edge]] = 2
            ends = pa.StructArray.from_arrays([pa.array(slot[at[edges]]), pa.array(total[at[edges]]), pa.array(n[at[edges]].astype(np.int64))], ["slot", "total", "n"])
            ends = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has)]).astype(np.int32)), ends)
            source = pa.array(which[at[begin]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(source) for c in SOURCE), pa.array(block[begin]), *lists, ends], [*SOURCE, "block", "slots", "totals", "ns", "ends"])


def impute(x: np.ndarray, known: np.ndarray, length: np.ndarray | None = None, window: int = WINDOW, rank: int = RANK, rounds: int = ROUNDS, change: float = CHANGE) -> np.ndarray:
    """The values of ``imputed``."""
    return imputed(x, known, np.full(len(x), x.shape[1]) if length is None else length, window, rank, rounds, change)[0]


def imputed(x: np.ndarray, known: np.ndarray, length: np.ndarray, window: int = WINDOW, rank: int = RANK, rounds: int = ROUNDS, change: float = CHANGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Iterative singular-spectrum imputation of each row of ``x`` (its first ``length`` slots; ``known`` marks what stays as
    it is): values, whether the row came to rest, whether it has a model at all.

    ``x`` holds a first guess at the unknown places. Each round embeds the series in a Hankel matrix of windows and keeps
    its ``rank`` leading singular vectors. Replacing the unknown places by the averaged anti-diagonals of the projection,
    again and again, comes to rest where they equal those averages; with the vectors held, that is a linear system, so
    each round solves it instead of creeping there. A row ends once what is still to come, judged by its last two moves, is
    at most ``change`` standard deviations. Where a gap weighs too much against what is known, its values grow without end:
    such a row is tried with fewer vectors, and keeps the guess if it comes to rest with none. Windows are half the row long where it is short. There is no model with fewer
    than two known slots, or windows no longer than ``rank``; without spread the guess stays and counts as at rest.
    """
    inside = np.arange(x.shape[1]) < length[:, None]
    known = known & inside
    held = known.sum(1)
    centre = (np.where(known, x, 0).sum(1) / np.maximum(held, 1))[:, None]
    spread = np.sqrt(np.where(known, (x - centre) ** 2, 0).sum(1) / np.maximum(held, 1))[:, None]
    size = np.minimum(window, length // 2)
    modelled = (held >= 2) & (size > rank)
    todo = modelled & (held < length) & (spread[:, 0] > 0)
    settled = ~todo
    y = np.where(inside & todo[:, None], (x - centre) / np.where(spread > 0, spread, 1), 0)
    guess = y.copy()
    for w in np.unique(size[todo]).tolist():
        for kept in range(rank, 0, -1):
            rows = np.flatnonzero(todo & (size == w) & ~settled)
            unknown = inside[rows] & ~known[rows]
            so_far = np.concatenate([np.zeros((len(rows), 1), np.int64), np.cumsum(unknown, 1)], 1)
            open_windows = (so_far[:, w:] > so_far[:, :-w]) & (np.arange(x.shape[1] - w + 1) <= (length[rows] - w)[:, None])
            n = open_windows.sum(1)
            order = np.argsort(n, kind="stable")
            a = 0
            while a < len(order):  # rows with about as many open windows go side by side
                b = a + 1
                while b < len(order) and n[order[b]] <= 1.3 * n[order[a]] + 40 and (b - a) * n[order[b]] <= SIDE_BY_SIDE:
                    b += 1
                part, a = order[a:b], b
                y[rows[part]], settled[rows[part]] = _at_rest(guess[rows[part]], unknown[part], open_windows[part], length[rows[part]], w, kept, rounds, change)
    return np.where((todo & settled)[:, None] & inside & ~known, y * spread + centre, x), settled, modelled


def _at_rest(y: np.ndarray, unknown: np.ndarray, open_windows: np.ndarray, length: np.ndarray, w: int, rank: int, rounds: int, change: float) -> tuple[np.ndarray, np.ndarray]:
    """``imputed`` for rows of mean 0 and spread 1 with windows of ``w``. Only windows that hold unknown slots (by their
    starts, ``open_windows``) change, so the others' share of the covariance is summed once."""
    r, n = y.shape
    out, settled = y.copy(), np.zeros(r, bool)
    y = np.concatenate([y, np.zeros((r, w))], 1)  # what lists are filled up with points to the zeros behind
    starts, gaps = _listed(open_windows, n, 1), _listed(unknown, n, 0)
    gaps = np.concatenate([gaps, np.full((r, -gaps.shape[1] % w), n)], 1)
    place = np.full((r, n + 1), starts.shape[1] - 1)
    np.put_along_axis(place, starts, np.broadcast_to(np.arange(starts.shape[1]), starts.shape), 1)
    place[:, n] = starts.shape[1] - 1
    inner = np.arange(w)
    begin = gaps[:, :, None] - inner
    holder = place[np.arange(r)[:, None, None], np.where((begin >= 0) & (gaps[:, :, None] < n), begin, n)]
    rows = np.arange(r)[:, None, None]
    hankel = y[rows, starts[:, :, None] + inner]
    fixed = _covariance(y[:, :n], length, w) - hankel.transpose(0, 2, 1) @ hankel
    most = RUNAWAY * np.abs(y).max(1)
    alive, before, last = np.arange(r), None, np.full(r, np.inf)
    for k in range(rounds):
        rows = np.arange(len(y))[:, None, None]
        hankel = y[rows, starts[:, :, None] + inner]
        covariance = fixed + hankel.transpose(0, 2, 1) @ hankel
        if k < 2 or k % 5 == 0:
            lead = np.linalg.eigh(covariance)[1][:, :, -rank:]
        else:  # from the last round's vectors two steps towards the leading ones
            lead = np.linalg.qr(covariance @ np.linalg.qr(covariance @ lead)[0])[0]
        rest = hankel - (hankel @ lead) @ lead.transpose(0, 2, 1)
        slope = rest[rows, holder, inner].sum(2)
        if k < 3 or k & (k - 1) == 0:  # the system changes less and less
            system = _factors(np.eye(w) - lead @ lead.transpose(0, 2, 1), gaps, n, length)
        x = y[rows[:, :, 0], gaps]
        step = -_solution(*system, slope)
        aim = x + step
        if before is not None:  # a slow movement in one direction is taken in one go
            turn = step - before[1]
            share = np.clip((turn * step).sum(1) / np.maximum((turn * turn).sum(1), 1e-300), -20, 0.5)[:, None]
            aim -= share * (x - before[0] + turn)
        before = (x, step)
        y[rows[:, :, 0], gaps] = aim
        moved = np.abs(step).max(1)
        speed = np.minimum(moved / last, 0.99)
        last = moved
        done = moved * np.maximum(1, speed / (1 - speed)) <= (change if k > 1 else change / 100)
        away = np.abs(aim).max(1) > most
        settled[alive[done & ~away]] = True
        done |= away
        if done.all() or k == rounds - 1:
            out[alive] = y[:, :n]
            break
        if 4 * done.sum() >= len(done):
            out[alive[done]] = y[done, :n]
            go = ~done
            alive, y, starts, gaps, holder, fixed, lead, last, length, most = (z[go] for z in (alive, y, starts, gaps, holder, fixed, lead, last, length, most))
            before, system = tuple(z[go] for z in before), tuple(z[go] for z in system)
    return out, settled


def _listed(marks: np.ndarray, fill: int, more: int) -> np.ndarray:
    """Places of the marks of each row, side by side, filled up with ``fill`` and with ``more`` of it."""
    row, at = np.nonzero(marks)
    n = marks.sum(1)
    out = np.full((len(marks), int(n.max(initial=0)) + more), fill)
    out[row, np.arange(len(row)) - (np.cumsum(n) - n)[row]] = at
    return out


def _covariance(y: np.ndarray, length: np.ndarray, w: int) -> np.ndarray:
    """Sums of the products of all windows' entries, by running sums of the products at each distance."""
    r, n = y.shape
    out = np.zeros((r, w, w))
    rows, windows = np.arange(r)[:, None], (length - w + 1)[:, None]
    for d in range(w):
        sums = np.zeros((r, n - d + 1))
        np.cumsum(y[:, : n - d] * y[:, d:], 1, out=sums[:, 1:])
        i = np.arange(w - d)
        out[:, i, i + d] = out[:, i + d, i] = sums[rows, i + windows] - sums[:, i]
    return out


def _factors(rest: np.ndarray, gaps: np.ndarray, n: int, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block elimination of the system of the unknown slots ``gaps`` (places from ``n`` on stand for none), in blocks as wide
    as its band. The entry of two slots sums the entries of ``rest`` (a window's projector) over the windows that hold both."""
    r, w, _ = rest.shape
    sums = np.zeros((r, w, w + 1))
    for d in range(w):
        sums[:, d, 1 : w - d + 1] = np.cumsum(np.diagonal(rest, d, 1, 2), 1)
    apart = np.where(gaps < n, gaps, n + 2 * w * np.arange(1, gaps.shape[1] + 1)).reshape(r, -1, w)
    row, final = np.arange(r)[:, None, None, None], (length - w)[:, None, None, None]

    def entries(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        p, q = p[..., :, None], q[..., None, :]
        low, d = np.minimum(p, q), np.abs(p - q)
        near = (d < w) & (low < n)
        low, d = np.where(near, low, 0), np.where(near, d, 0)
        upto, since = low - np.maximum(0, low + d - w + 1), low - np.minimum(low, final)
        return np.where(near, sums[row, d, upto + 1] - sums[row, d, since], 0.0)

    main, upper = entries(apart, apart), entries(apart[:, :-1], apart[:, 1:])
    i = np.arange(w)
    main[..., i, i] += np.where(apart < n, 1e-12 * w, 1.0)
    inverse, carry = np.empty_like(main), np.empty_like(upper)
    for k in range(main.shape[1]):
        d = main[:, k] - upper[:, k - 1].transpose(0, 2, 1) @ carry[:, k - 1] if k else main[:, k]
        inverse[:, k] = np.linalg.inv(d)
        if k < upper.shape[1]:
            carry[:, k] = inverse[:, k] @ upper[:, k]
    return inverse, carry


def _solution(inverse: np.ndarray, carry: np.ndarray, right: np.ndarray) -> np.ndarray:
    b = right.reshape(len(right), -1, inverse.shape[-1], 1).copy()
    for k in range(1, b.shape[1]):
        b[:, k] -= carry[:, k - 1].transpose(0, 2, 1) @ b[:, k - 1]
    b = inverse @ b
    for k in range(b.shape[1] - 2, -1, -1):
        b[:, k] -= carry[:, k] @ b[:, k + 1]
    return b.reshape(len(right), -1)


def fill_blocks(batches: Iterator[pa.RecordBatch], only_filled: bool = False) -> Iterator[pa.RecordBatch]:
    """Each block's slots with a value each: known ones as read, the others imputed and marked. The rows of a block follow one
    another; their sums are added up as they come, so a block with any number of rows needs the room of one."""
    kept = None
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCKS):
            got = _added(whole.slice(at, BLOCKS))
            if kept is not None:
                if all(kept[0].column(c).equals(got[0].column(c).slice(0, 1)) for c in (*SOURCE, "block")):
                    got[1][0] += kept[1][0]
                    got[2][0] += kept[2][0]
                else:
                    yield _filled(*kept, only_filled)
            n = got[0].num_rows - 1
            kept = (got[0].slice(n), got[1][n:].copy(), got[2][n:].copy())
            if n:
                yield _filled(got[0].slice(0, n), got[1][:n], got[2][:n], only_filled)
    if kept is not None:
        yield _filled(*kept, only_filled)


def _added(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """The first row of each run of rows of one block; totals and numbers of readings of its slots."""
    code = first_of_source(batch, SOURCE)
    block = batch.column("block").to_numpy(zero_copy_only=False)
    new = np.concatenate([[True], (np.diff(code) != 0) | (np.diff(block) != 0)])
    run, first = np.cumsum(new) - 1, np.flatnonzero(new)
    totals, lengths = flat(batch.column("totals"))
    row, _, _ = place_in_row(lengths)
    place = run[row] * WIDTH + batch.column("slots").flatten().to_numpy(zero_copy_only=False).astype(np.int64) + CONTEXT
    ns = batch.column("ns").flatten().to_numpy(zero_copy_only=False)
    sums = [np.bincount(place, weights=v, minlength=len(first) * WIDTH).reshape(-1, WIDTH) for v in (totals, ns)]
    return batch.take(pa.array(first)), *sums


def _filled(batch: pa.RecordBatch, totals: np.ndarray, ns: np.ndarray, only_filled: bool) -> pa.RecordBatch:
    number = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
    base = batch.column("block").to_numpy(zero_copy_only=False).astype(np.int64) * BLOCK
    known = ns > 0
    x = totals / np.maximum(ns, 1)
    before, after = (number(c) - base + CONTEXT for c in ("prev_slot", "next_slot"))
    before_x, after_x = number("prev_mean"), number("next_mean")
    own = slice(CONTEXT, CONTEXT + BLOCK)
    place = np.arange(WIDTH)
    # from the source's first reading, or the first that the block sees, to the last
    starts_here, ends_here = np.isnan(before), np.isnan(after)
    seen = known.any(1)
    lo = np.where(seen, known.argmax(1), CONTEXT)
    hi = np.where(seen, WIDTH - 1 - known[:, ::-1].argmax(1), CONTEXT + BLOCK - 1)
    lo, hi = np.where(starts_here, lo, np.minimum(lo, CONTEXT)), np.where(ends_here, hi, np.maximum(hi, CONTEXT + BLOCK - 1))
    inside = (place >= lo[:, None]) & (place <= hi[:, None])
    full = x.copy()
    how = np.where(known, 0, 3).astype(np.int8)
    open_ = np.flatnonzero((inside & ~known)[:, own].any(1))
    guess = np.zeros((len(open_), WIDTH))
    there = np.zeros(guess.shape, bool)
    for k, r in enumerate(open_.tolist()):
        at, mine = place[known[r]].astype(np.float64), x[r, known[r]]
        if not starts_here[r] and not (len(at) and at[0] <= before[r]):
            at, mine = np.append(before[r], at), np.append(before_x[r], mine)
        if not ends_here[r] and not at[-1] >= after[r]:
            at, mine = np.append(at, after[r]), np.append(mine, after_x[r])
        n = hi[r] - lo[r] + 1
        guess[k, :n] = np.interp(place[lo[r] : hi[r] + 1], at, mine)
        there[k, :n] = known[r, lo[r] : hi[r] + 1]
    if len(open_):
        values, settled, modelled = imputed(guess, there, (hi - lo + 1)[open_])
        for k, r in enumerate(open_.tolist()):
            full[r, lo[r] : hi[r] + 1] = values[k, : hi[r] - lo[r] + 1]
        how[open_] = np.where(known[open_], 0, np.where(~modelled, 3, np.where(settled, 1, 2))[:, None])
    row, slot = np.nonzero((inside & ~known if only_filled else inside)[:, own])
    source, slot = pa.array(row), slot + CONTEXT
    names = pa.DictionaryArray.from_arrays(pa.array(how[row, slot]), pa.array([READ, IMPUTED, UNSETTLED, LINE])).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c).take(source) for c in SOURCE), pa.array(base[row] + slot - CONTEXT), pa.array(full[row, slot]), pa.array(~known[row, slot]), names],
        [*SOURCE, "slot", "value", "filled", "how"],
    )


def regular_series(readings: DataFrame, only_filled: bool = False) -> DataFrame:
    """station, channel, date, slot, value, filled, how: one row per whole second from each source's first to its last
    reading, or only those without reading (``only_filled``).

    ``readings``: station, channel, date, start_us, rate, data; sample i is read at start_us + i / rate seconds. A source
    is one station, channel and date. A slot with readings holds their mean (how: read); one without is ``filled`` by
    iterative singular-spectrum imputation of its block (``imputed``, with CONTEXT slots on each side of BLOCK), which starts
    from the line between the neighbouring readings. How it came about is told: ``imputed`` if the iteration came to rest,
    ``unsettled`` if it did not (``imputed``) and the line stays, ``line`` where no model can be had and the line stays: in
    blocks that see fewer than two readings, so most of those inside a gap of more than BLOCK seconds.

    A null, NaN or infinite sample, and a row without station, start or positive rate, gives no reading; null channel or
    date make a source of their own; repeated and overlapping rows enter the same slots; a source without readings, and
    an empty table, give no rows; further columns are dropped. A time past the range of timestamps is no reading.

    Readings are summed per second in the tasks that read them; what is left is shuffled once, as lists, to blocks, so a
    source of any length is spread. Only one row per block runs through the window that finds the readings before and after it.
    """
    src = F.struct(*SOURCE)  # equal also where a part is null
    key = ["src", "block"]
    usable = readings.filter("station is not null and start_us is not null and rate > 0 and not isnan(rate)").select(*SOURCE, "start_us", F.col("rate").cast("double").alias("rate"), "data")
    sums = usable.mapInArrow(slot_sums, SUMS).select(src.alias("src"), "block", "slots", "totals", "ns", "ends").repartition(*key)
    # the first slot of a block is the first of every list that holds it, and the last one the last
    # (the lists are looked at only so that this asks for the same columns as the last step: one shuffle then serves both)
    lists = (F.size("slots") + F.size("totals") + F.size("ns")).alias("lists")
    means = sums.select(*key, lists, F.explode_outer("ends").alias("e")).groupBy(*key, F.col("e.slot").alias("slot")).agg((F.sum("e.total") / F.sum("e.n")).alias("mean"), F.max("lists").alias("lists")).filter("lists > 0 and slot is not null")
    end = F.struct("slot", "mean")
    ends = means.groupBy(*key).agg(F.min_by(end, "slot").alias("first"), F.max_by(end, "slot").alias("last"))
    along = W.partitionBy("src").orderBy("block")
    ends = ends.withColumns({"prev": F.lag("last").over(along), "next": F.lead("first").over(along)})
    following = F.coalesce(F.floor(F.col("next.slot") / F.lit(BLOCK)), F.col("block") + 1)
    # every block up to the next one read; those behind the first are silent: they follow on its last reading
    spread = ends.select("src", "last", "prev", "next", F.col("block").alias("_own"), F.explode(F.sequence("block", following - 1)).alias("block"))
    prev = F.when(F.col("block") == F.col("_own"), F.col("prev")).otherwise(F.col("last"))
    frames = spread.select(*key, prev.alias("prev"), "next").select(*key, *[F.col(f"{x}.{y}").alias(f"{x}_{y}") for x in ("prev", "next") for y in ("slot", "mean")])
    read = frames.join(sums.hint("merge"), key, "left").sortWithinPartitions(*key)
    return read.select("src.*", *[c for c in read.columns if c != "src"]).mapInArrow(lambda batches: fill_blocks(batches, only_filled), SERIES)
