"""Implausible spikes, stuck values and impossible readings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.functions.arrays import first_of_source, flat, pieces, place_in_row
from wavetide.session import durable

#: Largest value of a 24-bit digitizer.
LARGEST = 8_388_607.0
#: A spike stands so many usual steps from both neighbours and lasts so many samples at most.
STEPS, LONGEST = 30.0, 3
#: A run of so many equal samples is stuck.
STUCK = 20
#: Variances of the level's step and of the noise, in usual steps squared, and the innovations (in standard deviations)
#: that are flagged. With these no spike escapes the filter: after an accepted sample the state lies within
#: 0.23 * THRESHOLD usual steps of it and an innovation's deviation is at most 1.23 steps, and 30 > 1.46 * THRESHOLD.
STEP_VAR, NOISE_VAR, THRESHOLD = 1.0, 0.25, 8.0
#: Innovations that vanish over so many samples (largest square, in usual steps squared) mark a stuck source. After at most
#: LONGEST withheld samples and 8 accepted ones the state has met an unchanging value, so 20 equal samples always show.
VANISH_OVER, VANISH = 8, 1e-6
#: Samples of one segment of the filter and of the run-up before it.
SEGMENT, RUN_UP = 2048, 16
SAMPLES = 1_000_000
SOURCE = ("station", "channel", "date")

IMPOSSIBLE, FROZEN, SPIKE = 1, 2, 4


def step_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Absolute differences of neighbouring finite samples and how often they occur, combined per batch: one row per
    source and quarter octave, with lists."""
    for whole in batches:
        for batch in pieces(whole, "data", SAMPLES):
            values, lengths = flat(batch.column("data"))
            row, _, _ = place_in_row(lengths)
            if len(values) < 2:
                continue
            with np.errstate(invalid="ignore", over="ignore"):
                step = np.abs(np.diff(values))
            ok = (np.diff(row) == 0) & np.isfinite(step)
            step, of = step[ok], first_of_source(batch, SOURCE)[row[1:][ok]]
            if not len(step):
                continue
            order = np.lexsort((step, of))
            step, of = step[order], of[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(step) != 0) | (np.diff(of) != 0)]))
            n, step, of = np.diff(np.append(first, len(step))), step[first], of[first]
            octave = np.where(step > 0, np.floor(np.log2(np.where(step > 0, step, 1.0)) * 4), -10_000).astype(np.int32)
            begin = np.flatnonzero(np.concatenate([[True], (np.diff(octave) != 0) | (np.diff(of) != 0)]))
            ends = pa.array(np.append(begin, len(step)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (step, n)]
            take = pa.array(of[begin])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in SOURCE), pa.array(octave[begin]), *lists], [*SOURCE, "octave", "steps", "ns"])


def usual_steps(traces: DataFrame) -> DataFrame:
    """station, channel, date, usual_step: exact median of the absolute differences of neighbouring finite samples.

    Counts per source and value are combined in the tasks that read the samples and shuffled once, by source and quarter
    octave, of which a source has a bounded number. The median is then found in two levels: the quarter octave that holds
    it, on one row each, then the value among those of that quarter octave alone. So a source with a third of all samples is
    spread over its octaves. Of an even number the mean of both middle values.
    """
    counts = traces.select(*SOURCE, "data").mapInArrow(step_counts, "station string, channel string, date string, octave int not null, steps array<double>, ns array<long>")
    # a struct of the three parts is equal also where a part is null
    counts = counts.select(F.struct(*SOURCE).alias("src"), "octave", "steps", "ns").repartition("src", "octave")
    upto = F.sum("n").over(W.partitionBy("src").orderBy("octave").rowsBetween(W.unboundedPreceding, 0))
    # with both lists in use the shuffle is the same as below and Spark runs it once
    of_row = F.aggregate(F.zip_with("steps", "ns", lambda _, n: n), F.lit(0).cast("long"), lambda a, b: a + b)
    octaves = (
        counts.groupBy("src", "octave").agg(F.sum(of_row).alias("n"))
        .select("src", "octave", (upto - F.col("n")).alias("below"), upto.alias("upto"), F.sum("n").over(W.partitionBy("src")).alias("all"))
        .select("*", F.floor((F.col("all") - 1) / 2).alias("lo"), F.floor(F.col("all") / 2).alias("hi"))
        .filter("(below <= lo and lo < upto) or (below <= hi and hi < upto)")
        .drop("upto", "all")
    )
    within = W.partitionBy("src", "octave").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    middle = (
        counts.join(octaves.hint("shuffle_hash"), ["src", "octave"])
        .select("src", "octave", "below", "lo", "hi", F.explode(F.arrays_zip("steps", "ns")).alias("r"))
        .groupBy("src", "octave", F.col("r.steps").alias("step"))
        .agg(F.sum("r.ns").alias("n"), F.first("below").alias("below"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        .withColumn("upto", F.col("below") + F.sum("n").over(within))
        .withColumn("from", F.col("upto") - F.col("n"))
    )
    at = lambda k: F.max(F.when(F.expr(f"from <= {k} and {k} < upto"), F.col("step")))
    return middle.groupBy("src").agg(((at("lo") + at("hi")) / 2).alias("usual_step")).select("src.*", "usual_step")


def kalman(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Local-level Kalman filter down the columns of ``x`` (samples, series; in usual steps; NaN is missing).

    Returns flags and squared innovations. An innovation beyond THRESHOLD standard deviations, or an infinite sample, is
    flagged and its update withheld; after LONGEST withheld samples in a row the filter starts anew at the next one.
    """
    n, m = x.shape
    flags, square = np.zeros((n, m), bool), np.full((n, m), np.inf)
    level, var, withheld = np.full(m, np.nan), np.full(m, NOISE_VAR), np.zeros(m, np.int64)
    for t in range(n):
        y = x[t]
        seen = ~np.isnan(y)
        var = var + STEP_VAR
        s = var + NOISE_VAR
        anew = np.isfinite(y) & (np.isnan(level) | (withheld >= LONGEST))
        e = np.where(anew, 0.0, y - level)
        out = seen & ~anew & ~(e * e <= THRESHOLD * THRESHOLD * s)
        use = np.isfinite(y) & ~out
        gain = var / s
        level = np.where(use, np.where(anew, y, level + gain * e), level)
        var = np.where(use, np.where(anew, NOISE_VAR, (1 - gain) * var), var)
        withheld = np.where(out, withheld + 1, np.where(use, 0, withheld))
        flags[t], square[t] = out, np.where(use, e * e, np.inf)
    return flags, square


def filter_samples(values: np.ndarray, lengths: np.ndarray, starts: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flagged samples, and samples at which the innovations have vanished, of many traces filtered side by side.

    Traces are cut into segments with a run-up, so that long ones run side by side too.
    """
    n_seg = np.maximum(1, -(-lengths // SEGMENT))
    row = np.repeat(np.arange(len(lengths)), n_seg)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg)
    begin = k * SEGMENT
    lead = np.minimum(begin, RUN_UP + STUCK)
    size = np.minimum(lengths[row] - begin, SEGMENT) + lead
    flags, still = np.zeros(len(values), bool), np.zeros(len(values), bool)
    order = np.argsort(size, kind="stable")
    for at in range(0, len(order), 1024):
        some = order[at : at + 1024]
        deep = int(size[some].max(initial=0))
        if not deep:
            continue
        t = np.arange(deep)[:, None]
        where = starts[row[some]] + begin[some] - lead[some] + t
        there = t < size[some]
        with np.errstate(invalid="ignore", over="ignore"):
            x = np.where(there, values[np.where(there, where, 0)] / scale[row[some]], np.nan)
            f, square = kalman(x)
        quiet = np.zeros(x.shape, bool)
        quiet[VANISH_OVER - 1 :] = _window_max(square)[VANISH_OVER - 1 :] <= VANISH
        own = there & (t >= lead[some])
        flags[where[own]], still[where[own]] = f[own], quiet[own]
    return flags, still


def _window_max(square: np.ndarray) -> np.ndarray:
    out = square.copy()
    for j in range(1, VANISH_OVER):
        out[j:] = np.maximum(out[j:], square[:-j])
    return out


def bad_samples(values: np.ndarray, lengths: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Kinds of each flattened sample (0: none): the filter's candidates, each held against the exact rule."""
    row, i, starts = place_in_row(lengths)
    kinds = np.zeros(len(values), np.int8)
    if not len(values):
        return kinds
    flags, still = filter_samples(values, lengths, starts, np.where(usual > 0, usual, 1.0))
    with np.errstate(invalid="ignore"):
        kinds[np.abs(values) > LARGEST] |= IMPOSSIBLE
    # stuck: whole runs of equal samples in the traces in which innovations vanished
    same = np.zeros(len(values), bool)
    same[1:] = (values[1:] == values[:-1]) & (row[1:] == row[:-1])
    run = np.cumsum(~same) - 1
    long = np.bincount(run) >= STUCK
    kinds[long[run] & np.isin(run, np.unique(run[still]))] |= FROZEN
    # spikes: candidates are the flagged samples and those up to LONGEST + 1 behind one
    near = flags.copy()
    for j in range(1, LONGEST + 2):
        near[j:] |= flags[:-j]
    at = np.flatnonzero(near & (i > 0) & (usual[row] > 0))
    limit = STEPS * usual[row[at]]
    for size in range(1, LONGEST + 1):
        fits = i[at] + size < lengths[row[at]]
        a, most = at[fits], limit[fits]
        before, after = values[a - 1], values[a + size]
        with np.errstate(invalid="ignore", over="ignore"):
            hit = np.abs(before - after) < most
            for j in range(size):
                hit &= (np.abs(values[a + j] - before) > most) & (np.abs(values[a + j] - after) > most)
        for j in range(size):
            kinds[a[hit] + j] |= SPIKE
    return kinds


def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "data", SAMPLES):
            values, lengths = flat(batch.column("data"))
            usual = batch.column("usual_step").to_numpy(zero_copy_only=False).astype(np.float64)
            kinds = bad_samples(values, lengths, np.nan_to_num(usual, nan=0.0))
            row, i, _ = place_in_row(lengths)
            bad = np.flatnonzero(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("trace_id").take(pa.array(row[bad])), pa.array(i[bad].astype(np.int32)), pa.array(kinds[bad].astype(np.int32))], ["trace_id", "sample_idx", "kinds"]
            )


def implausible_samples(traces: DataFrame, broadcast_sources: int = 50_000, steps_of: Callable[[DataFrame], DataFrame] = usual_steps) -> DataFrame:
    """trace_id, sample_idx, kinds (sum of IMPOSSIBLE, FROZEN, SPIKE) of every bad sample.

    ``traces``: trace_id, station, channel, date, data. A source is one station, channel and date; its usual step is the
    median absolute difference of neighbouring finite samples. A local-level Kalman filter, scaled by that step, runs
    over each trace, withholds flagged updates and watches for vanishing innovations; what it points at is held against
    the exact rule. A usual step of 0 (or none) allows no spikes. Rows without station, null and empty data give nothing;
    null channel or date make a source of their own; repeated rows are judged each on their own; further columns are dropped.

    The usual steps, one row per source, are written out once and counted: up to ``broadcast_sources`` they are
    broadcast and the samples are not shuffled; beyond that both sides are joined by a shuffle.
    """
    traces = traces.select("trace_id", *SOURCE, "data").filter("station is not null")
    steps = durable(steps_of(traces)).select(*[F.col(c).alias(f"_{c}") for c in SOURCE], "usual_step")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SOURCE]
    few = steps.count() <= broadcast_sources
    joined = traces.join(F.broadcast(steps) if few else steps, on[0] & on[1] & on[2], "left").select("trace_id", "usual_step", "data")
    return joined.mapInArrow(judge, "trace_id long, sample_idx int, kinds int")
