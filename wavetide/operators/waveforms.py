"""Cutting windows from traces and correlating pairs of windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.config import Config, PhaseSpec
from wavetide.functions import kernels as K
from wavetide.functions.arrays import flat
from wavetide.operators.merge import micro_units, well_observed
from wavetide.session import durable

HOUR_US = 3_600_000_000
#: Samples beyond a window that its spline may use.
PAD = 8
#: Stretches that are filtered, and pairs of windows that are correlated, at a time.
TOGETHER, SIDE_BY_SIDE = 64, 256
#: Events of a tile; a task holds the windows of two tiles at one station (22 MB at the default windows).
TILE = 128


def clean_traces(traces: DataFrame) -> DataFrame:
    """station, channel, trace_id, start_us, rate, data: each trace without mean and trend, tapered, non-finite samples 0.

    Traces with a null start, no samples, or a rate that is not within 0.001 and 1,000,000 a second are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, lengths = flat(batch.column("data"))
            rate = batch.column("rate").to_numpy(zero_copy_only=False)
            out = [K.tapered(K.detrended(K.finite_or_zero(x)[None]), r)[0] for x, r in zip(np.split(values, np.cumsum(lengths)[:-1]), rate)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(np.concatenate(out).astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("station", "channel", "trace_id", "start_us", "rate")), lists], ["station", "channel", "trace_id", "start_us", "rate", "data"])

    usable = traces.filter("station is not null and start_us is not null and rate >= 0.001 and rate < 1e6 and size(data) > 0")
    return usable.select("station", "channel", "trace_id", "start_us", F.col("rate").cast("double").alias("rate"), "data").mapInArrow(
        run, "station string, channel string, trace_id long, start_us long, rate double, data array<float>"
    )


def station_days(traces: DataFrame) -> DataFrame:
    """``traces`` (station, day, channel, trace_id, start_us, rate, data) of the stations and days that have exactly three, one
    a channel and all at one rate, cut to the stretch that all three share; others are left out.

    The stretch begins at the latest start and ends at the earliest end, each trace at its sample nearest to them; all have
    the first trace's (by channel) start then and the fewest samples of the three. Rows without station, day, channel,
    start, a positive rate or samples count for none; three traces without a common stretch give nothing.
    """
    usable = traces.filter("station is not null and day is not null and channel is not null and start_us is not null and rate > 0 and not isnan(rate) and size(data) > 0")
    end = F.col("start_us") + (F.size("data") - 1) / F.col("rate") * 1e6
    shared = usable.groupBy("station", "day").agg(
        F.count(F.lit(1)).alias("_n"), F.count_distinct("channel").alias("_channels"), F.min("rate").alias("_slow"), F.max("rate").alias("_fast"), F.max("start_us").alias("_from"), F.min(end).alias("_to")
    )
    shared = shared.filter("_n = 3 and _channels = 3 and _slow = _fast and _from <= _to").select("station", "day", "_from", "_to")
    told = usable.select("station", "day", "channel", "trace_id", "start_us", "rate", "data").join(shared, ["station", "day"])
    skip = F.rint((F.col("_from") - F.col("start_us")) / 1e6 * F.col("rate")).cast("int")
    keep = F.rint((F.col("_to") - F.col("_from")) / 1e6 * F.col("rate")).cast("int") + 1
    three = W.partitionBy("station", "day")
    told = told.withColumn("_skip", skip).withColumn("_keep", F.min(F.least(keep, F.size("data") - skip)).over(three)).filter("_keep > 0")
    first = F.min_by(F.col("start_us") + (F.col("_skip") / F.col("rate") * 1e6).cast("long"), "channel").over(three)
    return told.withColumn("start_us", first).select("station", "day", "channel", "trace_id", "start_us", "rate", F.slice("data", F.col("_skip") + 1, F.col("_keep")).alias("data"))


def resampled(traces: DataFrame, rate: float) -> DataFrame:
    """``traces`` (as of ``clean_traces``) at ``rate`` samples a second, by a cubic spline; those that have it stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, lengths = flat(batch.column("data"))
            own = batch.column("rate").to_numpy(zero_copy_only=False)
            out = []
            for x, r in zip(np.split(values, np.cumsum(lengths)[:-1]), own):
                at = np.arange(int((len(x) - 1) / r * rate + 1e-9) + 1) * (r / rate) if len(x) else np.zeros(0)
                out.append(x if r == rate or not len(x) else K.interpolated(x[None], np.minimum(at, len(x) - 1))[0])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*out, np.zeros(0)]).astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("station", "channel", "trace_id", "start_us")), pa.array(np.full(len(out), rate)), lists], ["station", "channel", "trace_id", "start_us", "rate", "data"])

    return traces.select("station", "channel", "trace_id", "start_us", "rate", "data").mapInArrow(run, "station string, channel string, trace_id long, start_us long, rate double, data array<float>")


def hour_pieces(traces: DataFrame, before_s: float, after_s: float) -> DataFrame:
    """``traces`` cut by the hours (since 1970) that they touch: hour, piece, skipped (samples before the piece), npts (of
    the trace) in place of data. A piece reaches ``before_s`` and ``after_s`` seconds beyond its hour, as far as the trace goes."""
    hour = lambda t: F.floor(t / F.lit(HOUR_US))
    last = F.col("start_us") + ((F.col("npts") - 1) / F.col("rate") * 1e6).cast("long")
    sample = lambda t: (t - F.col("start_us")) / 1e6 * F.col("rate")
    skipped = F.greatest(F.floor(sample(F.col("hour") * HOUR_US - int(before_s * 1e6))) - PAD, F.lit(0)).cast("int")
    upto = F.least(F.ceil(sample((F.col("hour") + 1) * HOUR_US + int(after_s * 1e6))) + PAD, F.col("npts")).cast("int")
    spread = traces.withColumn("npts", F.size("data")).withColumn("hour", F.explode(F.sequence(hour(F.col("start_us")), hour(last))))
    kept = [c for c in traces.columns if c != "data"]
    return spread.select(*kept, "npts", "hour", skipped.alias("skipped"), F.slice("data", skipped + 1, F.greatest(upto - skipped, F.lit(0))).alias("piece"))


def cut_windows(requests: DataFrame, traces: DataFrame, config: Config) -> DataFrame:
    """station, channel, evid, phase, t_rel, window: the windows of all picks that lie wholly within a trace.

    ``requests``: evid, station, ot_us, tp_us, ts_us; ``traces`` as of ``clean_traces``. Each window is resampled to
    ``samp_rate`` by a cubic spline where the trace's rate differs, run through the band-pass with up to ``warm_up_s`` seconds
    before it, and cropped. Of several traces of one channel that hold a window the one with the smallest trace_id is taken.
    Requests without a time or station give nothing.

    Traces are cut into hours, each with the samples around it that its windows need, and the requests of a station are
    listed by hour. Both meet in one equi-join, so samples are shuffled once, in pieces of bounded size, whatever the
    number of picks; a list holds an hour's picks of one station at most.
    """
    specs = config.phases()
    wanted = requests.select(
        "evid", "station", "ot_us",
        F.explode(F.array(*[F.struct(F.lit(p).alias("phase"), F.col(f"t{p.lower()}_us").alias("at"), F.lit(int(s.before_s * 1e6)).alias("before"), F.lit(int(s.after_s * 1e6)).alias("after")) for p, s in specs.items()])).alias("r"),
    ).select("evid", "station", "ot_us", "r.*").filter("at is not null and ot_us is not null")
    begin = (F.col("at") - F.col("before")).alias("begin")
    ask = F.struct("evid", "phase", ((F.col("at") - F.col("ot_us")) / 1e6).cast("float").alias("t_rel"), begin, (F.col("at") + F.col("after")).alias("end"))
    asked = wanted.groupBy("station", F.floor(begin / F.lit(HOUR_US)).alias("hour")).agg(F.collect_list(ask).alias("asks"))
    after = max(s.before_s + s.after_s for s in specs.values())
    held = hour_pieces(traces, config.warm_up_s, after).join(asked, ["station", "hour"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sos = K.butterworth(config.samp_rate, *config.freq_band)
        for batch in batches:
            row, ask, windows = _cut(batch, specs, config, sos)
            told, of = batch.column("asks").flatten(), pa.array(row)
            cols = [*(batch.column(c).take(of) for c in ("station", "channel", "trace_id")), *(told.field(c).take(pa.array(ask)) for c in ("evid", "phase", "t_rel"))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(windows, pa.list_(pa.float32()))], ["station", "channel", "trace_id", "evid", "phase", "t_rel", "window"])

    cut = held.select("station", "channel", "trace_id", "start_us", "rate", "npts", "skipped", "piece", "asks").mapInArrow(
        run, "station string, channel string, trace_id long, evid string, phase string, t_rel float, window array<float>"
    )
    return cut.groupBy("station", "channel", "evid", "phase").agg(F.min_by(F.struct("t_rel", "window"), "trace_id").alias("w")).select("station", "channel", "evid", "phase", "w.*")


def _cut(batch: pa.RecordBatch, specs: dict[str, PhaseSpec], config: Config, sos: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the asks of a batch that their traces can answer: row, place among all asks, window. Equally long stretches are
    filtered together."""
    number = lambda x: x.to_numpy(zero_copy_only=False)
    values, lengths = flat(batch.column("piece"))
    at_row = np.cumsum(lengths) - lengths
    asks = batch.column("asks")
    row = np.repeat(np.arange(batch.num_rows), number(asks.value_lengths()))
    told = asks.flatten()
    begin, end = number(told.field("begin")), number(told.field("end"))
    size = np.array([specs[p].data_npts for p in told.field("phase").to_pylist()], np.int64)
    start, rate, npts, skipped = (number(batch.column(c))[row] for c in ("start_us", "rate", "npts", "skipped"))
    last = start + ((npts - 1) / rate * 1e6).astype(np.int64)
    first = np.rint((begin - start) / 1e6 * config.samp_rate).astype(np.int64)
    ratio = rate / config.samp_rate
    ok = (begin >= start) & (end <= last) & ((first + size - 1) * ratio <= npts - 1 + 1e-9)
    warm = np.maximum(0, first - int(config.warm_up_s * config.samp_rate))
    alike: dict[int, list[int]] = {}
    for k in np.flatnonzero(ok).tolist():
        alike.setdefault(int(first[k] + size[k] - warm[k]), []).append(k)
    which, windows = [], []
    for n, some in alike.items():
        for part in (some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)):
            stretch = np.empty((len(part), n))
            for k, out in zip(part, stretch):
                piece = values[at_row[row[k]] : at_row[row[k]] + lengths[row[k]]]
                at = np.arange(warm[k], warm[k] + n) * ratio[k]
                low, high = max(0, int(at[0]) - PAD), min(npts[k], int(np.ceil(at[-1])) + PAD + 1)
                near = piece[low - skipped[k] : high - skipped[k]]
                out[:] = near[warm[k] - low : warm[k] - low + n] if ratio[k] == 1 else K.interpolated(near[None], np.minimum(at - low, len(near) - 1))[0]
            done = K.filtered(stretch, sos).astype(np.float32)
            which += part
            windows += [done[j, n - size[k] :] for j, k in enumerate(part)]
    which = np.array(which, np.int64)
    return row[which], which, windows


#: Last characters of the channel codes of the three components, by number.
COMPONENTS = ("E1X", "N2Y", "Z3")


def event_windows(windows: DataFrame, config: Config) -> DataFrame:
    """station, evid, tp_rel, ts_rel, has_p, has_s, p_data, s_data: one row per station and event with a whole phase.

    A phase is whole if each of its channels has its window: channels are numbered by their codes' last characters
    (``COMPONENTS``) within one instrument (the code without it); of several instruments that have the phase whole the one
    with the smallest code is taken. A missing phase is null with its time at -1.
    """
    letter, instrument = F.right("channel", F.lit(1)), F.expr("left(channel, length(channel) - 1)")
    aggs, found = [], []
    for p, spec in config.phases().items():
        here = F.col("phase") == p
        aggs.append(F.max(F.when(here, F.col("t_rel"))).alias(f"t{p}"))
        aggs += [F.max(F.when(here & letter.isin(*COMPONENTS[k]), F.col("window"))).alias(f"{p}{k}") for k in spec.channels]
        whole = F.lit(True)
        for k in spec.channels:
            whole = whole & F.col(f"{p}{k}").isNotNull()
        got = F.struct(F.col(f"t{p}").alias("t"), F.array(*[f"{p}{k}" for k in spec.channels]).alias("data"))
        found.append(F.min_by(F.when(whole, got), F.when(whole, F.col("instrument"))).alias(p))
    one = windows.filter("channel is not null").groupBy("station", "evid", instrument.alias("instrument")).agg(*aggs).groupBy("station", "evid").agg(*found)
    times = [F.coalesce(f"{p}.t", F.lit(-1.0).cast("float")).alias(f"t{p.lower()}_rel") for p in config.phases()]
    marks = [F.col(p).isNotNull().alias(f"has_{p.lower()}") for p in config.phases()]
    data = [F.col(f"{p}.data").alias(f"{p.lower()}_data") for p in config.phases()]
    return one.select("station", "evid", *times, *marks, *data).filter("has_p or has_s")


def correlate(pairs: DataFrame, data_npts: int, temp_start: int, temp_npts: int, rate: float, shift_s: float, separation_s: float) -> DataFrame:
    """``pairs`` without its windows, with cc, lag, scc, dt: normalised correlation of each pair's two windows.

    ``pairs`` has data_a, data_b (array of channels, each an array of ``data_npts`` floats) and t_a, t_b (float, seconds). The
    template is cut from b. cc is the greatest absolute value (its sign is lost), lag its first place; lag 0 is one sample
    after the start, so equal windows and times give dt = -1 / rate. scc: see ``kernels.peaks``. Windows of another length
    are an error.
    """
    rest = [f for f in pairs.schema.fields if f.name not in ("data_a", "data_b")]
    separation = max(1, int(round(separation_s * rate)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, SIDE_BY_SIDE):
                batch = whole.slice(k, SIDE_BY_SIDE)
                a, b = (_cube(batch.column(c), data_npts) for c in ("data_a", "data_b"))
                t_a, t_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float32) for c in ("t_a", "t_b"))
                out = _aligned(a, b, t_a, t_b, temp_start, temp_npts, rate, shift_s, separation)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *(pa.array(x) for x in out)], [*(f.name for f in rest), "cc", "lag", "scc", "dt"])

    return pairs.mapInArrow(run, f"{fields}, cc double, lag int, scc double, dt float")


def _aligned(a: np.ndarray, b: np.ndarray, t_a: np.ndarray, t_b: np.ndarray, temp_start: int, temp_npts: int, rate: float, shift_s: float, separation: int) -> tuple[np.ndarray, ...]:
    """cc, lag, scc, dt of the windows ``a`` against the templates in ``b``."""
    peak, lag, contrast = K.peaks(K.correlation(a, b[:, :, temp_start : temp_start + temp_npts]), separation)
    dt = t_a + np.float32(shift_s) + (lag / rate).astype(np.float32) - t_b
    return peak, lag.astype(np.int32), contrast, dt.astype(np.float32)


def _cube(lists: pa.ListArray, npts: int) -> np.ndarray:
    inner = lists.flatten()
    values = inner.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(inner) and not (inner.value_lengths().to_numpy() == npts).all():
        raise ValueError(f"a window has not {npts} samples")
    return values.reshape(len(lists), -1, npts) if len(lists) else np.zeros((0, 1, npts))


def passes(dt_limit: float, cc_thres: float | None, scc_thres: float | None) -> Column:
    """Whether |dt| is up to its limit and cc and scc are at or above their thresholds; NaN passes no threshold."""
    keep = F.abs("dt") <= F.lit(dt_limit).cast("float")
    for name, least in (("cc", cc_thres), ("scc", scc_thres)):
        if least is not None:
            keep = keep & ~F.isnan(name) & (F.col(name) >= least)
    return keep


def event_tiles(station_pairs: DataFrame, size: int = TILE) -> DataFrame:
    """evid, tile: events that are partners of the same events mostly lie in one tile; a tile has about ``size`` events.

    An event falls in with the smallest evid among its partners and itself; where many do, they are parted by a hash of
    their evids. A null evid has no tile.
    """
    ends = F.array(F.struct(F.col("evid_a").alias("evid"), F.col("evid_b").alias("other")), F.struct(F.col("evid_b").alias("evid"), F.col("evid_a").alias("other")))
    near = station_pairs.select(F.explode(ends).alias("e")).select("e.*").filter("evid is not null").groupBy("evid").agg(F.min("other").alias("other"))
    near = near.select("evid", F.least("evid", "other").alias("_lead"))
    parts = near.groupBy("_lead").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("_parts"))
    return near.join(parts, "_lead").select("evid", F.xxhash64("_lead", F.pmod(F.xxhash64("evid"), F.col("_parts"))).alias("tile"))


def place_tiles(places: DataFrame, step: float, size: int = TILE) -> DataFrame:
    """evid, tile: events (evid, lat, lon) that lie near one another; a tile has about ``size`` events.

    Tiles are cells of ``step`` degrees; one that holds more is cut into smaller cells by their number, and what still
    holds more, as many events at one place, by a hash of their evids. Events without a number for a place share a cell.
    """
    count = lambda df, *by: df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    cell = lambda c, k: F.coalesce(F.floor(F.nanvl(c, F.lit(None).cast("double")) / F.lit(step) * k), F.lit(-(10**9)))
    cells = places.filter("evid is not null").select("evid", "lat", "lon", cell(F.col("lat"), 1).alias("_y"), cell(F.col("lon"), 1).alias("_x"))
    cells = cells.join(count(cells, "_y", "_x"), ["_y", "_x"]).withColumn("_k", F.ceil(F.sqrt(F.col("_n") / size))).drop("_n")
    cells = cells.select("evid", F.xxhash64("_k", cell(F.col("lat"), F.col("_k")), cell(F.col("lon"), F.col("_k"))).alias("_cell"))
    parts = count(cells, "_cell").select("_cell", F.ceil(F.col("_n") / size).alias("_parts"))
    return cells.join(parts, "_cell").select("evid", F.xxhash64("_cell", F.pmod(F.xxhash64("evid"), F.col("_parts"))).alias("tile"))


def correlated_times(station_pairs: DataFrame, windows: DataFrame, config: Config, tiles: DataFrame | None = None) -> DataFrame:
    """evid_a, evid_b, station, phase, dt_u6, cc_u6 of the station pairs (evid_a, evid_b, station) whose windows agree.

    ``windows`` as of ``event_windows``, one row per station and event. Events are laid in ``tiles`` (evid, tile: one row per
    event, ``place_tiles`` or, by default, ``event_tiles``; an event without one is a tile of its own), and the work of a
    station in pairs of tiles: a window goes once to each pair of tiles in which it is needed, not once to each
    pair of events, and a task holds the windows of one pair of tiles at a time. A station pair is correlated in the phases
    that both its windows have, then the thresholds follow. Repeated station pairs come out as often as they stand; pairs
    with a null, or without a window at one side, and empty tables give nothing; further columns are dropped.
    """
    tiles = event_tiles(station_pairs) if tiles is None else tiles
    side = lambda k: tiles.select(F.col("evid").alias(f"evid_{k}"), F.col("tile").alias(f"_{k}"))
    own = [F.coalesce(f"_{k}", F.xxhash64(f"evid_{k}")) for k in "ab"]
    key = ["station", "tile_a", "tile_b"]
    told = station_pairs.select("evid_a", "evid_b", "station").filter("evid_a is not null and evid_b is not null and station is not null")
    told = told.join(side("a"), "evid_a", "left").join(side("b"), "evid_b", "left").select("evid_a", "evid_b", "station", F.least(*own).alias("tile_a"), F.greatest(*own).alias("tile_b"))
    needed = told.select(*key, F.explode(F.array("evid_a", "evid_b")).alias("evid_a")).distinct()
    fields = ["tp_rel", "ts_rel", "has_p", "has_s", "p_data", "s_data"]
    held = needed.join(windows.select("station", F.col("evid").alias("evid_a"), *fields), ["station", "evid_a"])
    columns = [*key, "evid_a", "evid_b", *fields]
    rows = held.withColumn("evid_b", F.lit(None).cast(station_pairs.schema["evid_b"].dataType)).select(*columns)
    rows = rows.unionByName(told.select(*key, "evid_a", "evid_b"), allowMissingColumns=True).select(*columns)
    rows = rows.repartition(*key).sortWithinPartitions(*key, F.col("evid_b").asc_nulls_first())  # windows go before pairs
    kind = station_pairs.schema["evid_a"].dataType.simpleString()
    obs = rows.mapInArrow(lambda batches: _tiled(batches, config), f"evid_a {kind}, evid_b {kind}, station string, phase string, cc double, scc double, dt float")
    keep = F.lit(False)
    for phase, spec in config.phases().items():
        keep = keep | ((F.col("phase") == phase) & passes(spec.dt_limit, config.cc_thres, config.scc_thres))
    return obs.filter(keep).select("evid_a", "evid_b", "station", "phase", micro_units(F.col("dt").cast("double")).alias("dt_u6"), micro_units(F.col("cc")).alias("cc_u6"))


def _tiled(batches: Iterator[pa.RecordBatch], config: Config) -> Iterator[pa.RecordBatch]:
    """Correlates the pairs of each pair of tiles, whose windows come before them; those of the last one are kept for the next
    batch."""
    number = lambda x: x.to_numpy(zero_copy_only=False)
    kept = None
    for batch in batches:
        if kept is not None:
            batch = pa.concat_batches([kept, batch])
        if not batch.num_rows:
            continue
        parts = [number(batch.column("station").dictionary_encode().indices), number(batch.column("tile_a")), number(batch.column("tile_b"))]
        run = np.cumsum(np.concatenate([[False], np.any([np.diff(x) != 0 for x in parts], axis=0)]))
        window = number(batch.column("evid_b").is_null())
        held, asked = np.flatnonzero(window), np.flatnonzero(~window)
        kept = batch.take(pa.array(held[run[held] == run[-1]]))
        if not len(held) or not len(asked):
            continue
        ends = [batch.column("evid_a"), batch.column("evid_b").take(pa.array(asked))]
        code = number(pa.concat_arrays(ends).dictionary_encode().indices).astype(np.int64)
        many = code.max() + 1
        names = run[held] * many + code[held]
        order = np.argsort(names, kind="stable")
        rows, there = [], np.ones(len(asked), bool)
        for wanted in (run[asked] * many + code[asked], run[asked] * many + code[batch.num_rows :]):
            at = order[np.minimum(np.searchsorted(names[order], wanted), len(order) - 1)]
            there &= names[at] == wanted
            rows.append(held[at])
        for phase, spec in config.phases().items():
            p = phase.lower()
            has, t, data = number(batch.column(f"has_{p}").fill_null(False)), number(batch.column(f"t{p}_rel")).astype(np.float32), batch.column(f"{p}_data")
            able = np.flatnonzero(there & has[rows[0]] & has[rows[1]])
            separation = max(1, int(round(config.peak_separation * config.samp_rate)))
            for k in range(0, len(able), SIDE_BY_SIDE):
                some = able[k : k + SIDE_BY_SIDE]
                a, b = (r[some] for r in rows)
                peak, lag, contrast, dt = _aligned(*(_cube(data.take(pa.array(x)), spec.data_npts) for x in (a, b)), t[a], t[b], spec.temp_start, spec.temp_npts, config.samp_rate, spec.shift_s, separation)
                pair = pa.array(asked[some])
                told = [*(batch.column(c).take(pair) for c in ("evid_a", "evid_b", "station")), pa.array([phase] * len(some), pa.string())]
                yield pa.RecordBatch.from_arrays([*told, *(pa.array(x) for x in (peak, contrast, dt))], ["evid_a", "evid_b", "station", "phase", "cc", "scc", "dt"])


def differential_times(station_pairs: DataFrame, windows: DataFrame, config: Config, tiles: DataFrame | None = None) -> DataFrame:
    """``correlated_times`` of the pairs of events that agree at ``num_sta`` stations at least."""
    return well_observed(correlated_times(station_pairs, windows, config, tiles), config.num_sta)


def paired_windows(station_pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows of both events of each station pair (evid_a, evid_b, station), phase by phase and channel by channel."""
    key = F.struct("channel", "phase").alias("key")  # equal also where the channel is null
    side = lambda k: windows.select("station", key, F.col("evid").alias(f"evid_{k}"), F.col("t_rel").alias(f"t_{k}"), F.array("window").alias(f"data_{k}"))
    both = station_pairs.select("evid_a", "evid_b", "station").join(side("a"), ["station", "evid_a"]).join(side("b"), ["station", "key", "evid_b"])
    return both.select("station", "key.*", "evid_a", "evid_b", "t_a", "t_b", "data_a", "data_b")
