"""The event-pair operators' finer rules."""

import gzip
import struct

import numpy as np
import pyarrow as pa
import pytest
from mseed_files import mseed_record
from oracle import same
from pyspark.sql import functions as F

from wavetide.config import Config
from wavetide.functions import kernels as K
from wavetide.functions.columns import centisecond_id
from wavetide.operators import merge, pairs, records, waveforms
from wavetide.plans import event_pairs
from wavetide.sources import catalog, mseed, packed, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_default_geometry():
    p, s = Config().phases().values()
    assert (p.temp_npts, p.data_npts, p.temp_start, p.n_lags, p.shift_s) == (1200, 2200, 500, 1000, -0.5)
    assert (s.temp_npts, s.data_npts, s.temp_start, s.n_lags, s.shift_s) == (2700, 4300, 800, 1600, -0.8)


# kernels
def plain_correlation(data, template):
    size = template.shape[-1]
    out = []
    for k in range(1, data.shape[-1] - size + 1):
        per = []
        for x, t in zip(data, template):
            w = x[k : k + size]
            per.append(0.0 if w.std() < 1e-9 or t.std() == 0 else ((w - w.mean()) * (t - t.mean())).mean() / (w.std() * t.std()))
        out.append(np.mean(per))
    return np.array(out)


def test_correlation_equals_the_plain_sum():
    rng = np.random.default_rng(0)
    data, template = rng.normal(5, 2, (6, 2, 90)), rng.normal(-1, 3, (6, 2, 40))
    data[1, 0] = 7.0  # constant
    template[2, 1] = 0.0
    got = K.correlation(data, template)
    assert got.shape == (6, 50)
    for k in range(6):
        assert np.allclose(got[k], plain_correlation(data[k], template[k]), atol=1e-9)
    data[3, 0, 5] = np.nan
    assert np.isfinite(K.correlation(data, template)).all()


def test_peaks():
    cc = np.array([[0.1, -0.9, 0.2, 0.3, 0.4, 0.1], [0.5, 0.5, 0.1, 0.2, 0.3, 0.3]])
    peak, lag, contrast = K.peaks(cc, 1)
    assert peak.tolist() == [0.9, 0.5] and lag.tolist() == [1, 0]  # absolute; the first of equals
    far = np.array([0.3, 0.4, 0.1])
    assert contrast[0] == pytest.approx((0.9 - 0.3) / np.sort(np.abs(far - 0.3))[1])
    lower = 0.2  # of 0.1 0.2 0.3 0.3 the lower middle
    assert contrast[1] == pytest.approx((0.5 - lower) / np.sort(np.abs(np.array([0.1, 0.2, 0.3, 0.3]) - lower))[1])
    assert np.isnan(K.peaks(cc, 10)[2]).all()  # no background
    assert K.peaks(np.array([[1.0, 0, 0, 0, 0]]), 1)[2][0] == pytest.approx(1 / np.finfo(np.float32).eps)


@pytest.mark.parametrize("band", [(1.0, 16.0), (2.0, None), (None, 8.0)])
def test_butterworth_response(band):
    rate, (low, high) = 100.0, band
    sos = K.butterworth(rate, low, high)
    impulse = np.zeros((1, 1 << 14))
    impulse[0, 0] = 1
    h = np.abs(np.fft.rfft(K.filtered(impulse, sos)[0]))
    w = np.tan(np.pi * np.fft.rfftfreq(1 << 14))[1:-1]
    a, b = (np.tan(np.pi * f / rate) if f else None for f in band)
    if low and high:
        x = (w * w - a * b) / (w * (b - a))
    else:
        x = a / w if low else w / b
    assert np.allclose(h[1:-1], 1 / np.sqrt(1 + x**8), atol=1e-6)


def test_spline_takes_cubics_exactly_and_passes_its_knots():
    t = np.arange(12.0)
    cubic = lambda x: 2 - x + 0.5 * x**2 - 0.03 * x**3
    at = np.linspace(0, 11, 57)
    assert np.allclose(K.interpolated(cubic(t)[None], at)[0], cubic(at))
    y = np.random.default_rng(1).normal(size=(3, 12))
    assert np.allclose(K.interpolated(y, t), y)


def test_detrend_taper_and_moments():
    t = np.arange(200.0)
    assert np.allclose(K.detrended((3 + 0.2 * t)[None]), 0)
    x = K.tapered(np.ones((1, 400)), 1.0)
    assert x[0, 0] == 0 and x[0, 10:390].min() == 1 and x[0, 5] == pytest.approx(0.5)  # ten seconds at most
    y = np.random.default_rng(2).normal(1e6, 1, (2, 50))
    mean, var = K.sliding_moments(y, 7)
    assert np.allclose(mean[1, 3], y[1, 3:10].mean()) and np.allclose(var[1, 3], y[1, 3:10].var(), rtol=1e-6)


def test_known_delay_and_the_lag_convention(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=300)
    made = [("same", base[50:150], base[50:150]), ("flipped", -base[50:150], base[50:150]), ("late", base[45:145], base[50:150])]
    df = spark.createDataFrame([(n, [a.tolist()], [b.tolist()], 1.5, 1.5) for n, a, b in made], "name string, data_a array<array<float>>, data_b array<array<float>>, t_a float, t_b float")
    got = {r.name: r for r in waveforms.correlate(df, 100, 20, 60, 10.0, -2.0, 0.3).collect()}
    assert got["same"].lag == 19 and got["same"].dt == pytest.approx(-0.1) and got["same"].cc == pytest.approx(1, abs=1e-6)
    assert got["flipped"].cc == pytest.approx(1, abs=1e-6) and got["flipped"].lag == 19
    assert got["late"].lag == 24 and got["late"].dt == pytest.approx(0.4, abs=1e-6)
    flagged = spark.createDataFrame([(0.5, 0.3, 7.0), (0.5, 0.3, float("nan")), (0.51, 0.3, 9.0), (-0.5, 0.29, 9.0)], "dt float, cc double, scc double").withColumn("kept", waveforms.passes(0.5, 0.3, 7.0))
    assert [r.kept for r in flagged.collect()] == [True, False, False, False]


def test_differential_times_of_windows(spark):
    rng = np.random.default_rng(9)
    config = Config(samp_rate=10.0, win_temp_p=(0.5, 2.5), win_temp_s=(0.5, 3.5), dt_thres=(1.0, 1.5), cc_thres=0.9, scc_thres=2.0, peak_separation=0.3, num_sta=2)
    shape = {"P": (1, 50), "S": (2, 70)}
    windows = []
    for station in ("N.A", "N.B", "N.C"):
        wave = {p: rng.normal(size=(c, n + 10)) for p, (c, n) in shape.items()}
        for k, evid in enumerate(("e1", "e2")):
            cut = {p: wave[p][:, 3 * k : 3 * k + n].tolist() for p, (c, n) in shape.items()}
            noise = rng.normal(size=shape["P"]).tolist()
            windows.append((station, evid, 2.0, 4.0, True, station != "N.C", noise if station == "N.C" and k else cut["P"], cut["S"] if station != "N.C" else None))
    df = spark.createDataFrame(windows, "station string, evid string, tp_rel float, ts_rel float, has_p boolean, has_s boolean, p_data array<array<float>>, s_data array<array<float>>")
    asked = spark.createDataFrame([("e1", "e2", s) for s in ("N.A", "N.B", "N.C", "N.D")], "evid_a string, evid_b string, station string")
    got = waveforms.differential_times(asked, df, config)
    # e2's window starts three samples later on the same wave: lag +3, less the one of the convention
    assert rows(got.select("station", "phase", "dt_u6")) == sorted([(s, p, 200000) for s in ("N.A", "N.B") for p in "PS"])
    assert waveforms.differential_times(asked.filter("station = 'N.A'"), df, config).count() == 0  # one station only


SEEN = "station string, evid string, tp_rel float, ts_rel float, has_p boolean, has_s boolean, p_data array<array<float>>, s_data array<array<float>>"


@pytest.mark.parametrize("tile", [1, 3, 64, None])
def test_tiles_correlate_what_single_pairs_do(spark, tile):
    """Dense pairs of 14 events at three stations; some windows and phases are missing, one pair is told twice, one has a null."""
    rng = np.random.default_rng(10)
    config = Config(samp_rate=10.0, win_temp_p=(0.5, 2.5), win_temp_s=(0.5, 3.5), dt_thres=(1.0, 1.5), cc_thres=0.2, scc_thres=None, peak_separation=0.3, num_sta=2)
    windows, asked = [], [("e0", "e1", "N.A"), (None, "e1", "N.A"), ("e0", "e1", None), ("e0", "none", "N.B")]
    for k, station in enumerate(("N.A", "N.B", "N.C")):
        for e in range(14):
            if (k + e) % 9:
                p, s = rng.normal(size=(1, 50)).tolist(), rng.normal(size=(2, 70)).tolist()
                windows.append((station, f"e{e}", 2.0 + e / 10, 4.0, e % 5 > 0, e % 7 > 0, p if e % 5 else None, s if e % 7 else None))
        asked += [(f"e{a}", f"e{b}", station) for a in range(14) for b in range(14) if a != b and (a * b) % 3 < 2]
    df = spark.createDataFrame(windows, SEEN)
    told = spark.createDataFrame(asked, "evid_a string, evid_b string, station string")
    one = {(w[0], w[1]): w for w in windows}
    want = []
    for a, b, s in asked:
        if (s, a) in one and (s, b) in one:
            for phase, k, spec in (("P", 0, config.phases()["P"]), ("S", 1, config.phases()["S"])):
                x, y = one[s, a], one[s, b]
                if x[4 + k] and y[4 + k]:
                    cc = K.correlation(np.float32([x[6 + k]]), np.float32([y[6 + k]])[:, :, spec.temp_start : spec.temp_start + spec.temp_npts])
                    peak, lag, _ = K.peaks(cc, 3)
                    dt = np.float32(x[2 + k]) + np.float32(spec.shift_s) + np.float32(lag[0] / 10) - np.float32(y[2 + k])
                    if peak[0] >= 0.2 and abs(dt) <= np.float32(spec.dt_limit):
                        want.append((a, b, s, phase, round(1e6 * float(dt)), peak[0]))
    # tile None: by partners; else by place, where some events lie at one and one is not told
    places = spark.createDataFrame([(f"e{e}", 33.0 + e // 4 * 0.01, -116.0) for e in range(13)], "evid string, lat double, lon double")
    tiles = waveforms.place_tiles(places, 0.03, tile) if tile else None
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = waveforms.correlated_times(told, df.withColumn("more", F.lit(1)), config, tiles).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    order = lambda r: tuple(r[:4])
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want] and len(want) > 300
    assert all(abs(g[4] - w[4]) <= 2 and abs(g[5] - 1e6 * w[5]) <= 2 for g, w in zip(got, want))
    assert waveforms.correlated_times(told.limit(0), df, config).count() == waveforms.correlated_times(told, df.limit(0), config).count() == 0


def test_event_tiles(spark):
    """Every event has one tile; a cluster of 300 is parted into tiles of about 20, two clusters share none."""
    asked = [(f"{c}{a:03}", f"{c}{b:03}", "N.A") for c in "xy" for a in range(300) for b in range(a + 1, min(a + 40, 300))] + [(f"{c}000", f"{c}{b:03}", "N.B") for c in "xy" for b in range(1, 300)]
    got = waveforms.event_tiles(spark.createDataFrame(asked, "evid_a string, evid_b string, station string"), 20).collect()
    assert len(got) == len({r.evid for r in got}) == 600
    tiles = {}
    for r in got:
        tiles.setdefault(r.tile, []).append(r.evid)
    assert all(len({e[0] for e in t}) == 1 for t in tiles.values()) and len(tiles) == 30 and max(map(len, tiles.values())) <= 40


def test_place_tiles(spark):
    """A cell of 200 is cut by place, 100 events at one place by hash; events far apart share none; no place is a cell too."""
    rng = np.random.default_rng(4)
    made = [(f"a{k}", 33.0 + rng.uniform(0, 0.1), -116.0 + rng.uniform(0, 0.1)) for k in range(200)]
    made += [(f"b{k}", 40.05, -100.05) for k in range(100)] + [(f"c{k}", 20.0 + k, 0.05) for k in range(5)] + [("d0", None, 0.0), ("d1", float("nan"), 0.0), (None, 1.0, 1.0)]
    got = {r.evid: r.tile for r in waveforms.place_tiles(spark.createDataFrame(made, "evid string, lat double, lon double"), 0.1, 20).collect()}
    assert set(got) == {m[0] for m in made if m[0]}
    tiles = {}
    for evid, tile in got.items():
        tiles.setdefault(tile, []).append(evid)
    kinds = [{e[0] for e in t} for t in tiles.values()]
    assert all(len(k) == 1 for k in kinds) and kinds.count({"c"}) == 5 and kinds.count({"b"}) == 5 and kinds.count({"a"}) >= 10
    assert max(map(len, tiles.values())) <= 40 and got["d0"] == got["d1"]


# the packed form
def test_packed_files(spark, tmp_path):
    def stored(x):
        return abs(x) | (x < 0) << 31

    told = [(0, 0, 0), (1, -1, 1_000_000), ((1 << 51) - 1, 2147483647, -2147483647), (1, -1, 1_000_000)]
    (tmp_path / "a.bin").write_bytes(b"".join(struct.pack("<QII", k, stored(d), stored(c)) for k, d, c in told))
    (tmp_path / "b.bin").write_bytes(b"")
    assert rows(packed.read_packed(spark, str(tmp_path))) == sorted(told, key=repr)
    df = spark.createDataFrame(told, "key long, dt_u6 int, cc_u6 int")
    assert b"".join(sorted(bytes(r.content) for r in packed.pack(df.coalesce(1)).collect())) == (tmp_path / "a.bin").read_bytes()
    assert packed.unpack(packed.pack(df.filter("false"))).count() == 0
    assert packed.unpack(spark.createDataFrame([(None,)], "content binary")).count() == 0
    with pytest.raises(Exception, match="multiple of 16"):
        packed.unpack(spark.createDataFrame([(b"x" * 17,)], "content binary")).collect()
    with pytest.raises(Exception, match="without key"):
        packed.pack(spark.createDataFrame([(1, None, 2)], "key long, dt_u6 int, cc_u6 int")).collect()


def test_an_observation_of_an_unknown_station_is_an_error(spark):
    obs = spark.createDataFrame([("1", "2", "N.A"), ("1", "2", "N.B")], "evid_a string, evid_b string, station string")
    numbers = spark.createDataFrame([("N.A", 0), ("N.C", 1)], "station string, station_no int")
    assert [r.station_no for r in merge.numbered(obs.filter("station = 'N.A'"), numbers).collect()] == [0]
    with pytest.raises(Exception, match="no such station: N.B"):
        merge.numbered(obs, numbers).collect()


@pytest.mark.parametrize("at", [(1 << 20, 1, 0), (1, -1, 0), (1, 2, 1 << 10)])
def test_a_number_without_room_in_the_key_is_an_error(spark, at):
    df = spark.createDataFrame([at], "a long, b long, s long")
    with pytest.raises(Exception, match="no room in the key"):
        df.select(merge.packed(F.col("a"), F.col("b"), F.col("s"), F.lit("P"))).collect()


def beyond_the_key(spark, folder):
    """Tables of four events, two with numbers above 20 bits, at 1,100 stations with codes of 9 characters."""
    day = 1_500_000_000_000_000
    at = lambda us: F.timestamp_micros(F.lit(day) + us)
    events = spark.createDataFrame([("1", 7), ("2", (1 << 20) + 5), ("3", 50_000_000), ("4", 8)], "evid string, ord long")
    stations = spark.range(1100).select(F.format_string("NN.%06d", "id").alias("net_sta"), F.lit(10.0).alias("lat"), F.lit(20.0).alias("lon"), F.lit(0.0).alias("ele"), F.col("id").alias("line_no"))
    events.select("evid", F.lit("w").alias("waveform_id"), at(F.lit(0)).alias("ot"), F.lit(10.0).alias("lat"), F.lit(20.0).alias("lon"), F.lit(5.0).alias("dep"), F.lit(1.0).alias("mag"), "ord").write.parquet(f"{folder}/quakes.parquet")
    stations.write.parquet(f"{folder}/stations.parquet")
    late = F.col("line_no") * 100 + F.col("evid").cast("int") * 7000
    picks = stations.filter("line_no % 333 in (0, 101)").select("net_sta", "line_no").crossJoin(events.select("evid"))
    picks.select("evid", "net_sta", at(1_000_000 + late).alias("tp"), at(2_000_000 + late).alias("ts"), F.col("line_no") * 10 + F.col("evid").cast("int")).toDF("evid", "net_sta", "tp", "ts", "line_no").write.parquet(f"{folder}/picks.parquet")
    spark.createDataFrame([("1", "2", 4), ("2", "1", 5), ("3", "2", 6), ("1", "4", 7), ("4", "3", 8)], "evid_a string, evid_b string, n_common int").write.parquet(f"{folder}/pairs.parquet")
    return str(folder)


def test_packed_observations_beyond_the_key(spark, tmp_path):
    folder = beyond_the_key(spark, tmp_path)
    n, ours, theirs = same(event_pairs.packed_observations(spark, folder), event_pairs.SQL["packed_observations"], folder)
    assert (n, ours, theirs) == (5 * 7 * 2, [], [])
    for bad in ((1 << 32, 1, 0), (1, 1 << 52, 0), (1, -1, 0), (1, 2, 1 << 31)):
        with pytest.raises(Exception, match="no room in the key"):
            spark.createDataFrame([bad], "a long, b long, s long").select(merge.long_key(F.col("a"), F.col("b"), F.col("s"), F.lit("P"))).collect()


def test_packed_records_beyond_the_key(spark, tmp_path):
    folder = beyond_the_key(spark, tmp_path)
    n, ours, theirs = same(event_pairs.packed_records(spark, folder), event_pairs.SQL["packed_records"], folder)
    assert (n, ours, theirs) == (5 * 7 * 2, [], [])


def test_upper_bits_stand_before_their_record(spark, monkeypatch):
    told = [(1, 2, 3, "P", -5, 6), ((1 << 32) - 1, (1 << 52) - 1, (1 << 31) - 1, "S", 7, -8), (1 << 20, 0, 0, "P", 0, 0), (0, 1 << 20, 1, "S", 1, 1), (0, 1, 1 << 10, "S", 1, 1), (9, 9, 9, "S", 9, 9)]
    df = spark.createDataFrame(told, "a long, b long, s long, p string, dt_u6 int, cc_u6 int")
    contents = packed.pack_split(df.select(*merge.split_numbers(*map(F.col, "absp")), "dt_u6", "cc_u6").coalesce(1)).localCheckpoint()
    assert len(contents.first().content) == 16 * (6 + 4)
    for step in (1 << 16, 2, 1):
        monkeypatch.setattr(packed, "STEP", step)
        batch = pa.RecordBatch.from_arrays([pa.array([bytes(contents.first().content)], pa.binary())], ["content"])
        assert np.concatenate(parts := list(packed._records(batch))).tobytes() == contents.first().content and not any(x["key"][-1] >= packed.OVER for x in parts)
    monkeypatch.undo()
    read = packed.unpack_split(contents)
    assert rows(read.select(*merge.whole_numbers(*map(F.col, ("key", "over_events", "over_station"))), "dt_u6", "cc_u6")) == rows(df)
    plain = df.filter("a < 1000 and b < 1000 and s < 1000").coalesce(1).withColumn("key", merge.packed(*map(F.col, "absp")))
    split = plain.select(*merge.split_numbers(*map(F.col, "absp")), "dt_u6", "cc_u6")
    assert packed.pack(plain).first().content == packed.pack_split(split).first().content
    with pytest.raises(Exception, match="no room in the key"):
        packed.unpack(contents).collect()
    over = struct.pack("<QII", 1 << 63 | 1, 0, 0)
    for bad in (over, over + over + bytes(16)):
        with pytest.raises(Exception, match="upper bits without"):
            packed.unpack_split(spark.createDataFrame([(bad,)], "content binary")).collect()


# cutting
def test_cut_windows(spark):
    rate, start = 10.0, 1_000_000_000_000_000
    t = np.arange(900) / rate
    wave = np.sin(2 * np.pi * 0.7 * t)
    config = Config(samp_rate=10.0, freq_band=(None, None), win_temp_p=(0.5, 2.5), win_temp_s=(0.5, 3.5), dt_thres=(1.0, 1.5), chn_p=(2,), chn_s=(0, 1))
    coarse = np.sin(2 * np.pi * 0.7 * np.arange(450) / 5.0)
    traces = [("S", "EHZ", 1, start, 10.0, wave.tolist()), ("S", "EHE", 2, start, 5.0, coarse.tolist()), ("S", "EHN", 3, start, 10.0, wave.tolist()), ("S", "EHZ", 9, start, 10.0, (wave * 2).tolist())]
    df = spark.createDataFrame(traces, "station string, channel string, trace_id long, start_us long, rate double, data array<float>")
    asked = [("in", "S", start + 10_000_000, start + 20_000_000, start + 30_000_000), ("early", "S", start, start + 1_000_000, None), ("late", "S", start, None, start + 88_000_000)]
    cut = waveforms.cut_windows(spark.createDataFrame(asked, "evid string, station string, ot_us long, tp_us long, ts_us long"), df, config)
    got = {(r.evid, r.phase, r.channel): r for r in cut.collect()}
    assert set(got) == {("in", p, c) for p in "PS" for c in ("EHZ", "EHE", "EHN")}
    p = got["in", "P", "EHZ"]
    assert len(p.window) == 50 and p.t_rel == 10.0 and np.allclose(p.window, wave[185:235], atol=1e-6)  # trace 1, not 9
    assert np.allclose(got["in", "P", "EHE"].window, wave[185:235], atol=2e-2)  # from 5 Hz by a spline
    one = waveforms.event_windows(cut, config).first()
    assert one.has_p and one.has_s and len(one.p_data) == 1 and len(one.s_data) == 2 and len(one.s_data[0]) == 70
    half = waveforms.event_windows(cut.filter("channel = 'EHZ'"), config).first()
    assert half.has_p and not half.has_s and half.ts_rel == -1.0 and half.s_data is None
    codes = {"EHZ": "HH3", "EHE": "HH1", "EHN": "HH2"}
    other = cut.replace(codes, subset="channel").withColumn("window", F.transform("window", lambda v: v + 7))
    both = waveforms.event_windows(cut.unionByName(other), config).first()  # the smaller code's instrument, whole
    assert both.s_data == one.s_data and both.p_data == one.p_data
    assert waveforms.event_windows(other, config).first().s_data[0] == pytest.approx([v + 7 for v in one.s_data[0]])
    mixed = waveforms.event_windows(cut.filter("channel <> 'EHN'").unionByName(other.filter("channel = 'HH2'")), config).first()
    assert mixed.has_p and not mixed.has_s  # no phase from two instruments
    back = spark.read.parquet
    import tempfile

    path = tempfile.mkdtemp() + "/windows"
    sinks.write_windows(waveforms.event_windows(cut, config), path)
    sinks.write_windows(waveforms.event_windows(cut, config), path, only_new=True)
    assert back(path).count() == 1 and back(path).filter("station = 'S'").count() == 1


def test_windows_across_hours_equal_those_of_the_whole_trace(spark):
    """A trace of three hours, windows at both sides of and across the hours' ends, with warm-up, filter and spline."""
    config = Config(samp_rate=10.0, freq_band=(0.2, 2.0), win_temp_p=(0.5, 2.5), win_temp_s=(0.5, 3.5), dt_thres=(1.0, 1.5))
    hour, rng = 3_600_000_000, np.random.default_rng(3)
    start = 277_777 * hour + 1_234_567_000
    traces = [("S", c, k, start, rate, rng.normal(size=int(9_000 * rate)).astype(np.float32).tolist()) for k, (c, rate) in enumerate([("EHZ", 10.0), ("EHN", 4.0)])]
    df = spark.createDataFrame(traces, "station string, channel string, trace_id long, start_us long, rate double, data array<float>")
    ends = [277_778 * hour + d for d in (-40_000_000, -2_000_000, 0, 700_000, 1_500_000, 2_100_000, 25_000_000)] + [277_779 * hour, start + 1_500_000, start + 1_499_999]
    asked = [(f"e{k}", "S", at, at, None) for k, at in enumerate(ends)] + [("none", "S", start, None, None), ("no origin", "S", None, start + hour, None), ("no station", None, start, start + hour, None)]
    got = waveforms.cut_windows(spark.createDataFrame(asked, "evid string, station string, ot_us long, tp_us long, ts_us long"), df, config).collect()
    assert {(r.evid, r.channel) for r in got} == {(f"e{k}", c) for k in range(len(ends) - 1) for c in ("EHZ", "EHN")}
    sos = K.butterworth(10.0, 0.2, 2.0)
    for r in got:
        _, _, _, _, rate, data = traces[r.channel == "EHN"]
        first = round((ends[int(r.evid[1:])] - 1_500_000 - start) / 1e5)
        warm = max(0, first - 200)
        at = np.arange(warm, first + 50) * (rate / 10.0)
        low, high = max(0, int(at[0]) - 8), min(len(data), int(np.ceil(at[-1])) + 9)
        part = np.array(data[low:high])[None]
        part = part[:, warm - low : first + 50 - low] if rate == 10.0 else K.interpolated(part, at - low)
        assert np.allclose(r.window, K.filtered(part, sos)[0, first - warm :], atol=1e-6)
    longest = waveforms.hour_pieces(df.filter("channel = 'EHZ'"), 20.0, 7.0).selectExpr("max(size(piece))", "count(*)").first()
    assert longest[0] <= (3600 + 27) * 10 + 2 * 8 + 1 and longest[1] == 3


def test_cutting_takes_cubics_exactly_and_filters_as_the_formula_says(spark):
    """A cubic read at 5 Hz comes out exactly at 10 Hz; a sine long after the filter's start has the gain and phase of the
    Butterworth polynomial at its frequency."""
    start = 1_000_000_000_000_000
    poly = lambda t: 2 - t + 0.05 * t**2 - 0.0003 * t**3
    sine = lambda t: np.sin(2 * np.pi * 0.9 * t)
    schema, asked = "station string, channel string, trace_id long, start_us long, rate double, data array<double>", "evid string, station string, ot_us long, tp_us long, ts_us long"
    ask = spark.createDataFrame([("e", "S", start, start + 60_000_000, None)], asked)
    open_ = Config(samp_rate=10.0, freq_band=(None, None), win_temp_p=(0.5, 2.5), dt_thres=(1.0, 1.5))
    traces = spark.createDataFrame([("S", "EHZ", 1, start, 5.0, poly(np.arange(450) / 5).tolist())], schema)
    (row,) = waveforms.cut_windows(ask, traces, open_).collect()
    at = 58.5 + np.arange(50) / 10
    assert np.allclose(row.window, poly(at), rtol=1e-6)
    band = open_.but(freq_band=(0.2, 2.0), warm_up_s=50.0)
    traces = spark.createDataFrame([("S", "EHZ", 1, start, 10.0, sine(np.arange(900) / 10).tolist())], schema)
    (row,) = waveforms.cut_windows(ask, traces, band).collect()
    low, high, w = (np.tan(np.pi * f / 10) for f in (0.2, 2.0, 0.9))
    s = (1j * w * 1j * w + low * high) / (1j * w * (high - low))
    h = 1 / np.prod([s - np.exp(1j * np.pi * (2 * k + 5) / 8) for k in range(4)])
    assert np.allclose(row.window, np.imag(h * np.exp(2j * np.pi * 0.9 * at)), atol=1e-5)


def test_fast_traces_are_cut_quickly_and_in_little_room():
    import time
    import tracemalloc

    x = np.random.default_rng(0).normal(size=(1, 12_500))
    sos = K.butterworth(1000.0, 1.0, 16.0)
    tracemalloc.start()
    began = time.perf_counter()
    y = K.filtered(K.interpolated(x, np.arange(24_998) / 2), sos)
    assert time.perf_counter() - began < 1 and tracemalloc.get_traced_memory()[1] < 200e6 and y.shape == (1, 24_998)
    tracemalloc.stop()


def test_whole_traces_at_another_rate(spark):
    cubic = lambda t: 1 + t - 0.02 * t**2 + 0.0001 * t**3
    told = [("A", "Z", 1, 0, 5.0, cubic(np.arange(100) / 5).tolist()), ("A", "Z", 2, 7, 10.0, [1.0, 2.0]), ("A", "Z", 3, 7, 4.0, [1.0, 3.0]), ("A", "Z", 4, 7, 4.0, [])]
    df = spark.createDataFrame(told, "station string, channel string, trace_id long, start_us long, rate double, data array<float>")
    got = {r.trace_id: r for r in waveforms.resampled(df, 10.0).collect()}
    assert len(got[1].data) == 199 and np.allclose(got[1].data, cubic(np.arange(199) / 10), rtol=1e-5)
    assert got[2].data == [1.0, 2.0] and np.allclose(got[3].data, [1.0, 1.8, 2.6]) and got[4].data == [] and {r.rate for r in got.values()} == {10.0}


def test_written_tasks(spark, tmp_path):
    tasks = spark.createDataFrame([("A", k % 7, k) for k in range(50)] + [("B", 1, 1), ("B", 1, 1)], "station string, row_a int, row_b int")
    sinks.write_tasks(tasks, str(tmp_path / "tasks"))
    back = spark.read.parquet(str(tmp_path / "tasks"))
    assert rows(back.select("station", "row_a", "row_b")) == rows(tasks)


def test_station_days(spark):
    """Three traces a day are cut to their common stretch; two, four, unequal rates and traces apart give nothing."""
    t0 = 1_000_000_000_000_000
    at = lambda st, c, k, shift, n, rate=10.0: (st, "d", c, k, t0 + shift, rate, [float(v) for v in range(n)])
    told = [at("A", "E", 1, 0, 100), at("A", "N", 2, 310_000, 100), at("A", "Z", 3, 160_000, 90)]
    told += [at("B", "E", 4, 0, 10), at("B", "N", 5, 0, 10), at("C", "E", 6, 0, 10), at("C", "N", 7, 0, 10), at("C", "Z", 8, 0, 10), at("C", "Z", 9, 0, 10)]
    told += [at("D", "E", 10, 0, 10), at("D", "N", 11, 0, 10), at("D", "Z", 12, 0, 10, 20.0), at("F", "E", 13, 0, 10), at("F", "N", 14, 0, 10), at("F", "Z", 15, 9_000_000, 10)]
    told += [("G", "d", None, 16, t0, 10.0, [1.0]), (None, "d", "E", 17, t0, 10.0, [1.0]), ("G", "d", "E", 18, t0, None, [1.0]), ("G", "d", "N", 19, t0, 1.0, None)]
    df = spark.createDataFrame(told, "station string, day string, channel string, trace_id long, start_us long, rate double, data array<float>")
    got = {r.trace_id: r for r in waveforms.station_days(df).collect()}
    assert set(got) == {1, 2, 3}
    # the common stretch begins at 0.31 s and ends with channel Z at 9.06 s
    assert [(got[k].data[0], len(got[k].data)) for k in (1, 2, 3)] == [(3.0, 88), (0.0, 88), (2.0, 88)]
    assert {r.start_us for r in got.values()} == {t0 + 300_000}
    assert waveforms.station_days(df.limit(0)).count() == 0


# records and pairs
def test_last_wins_and_templates(spark):
    picks = spark.createDataFrame([("e", " n.a", 1, 1, 5), ("e", "N.A", 2, None, 7), ("e", "N.B", 1, 1, 6), (None, "N.B", 1, 1, 6)], "evid string, net_sta string, tp long, ts long, line_no long")
    picks = picks.withColumns({"tp": F.timestamp_micros("tp"), "ts": F.timestamp_micros("ts")})
    assert rows(records.last_picks(picks)) == [("e", "N.A", 2, None), ("e", "N.B", 1, 1)]
    quakes = spark.createDataFrame([("e", 0, 1.0, 1.0, 1.0, float("nan")), ("f", 0, 1.0, 1.0, None, 1.0)], "evid string, ot long, lat double, lon double, dep double, mag double").withColumn("ot", F.timestamp_micros("ot"))
    got = records.event_records(quakes, records.last_picks(picks), Config(num_sta=2, temp_sta=2))
    assert [(r.evid, r.stations, r.is_temp) for r in got.collect()] == [("e", ["N.A", "N.B"], False)]


def record(evid, lat, lon, temp=True, dep=5.0, ot=0, stations=("A", "B")):
    return (evid, ot, lat, lon, dep, 1.0, list(stations), temp)


RECORD = "evid string, ot_us long, lat double, lon double, dep double, mag double, stations array<string>, is_temp boolean"


def edges_by_hand(recs, c):
    edges = set()
    for r in recs:
        got = []
        for x in recs:
            cos = np.cos(np.radians(r[2]))
            n, e, d = 111 * abs(x[2] - r[2]), 111 * abs(x[3] - r[3]) * cos, abs(x[4] - r[4])
            if n < c.loc_dev and e < c.loc_dev and d < c.dep_dev and abs(x[1] - r[1]) <= c.cal_win_days * 86400e6 and (r[7] or x[7]) and len(set(r[6]) & set(x[6])) >= c.num_sta:
                got.append((np.sqrt(n * n + e * e + d * d), x[0]))
        got.sort()
        cut = got[min(len(got) - 1, c.max_nbr)][0] if got else 0
        edges |= {(r[0], x) for d, x in got if d <= cut}
    return edges


def test_candidate_pairs(spark):
    rng = np.random.default_rng(4)
    recs = []
    for k in range(150):
        lat = float(rng.choice([10.0, 70.0, 84.0, -45.0]) + np.round(rng.normal(0, 0.02), 2))
        recs.append(record(f"e{k:03d}", lat, float(5 + np.round(rng.normal(0, 0.03), 2) / np.cos(np.radians(lat))), bool(rng.random() < 0.5), float(rng.choice([1.0, 4.9, 5.0])), int(rng.choice([0, 800])) * 86_400_000_000, rng.choice(list("ABCD"), 3, False).tolist()))
    for config in (Config(num_sta=2), Config(num_sta=2, max_nbr=3)):
        want = edges_by_hand(recs, config)
        got = pairs.candidate_edges(spark.createDataFrame(recs, RECORD), config)
        assert {(r.ref, r.cand) for r in got.collect()} == want
        both = {tuple(sorted(e)) for e in want if e[0] != e[1]}
        assert {(r.evid_a, r.evid_b) for r in pairs.candidate_pairs(spark.createDataFrame(recs, RECORD), config).collect()} == both


def test_pair_admitted_in_one_direction_only(spark):
    # the box in longitude is wider for the reference nearer the pole
    recs = [record("a", 80.0, 0.0), record("b", 80.02, 0.1557)]
    edges = pairs.candidate_edges(spark.createDataFrame(recs, RECORD), Config(num_sta=2))
    assert {(r.ref, r.cand) for r in edges.collect()} - {("a", "a"), ("b", "b")} == {("b", "a")}
    assert pairs.candidate_pairs(spark.createDataFrame(recs, RECORD), Config(num_sta=2)).count() == 1


def test_station_pairs(spark):
    recs = spark.createDataFrame([record("a", 0.0, 0.0, stations="ABCD"), record("b", 0.0, 0.001, stations="ABCE")], RECORD)
    two = spark.createDataFrame([("a", "b")], "evid_a string, evid_b string")
    sta = [("A", 0.0, 100 / 111), ("B", 0.0, 0.5), ("C", 0.0, 0.002), ("D", 0.0, 0.1), ("E", 0.0, 0.1)]
    stations = spark.createDataFrame(sta, "station string, lat double, lon double")
    got = pairs.station_pairs(two, recs, stations, Config(num_sta=2))
    assert sorted(r.station for r in got.collect()) == ["A", "B"]  # C is within 1.5 km of both
    assert pairs.station_pairs(two, recs, stations, Config(num_sta=3)).count() == 0
    with pytest.raises(Exception, match="no such station"):
        pairs.station_pairs(two, recs, stations.filter("station <> 'B'"), Config(num_sta=2)).collect()


# observations
def test_fixed_point_packing_and_lines(spark):
    df = spark.createDataFrame([(0.0000005,), (0.0000015,), (-1.25,)], "x double")
    assert [r[0] for r in df.select(merge.micro_units(F.col("x"))).collect()] == [0, 2, -1250000]
    for bad in (float("nan"), float("inf"), 2147.5):
        with pytest.raises(Exception, match="fixed-point"):
            spark.createDataFrame([(bad,)], "x double").select(merge.micro_units(F.col("x"))).collect()
    key = spark.createDataFrame([((1 << 20) - 1, 3, 1023, "S"), (0, 1, 0, "P")], "a int, b int, s int, p string").withColumn("key", merge.packed(*map(F.col, "absp")))
    assert rows(key.select("a", "b", "s", "p")) == rows(key.select(*merge.unpacked(F.col("key"))))
    obs = spark.createDataFrame([("7", "12", "N.B", "S", 35, 1000000, 1), ("7", "12", "N.B", "S", 45, 300050, 2), ("7", "12", "N.A", "P", -500000, 999950, 1), ("7", "12", "N.B", "P", 25, 1, 1), ("8", "9", "N.A", "P", 1, 1, 1)], "evid_a string, evid_b string, station string, phase string, dt_u6 int, cc_u6 int, ordinal int")
    kept = merge.well_observed(merge.last_observations(obs), 2)
    block = merge.dt_lines(kept).collect()
    assert len(block) == 1
    want = ["# %9u %9u 0.0" % (7, 12)] + ["%-7s %8.5f %.4f %s" % x for x in (("A", -0.5, 0.99995, "P"), ("B", 0.000025, 0.000001, "P"), ("B", 0.000045, 0.30005, "S"))]
    assert block[0].block == "\n".join(want)
    twice = obs.withColumn("station", F.when(F.col("phase") == "S", "X.B").otherwise(F.col("station")))
    with pytest.raises(Exception, match="one code"):
        merge.dt_lines(merge.last_observations(twice)).collect()


# text
def test_catalogue_text(spark, tmp_path):
    text = "N.Z,2018-08-15T00:00:00Z,-1,0\n2018-08-15T01:30:02.859Z, 33.5,-116.8,5.0,1.2,111\n\nN.A, 2018-08-15T01:30:04.5Z,-1,1.0\n N.B,-1,2018-08-16T00:00:00.1234567Z\n2018-08-15T02:00:00Z,x,1,2,3,112\nN.A,-1.0,\n"
    with gzip.open(tmp_path / "a.pha.gz", "wt") as f:
        f.write(text)
    events, picks = catalog.parse_catalogue(catalog.read_lines(spark, str(tmp_path)))
    e = {r.evid: r for r in events.collect()}
    assert set(e) == {"111", "112"} and e["112"].lat is None and e["111"].ot_us == 1534296602859000
    assert [r[0] for r in events.filter("evid = '111'").select(centisecond_id(F.col("ot_us"))).collect()] == ["20180815013002.85"]
    assert rows(picks.select("evid", "station", "tp_us", "ts_us")) == sorted([("111", "N.A", 1534296604500000, None), ("111", "N.B", None, 1534377600123456), ("112", "N.A", None, None)], key=repr)


def test_times_as_text(spark):
    told = {"2018-08-15T01:30:02.859Z": 1534296602859000, " 2018-08-15 01:30:02\t": 1534296602000000, "2018-08-15T01:30:02.1234567Z": 1534296602123456, "2018-08-15T01:30:02.5": 1534296602500000, "1969-12-31T23:59:59.9Z": -100000}
    bad = ["-1", "", "2018-08-15", "2018-13-15T01:30:02Z", "2018-08-15T01:30:02.Z", "2018-08-15T01:30:02.5ZZ", "x2018-08-15T01:30:02Z", None]
    df = spark.createDataFrame([(t,) for t in [*told, *bad]], "t string")
    assert {r.t: r.us for r in df.select("t", catalog.time_micros(F.col("t")).alias("us")).collect()} == {**told, **dict.fromkeys(bad)}


def test_header_is_carried_over_splits(spark):
    value = ["2018-08-15T01:30:02Z,1,2,3,4,e1", "A,-1,-1", "B,-1,-1", "C,-1,-1", "2018-08-15T01:30:03Z,1,2,3,4,e2", "D,-1,-1"]
    lines = spark.createDataFrame([("f", k // 2, k, v) for k, v in enumerate(value)] + [("g", 0, 0, "E,-1,-1")], "file string, split long, ord long, value string")
    _, picks = catalog.parse_catalogue(lines)
    assert rows(picks.select("evid", "station")) == [("e1", "A"), ("e1", "B"), ("e1", "C"), ("e2", "D")]
    named, some = catalog.parse_named_catalogue(lines, 1534296602000000, None)
    assert rows(named.select("evid")) == [("e2",)] and rows(some.select("station")) == [("D",)]


def test_stations_and_observations(spark, tmp_path):
    (tmp_path / "s.sta").write_text("N.A,1,2,3,x,y,z\n n.a ,4,5,6\n\nN.B,7,8,9\nN.C,NaN,x,\n")
    assert rows(catalog.parse_stations(catalog.read_lines(spark, str(tmp_path)))) == [("N.A", 4.0, 5.0, 6.0), ("N.B", 7.0, 8.0, 9.0), ("N.C", None, None, None)]
    lines = lambda *x: spark.createDataFrame([(v, 0, k) for k, v in enumerate(x)], "value string, split long, ord long")
    got = catalog.parse_observations(lines("1 2 N.A P -0.5 0.123456", "", " 3 4 N.B S 1 +0.9 "))
    assert rows(got.drop("split", "ord")) == [(1, 2, "N.A", "P", -500000, 123456), (3, 4, "N.B", "S", 1000000, 900000)]
    for bad in ("1 2 N.A X 0 0", "1 2 N.A P 0.1234567 0", "1048576 2 N.A P 0 0", "1 2 N.A P 0"):
        with pytest.raises(Exception, match="bad observation"):
            catalog.parse_observations(lines(bad)).collect()
    with pytest.raises(Exception, match="no number"):
        catalog.station_numbers(spark.createDataFrame([("TOOLONG.NAME",)], "station string")).collect()


def test_waveform_folders_and_run_meta(spark, tmp_path):
    for name in ("N.A.EHE.mseed", "N.A.EHN.mseed", "N.A.EHZ.MSEED", "N.B.EHZ.mseed", "N.A.EHZ.txt"):
        (tmp_path / "20180815").mkdir(exist_ok=True)
        (tmp_path / "20180815" / name).write_text(name)
    got = catalog.list_waveforms(spark, str(tmp_path)).collect()
    assert [(r.day, r.station, [p.rsplit("/", 1)[1] for p in r.paths]) for r in got] == [("20180815", "N.A", ["N.A.EHE.mseed", "N.A.EHN.mseed", "N.A.EHZ.MSEED"])]
    files = spark.createDataFrame([("a", 1), ("b", 2)], "path string, length long")
    one, two = (sinks.run_meta({"k": k}, files).first() for k in (1, 2))
    assert one.n_files == 2 and one.n_bytes == 3 and one.fingerprint != two.fingerprint
    assert one.fingerprint == sinks.run_meta({"k": 1}, files.orderBy(F.desc("path"))).first().fingerprint


# miniSEED
@pytest.mark.parametrize("encoding", [3, 4, 10, 11])
def test_miniseed(spark, tmp_path, encoding):
    rng = np.random.default_rng(encoding)
    x = [int(v) for v in np.cumsum(rng.choice([1, 3, 100, 50_000], 400) * rng.integers(-2, 3, 400))]
    (tmp_path / "a.mseed").write_bytes(mseed_record(x[:200], encoding, 3) + mseed_record(x[200:], encoding, 13) + mseed_record(x[:50], encoding, 50))
    (tmp_path / "broken.mseed").write_bytes(b"\1" * 600)
    got = mseed.traces(mseed.read_records(spark, str(tmp_path))).orderBy("start_us").collect()
    assert [(r.station, r.channel, r.rate, len(r.data)) for r in got] == [("NN.AB", "EHZ", 20.0, 400), ("NN.AB", "EHZ", 20.0, 50)]
    assert got[0].start_us == 1534294923500000 and list(got[0].data) == [float(np.float32(v)) for v in x]
