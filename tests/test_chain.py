"""The chain from near pairs to merged times on made-up tables."""

import numpy as np
import pytest
from mseed_files import mseed_record
from pyspark.sql import functions as F

from wavetide.config import Config
from wavetide.operators import waveforms
from wavetide.plans import event_pairs
from wavetide.sources import mseed

SECOND, DAY = 1_000_000, 86_400_000_000
START = 1_073_433_600 * SECOND


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events 1 and 5 lie together, 2 to 4 far from them and each other; six stations record the same wave at each pick,
    station F another one at event 5. The picks of event 5 come 0.3 s late at all stations."""
    rng, root = np.random.default_rng(1), tmp_path_factory.mktemp("chain")
    at = {"1": (33.0, -116.0), "2": (33.3, -116.0), "3": (33.6, -116.0), "4": (33.9, -116.0), "5": (33.001, -116.0)}
    ot = {e: START + k * DAY for k, e in enumerate(at)}
    quakes = [(e, ot[e], *at[e], 5.0, 2.0, e, k) for k, e in enumerate(at)]
    names = [f"N.{c}" for c in "ABCDEF"]
    picks, traces = [], []
    for s in names:
        waves = {c: rng.normal(size=900) for c in ("EHE", "EHN", "EHZ")}
        for e in at:
            late = 300_000 if e == "5" else 0
            picks.append((e, s, ot[e] + 30 * SECOND + late, ot[e] + 40 * SECOND + late, len(picks)))
            for c, wave in waves.items():
                data = rng.normal(size=900) if (s, e) == ("N.F", "5") else wave
                traces.append((len(traces), s, c, ot[e], 10.0, data.astype(np.float32).tolist()))
    stations = [(s, 33.2, -116.2 + k / 50, 0.0, k) for k, s in enumerate(names)]

    def put(name, rows, schema, *times):
        df = spark.createDataFrame(rows, schema)
        df.withColumns({t: F.timestamp_micros(t) for t in times}).write.parquet(f"{root}/{name}.parquet")

    put("quakes", quakes, "evid string, ot long, lat double, lon double, dep double, mag double, waveform_id string, ord long", "ot")
    put("picks", picks, "evid string, net_sta string, tp long, ts long, line_no long", "tp", "ts")
    put("stations", stations, "net_sta string, lat double, lon double, ele double, line_no long")
    put("traces", traces, "trace_id long, station string, channel string, starttime long, sampling_rate double, data array<float>", "starttime")
    return str(root)


def test_chain_correlates_the_near_pairs(spark, tables):
    assert [tuple(r) for r in event_pairs.candidate_pairs(spark, tables).collect()] == [("1", "5")]
    got = event_pairs.window_correlations(spark, tables).collect()
    assert {(r.evid_a, r.evid_b) for r in got} == {("1", "5")} and len(got) == 6 * 3 * 2
    times = event_pairs.differential_times(spark, tables).collect()
    alike = {(r.station, r.phase): r for r in times if r.station != "N.F"}
    assert set(alike) == {(f"N.{c}", p) for c in "ABCDE" for p in "PS"}
    # equal waves at equal times after the origins, picks 0.3 s apart: 0 less the one sample of the convention
    assert all((r.evid_a, r.evid_b) == ("1", "5") and abs(r.dt_u6 + 100_000) <= 2 and r.cc_u6 > 990_000 for r in alike.values())
    assert event_pairs.correlated_times(spark, tables).count() == len(times)
    (line,) = event_pairs.differential_lines(spark, tables).collect()
    assert line.block.startswith("# %9d %9d 0.0\n" % (1, 5)) and line.block.count("\n") == len(times)


def test_from_waveform_files_to_times(spark, tmp_path):
    """Two events 60 s apart, the second one's waves 0.2 s later after its origin; four stations with three files a day, a fifth with two,
    a sixth with a gap in one file."""
    rng, rate = np.random.default_rng(2), 20
    day = tmp_path / "20180815"
    day.mkdir()
    start = 1_534_294_920_500_000  # of a record at 01:02:00.5
    for k, code in enumerate("ABCDEF"):
        for channel in ("EHE", "EHN", "EHZ"):
            if (code, channel) == ("E", "EHN"):
                continue
            wave = np.cumsum(rng.integers(-2000, 2000, 200))
            x = rng.integers(-30, 30, 120 * rate)
            x[20 * rate : 30 * rate] += wave
            x[80 * rate + 4 : 90 * rate + 4] += wave
            pieces = [mseed_record(x[i : i + 400].tolist(), 11, (i // rate) % 60, rate, code, channel, 2 + i // rate // 60) for i in range(0, len(x), 400)]
            if (code, channel) == ("F", "EHZ"):
                del pieces[3]
            (day / f"NN.{code}.{channel}.mseed").write_bytes(b"".join(pieces))
    days = mseed.station_day_traces(spark, str(tmp_path))
    assert {(r.station, r.channel, len(r.data), r.start_us) for r in days.collect()} == {(f"NN.{c}", ch, 2400, start) for c in "ABCD" for ch in ("EHE", "EHN", "EHZ")}
    asked = [(e, f"NN.{c}", start + at * SECOND, start + (at + 22) * SECOND, start + (at + 26) * SECOND) for e, at in (("1", 0), ("2", 60)) for c in "ABCDEF"]
    picks = spark.createDataFrame(asked, "evid string, station string, ot_us long, tp_us long, ts_us long")
    config = Config(samp_rate=20.0, freq_band=(0.5, 5.0), win_temp_p=(0.5, 2.0), win_temp_s=(0.5, 2.5), dt_thres=(1.0, 1.0), cc_thres=0.9, scc_thres=2.0, warm_up_s=5.0, num_sta=4)
    windows = waveforms.event_windows(waveforms.cut_windows(picks, waveforms.clean_traces(days), config), config)
    pairs = spark.createDataFrame([("1", "2", f"NN.{c}") for c in "ABCDEF"], "evid_a string, evid_b string, station string")
    got = waveforms.differential_times(pairs, windows, config).collect()
    # a's wave stands 0.2 s earlier in its window, and one sample is the convention's
    assert {(r.station, r.phase, r.dt_u6) for r in got} == {(f"NN.{c}", p, -250_000) for c in "ABCD" for p in "PS"}
    assert waveforms.differential_times(pairs, windows, config.but(num_sta=5)).count() == 0
