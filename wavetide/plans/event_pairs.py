"""Queries of the event-pair analysis and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetide.config import Config
from wavetide.functions.columns import day_key, micros, station_code
from wavetide.operators import merge, pairs, records, waveforms
from wavetide.plans.problems import CODE
from wavetide.session import durable
from wavetide.sources import catalog, packed
from wavetide.sources.tables import latest_quakes, quake_places, station_places, table

#: A wide network: four common stations within 300 km; events of magnitude 0.5 on are templates.
CONFIG = Config(temp_mag=0.5, num_sta=4, dist_thres=300.0)
#: A limit that binds in the test tables.
FEW = CONFIG.but(max_nbr=10)
#: Slow digitizers: windows of seconds instead of tenths, channels taken one by one.
SLOW = Config(samp_rate=10.0, freq_band=(0.2, 2.0), win_temp_p=(0.5, 2.5), win_temp_s=(0.5, 3.5), dt_thres=(1.0, 1.5), cc_thres=0.3, scc_thres=1.0, peak_separation=0.3, warm_up_s=10.0)
#: The windows of SLOW under the gates of CONFIG.
CHAIN = SLOW.but(temp_mag=CONFIG.temp_mag, num_sta=CONFIG.num_sta, dist_thres=CONFIG.dist_thres)


def _quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_quakes(table(spark, sf_dir, "quakes"))


def last_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.last_picks(table(spark, sf_dir, "picks"))


def _known_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_picks(spark, sf_dir).join(station_places(table(spark, sf_dir, "stations")).select("station"), "station", "left_semi")


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.event_ids(table(spark, sf_dir, "quakes"))


def travel_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.travel_times(last_picks(spark, sf_dir), _quakes(spark, sf_dir))


def cut_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "traces").select(station_code(F.col("station")).alias("station"), day_key(micros(F.col("starttime"))).alias("day")).filter("station is not null and day is not null")
    wanted = records.cut_requests(last_picks(spark, sf_dir), _quakes(spark, sf_dir), days)
    return wanted.select("station", "day", F.size("requests").alias("n"), F.array_join("requests.evid", " ").alias("evids"))


def _records(spark: SparkSession, sf_dir: str, config: Config = CONFIG) -> DataFrame:
    places = quake_places(table(spark, sf_dir, "quakes")).select("evid").join(_quakes(spark, sf_dir), "evid")
    return records.event_records(places, _known_picks(spark, sf_dir), config)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).withColumn("stations", F.array_join("stations", " "))


def nearest_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.candidate_edges(_records(spark, sf_dir), FEW).select("ref", "cand", "place")


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.candidate_pairs(_records(spark, sf_dir), CONFIG)


def station_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _records(spark, sf_dir)
    return pairs.station_pairs(pairs.candidate_pairs(known, CONFIG), known, station_places(table(spark, sf_dir, "stations")), CONFIG).select("evid_a", "evid_b", "station")


def station_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_pairs(spark, sf_dir).groupBy("station").agg(F.count(F.lit(1)).alias("n_pairs"))


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tasks").withColumn("station", station_code(F.col("station"))).filter("station is not null")


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.task_events(_tasks(spark, sf_dir), table(spark, sf_dir, "templates"), table(spark, sf_dir, "quakes"))


def task_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tasks(spark, sf_dir).groupBy("station").agg(F.count(F.lit(1)).alias("n_tasks"), F.max(F.greatest("row_a", "row_b")).alias("last_row"), F.min("event_idx_a").alias("first_event"))


def station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """station, event_idx, row: the stored window of each event at each station; the largest row of several."""
    rows = F.array(F.struct(F.col("event_idx_a").alias("event_idx"), F.col("row_a").alias("row")), F.struct(F.col("event_idx_b").alias("event_idx"), F.col("row_b").alias("row")))
    return _tasks(spark, sf_dir).select("station", F.explode(rows).alias("r")).groupBy("station", "r.event_idx").agg(F.max("r.row").alias("row"))


# text forms, written from the tables and read back
def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    quakes = _quakes(spark, sf_dir).filter("ot is not null").select("evid", micros(F.col("ot")).alias("ot_us"), "lat", "lon", "dep", "mag")
    picks = table(spark, sf_dir, "picks").select("evid", station_code(F.col("net_sta")).alias("station"), micros(F.col("tp")).alias("tp_us"), micros(F.col("ts")).alias("ts_us"), "line_no").filter("station is not null")
    return catalog.catalogue_lines(quakes, picks)


def catalogue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.parse_catalogue(_text(spark, sf_dir))[0].select("evid", "ot_us", "lat", "lon", "dep", "mag")


def catalogue_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.parse_catalogue(_text(spark, sf_dir))[1].select("evid", "station", "tp_us", "ts_us", F.col("ord").alias("line_no"))


def named_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older form, whose events end in 'evid_name', of all events from 1900 to 2100, with the number of their picks and P times."""
    names = _quakes(spark, sf_dir).filter("ot is not null").select("evid", F.concat_ws("_", "evid", "waveform_id").alias("named"), micros(F.col("ot")).alias("ot_us"), "lat", "lon", "dep", "mag")
    picks = table(spark, sf_dir, "picks").select("evid", station_code(F.col("net_sta")).alias("station"), micros(F.col("tp")).alias("tp_us"), micros(F.col("ts")).alias("ts_us"), "line_no").filter("station is not null")
    picks = picks.join(names.select("evid", "named"), "evid").drop("evid").withColumnRenamed("named", "evid")
    lines = catalog.catalogue_lines(names.drop("evid").withColumnRenamed("named", "evid"), picks)
    events, told = catalog.parse_named_catalogue(lines, -2_208_988_800_000_000, 4_102_444_800_000_000)
    counts = told.groupBy("evid").agg(F.count(F.lit(1)).alias("n_picks"), F.count("tp_us").alias("n_p"))
    return events.select("evid", "name", "ot_us").join(counts, "evid", "left").na.fill(0, ["n_picks", "n_p"])


def station_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    lines = table(spark, sf_dir, "stations").filter("net_sta is not null").select(F.concat_ws(",", "net_sta", *[shown(c) for c in ("lat", "lon", "ele")], F.lit("0")).alias("value"), F.lit(0).alias("split"), F.col("line_no").alias("ord"))
    return catalog.parse_stations(lines)


# observations
def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "pairs").filter("evid_a <> evid_b").select("evid_a", "evid_b", F.coalesce("n_common", F.lit(-1)).alias("ordinal"))
    origins = _quakes(spark, sf_dir).filter("ot is not null").select("evid", micros(F.col("ot")).alias("ot_us"))
    obs = merge.catalogue_observations(told, last_picks(spark, sf_dir), origins, (0.5, 0.8))
    return obs.withColumn("cc_u6", F.col("cc_u6") - F.col("ordinal"))  # a pair told again has another weight


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.last_observations(_observations(spark, sf_dir))


def well_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.well_observed(observations(spark, sf_dir), 4)


def dt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.dt_lines(well_observed(spark, sf_dir))


NUMBERS = ("event_a", "event_b", "station_no", "phase")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_a, event_b, station_no, phase, dt_u6, cc_u6."""
    numbers = catalog.station_numbers(station_places(table(spark, sf_dir, "stations")), any_code=True)
    obs = merge.numbered(observations(spark, sf_dir).join(numbers.select("station"), "station", "left_semi"), numbers)
    index = _quakes(spark, sf_dir).select("evid", "ord")
    side = lambda k: index.select(F.col("evid").alias(f"evid_{k}"), F.col("ord").alias(f"event_{k}"))
    return obs.join(side("a"), "evid_a").join(side("b"), "evid_b").select("event_a", "event_b", F.col("station_no").cast("long").alias("station_no"), "phase", "dt_u6", "cc_u6")


def packed_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _numbered(spark, sf_dir)
    return obs.select(merge.long_key(*map(F.col, NUMBERS)).alias("key"), *obs.columns)


def packed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in their binary form and read back."""
    contents = packed.pack_split(_numbered(spark, sf_dir).select(*merge.split_numbers(*map(F.col, NUMBERS)), "dt_u6", "cc_u6"))
    obs = packed.unpack_split(contents).select(*merge.whole_numbers(*map(F.col, ("key", "over_events", "over_station"))), "dt_u6", "cc_u6")
    return obs.select(merge.long_key(*map(F.col, NUMBERS)).alias("key"), *obs.columns)


def observation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = lambda c: F.format_string("%.6f", F.col(c) / 1e6)
    lines = observations(spark, sf_dir).select(F.concat_ws(" ", "evid_a", "evid_b", "station", "phase", shown("dt_u6"), shown("cc_u6")).alias("value"), F.lit(0).alias("split"), F.lit(0).alias("ord"))
    return catalog.parse_observations(lines, 1 << 40).drop("split", "ord")


# waveforms
def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    traces = table(spark, sf_dir, "traces").select("trace_id", station_code(F.col("station")).alias("station"), "channel", micros(F.col("starttime")).alias("start_us"), F.col("sampling_rate").alias("rate"), "data")
    return waveforms.clean_traces(traces)


def clean_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.aggregate("data", F.lit(0.0), lambda s, x: s + x * x)
    return _clean(spark, sf_dir).select("trace_id", "station", F.size("data").alias("npts"), F.round(F.sqrt(size / F.size("data")), 3).alias("rms"))


def _picked(spark: SparkSession, sf_dir: str) -> DataFrame:
    origins = _quakes(spark, sf_dir).filter("ot is not null").select("evid", micros(F.col("ot")).alias("ot_us"))
    return last_picks(spark, sf_dir).join(origins, "evid")


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waveforms.cut_windows(_picked(spark, sf_dir), _clean(spark, sf_dir), SLOW)


def _paired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All station pairs, and the windows of the events that one of them names at its station; both are stored, as each
    phase and each side of a pair reads them."""
    pairs_ = durable(station_pairs(spark, sf_dir))
    named = pairs_.select("station", F.explode(F.array("evid_a", "evid_b")).alias("evid")).distinct()
    asked = _picked(spark, sf_dir).join(named, ["station", "evid"], "left_semi")
    return pairs_, durable(waveforms.cut_windows(asked, _clean(spark, sf_dir), SLOW))


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of events in cells of 12 km, four times as wide as the partners' greatest distance in latitude."""
    return durable(waveforms.place_tiles(quake_places(table(spark, sf_dir, "quakes")).select("evid", "lat", "lon"), 4 * CONFIG.loc_dev / 111))


def cut_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir).select("station", "channel", "evid", "phase", "t_rel", F.size("window").alias("npts"))


def window_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of the station pairs, one channel at a time; ``kept`` marks what passes the thresholds."""
    near = waveforms.paired_windows(*_paired(spark, sf_dir))
    out = None
    for p, spec in SLOW.phases().items():
        obs = waveforms.correlate(near.filter(F.col("phase") == p), spec.data_npts, spec.temp_start, spec.temp_npts, SLOW.samp_rate, spec.shift_s, SLOW.peak_separation)
        obs = obs.withColumn("kept", waveforms.passes(spec.dt_limit, SLOW.cc_thres, SLOW.scc_thres))
        out = obs if out is None else out.unionByName(obs)
    return out


def correlated_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the station pairs' windows give, before the number of stations is asked for."""
    told, windows = _paired(spark, sf_dir)
    return waveforms.correlated_times(told, waveforms.event_windows(windows, CHAIN), CHAIN, _tiles(spark, sf_dir))


def differential_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near pairs, their common stations, correlated windows (P on one channel, S on two), ``num_sta`` stations a pair."""
    told, windows = _paired(spark, sf_dir)
    return waveforms.differential_times(told, waveforms.event_windows(windows, CHAIN), CHAIN, _tiles(spark, sf_dir))


#: Samples of a trace that serve as its station's wave, and by how many at most an event's windows begin later.
WAVE, DELAYS = 80, 9


def delayed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differential times of all station pairs with a known answer: a station's windows are stretches of one of its traces (the
    first with a sound beginning), an event's begin its ord modulo DELAYS samples late. So each pair agrees wholly, at the
    difference of the delays less the one sample of the convention."""
    data = F.slice("data", 1, WAVE)
    sound = (F.size("data") >= WAVE) & F.forall(data, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) <= 8_388_607), F.lit(False))) & (F.size(F.array_distinct(data)) >= WAVE - 10)
    waves = table(spark, sf_dir, "traces").withColumn("station", station_code(F.col("station"))).filter("station is not null").filter(sound)
    waves = waves.groupBy("station").agg(F.min_by(data, "trace_id").alias("wave"))
    told = durable(station_pairs(spark, sf_dir))
    named = told.select("station", F.explode(F.array("evid_a", "evid_b")).alias("evid")).distinct()
    late = _quakes(spark, sf_dir).select("evid", (F.col("ord") % DELAYS).cast("int").alias("late"))
    p, s = (F.slice("wave", F.col("late") + 1, spec.data_npts) for spec in CHAIN.phases().values())
    at = lambda name: F.lit(0.0).cast("float").alias(name)
    windows = named.join(waves, "station").join(late, "evid")
    windows = windows.select("station", "evid", at("tp_rel"), at("ts_rel"), F.lit(True).alias("has_p"), F.lit(True).alias("has_s"), F.array(p).alias("p_data"), F.array(s, s).alias("s_data"))
    return waveforms.differential_times(told, windows, CHAIN.but(cc_thres=0.9, scc_thres=None), _tiles(spark, sf_dir))


#: Rates of the tables' traces.
RATES = (1.0, 2.0, 4.0, 5.0, 10.0)


def window_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of all windows cut at the traces' own rates, without the band-pass, which SQL cannot say."""
    clean, picked = _clean(spark, sf_dir), _picked(spark, sf_dir)
    out = None
    for rate in RATES:
        cut = waveforms.cut_windows(picked, clean.filter(F.col("rate") == rate), SLOW.but(freq_band=(None, None), samp_rate=rate))
        out = cut.withColumn("rate", F.lit(rate)) if out is None else out.unionByName(cut.withColumn("rate", F.lit(rate)))
    return out.select("station", "channel", "rate", "evid", "phase", F.posexplode("window").alias("i", "v")).withColumn("v", F.col("v").cast("double"))


def differential_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.dt_lines(differential_times(spark, sf_dir))


def vector_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the next three: the template is elements 17 to 48, 32 lags."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    a = vectors.select("vec_id", (F.col("vec_id") % 5).cast("float").alias("t_a"), F.array("embedding").alias("data_a"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k")).withColumn("other", F.col("vec_id") + F.col("k"))
    b = vectors.select(F.col("vec_id").alias("other"), (F.col("vec_id") % 5).cast("float").alias("t_b"), F.array("embedding").alias("data_b"))
    obs = waveforms.correlate(a.join(b, "other"), 64, 16, 32, 1.0, -16.0, 2.0)
    return obs.select("vec_id", "other", F.rint(F.col("cc") * 1e6).cast("int").alias("cc_u6"), "lag", F.rint(F.col("scc") * 1e3).cast("int").alias("scc_e3"), F.col("dt").cast("int").alias("dt"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        last_picks, event_ids, travel_times, cut_requests, event_records, nearest_edges, candidate_pairs, station_pairs, station_pair_counts, task_events, task_manifest, station_rows,
        catalogue_events, catalogue_picks, named_catalogue, station_list, observations, well_observed, dt_lines, packed_observations, packed_records, observation_lines, clean_traces, cut_windows, window_correlations, correlated_times, differential_times, differential_lines, delayed_times, window_samples, vector_correlations,
    )
}

_Q = """q AS (SELECT evid, unnest(r) FROM (SELECT evid, arg_max(struct_pack(ot_us := epoch_us(ot), lat := lat, lon := lon, dep := dep, mag := mag, waveform_id := waveform_id, ord := ord), ord) AS r FROM quakes WHERE evid IS NOT NULL GROUP BY evid))"""
_LP = f"""named AS (SELECT evid, {CODE.format("net_sta")} AS station, epoch_us(tp) AS tp_us, epoch_us(ts) AS ts_us, line_no FROM picks),
lp AS (SELECT evid, station, unnest(p) FROM (SELECT evid, station, arg_max(struct_pack(tp_us := tp_us, ts_us := ts_us), line_no) AS p FROM named WHERE evid IS NOT NULL AND station IS NOT NULL GROUP BY ALL))"""
_REC = f"""{_Q}, {_LP}, st AS (SELECT station, unnest(s) FROM (SELECT {CODE.format("net_sta")} AS station, arg_max(struct_pack(lat := lat, lon := lon), line_no) AS s FROM stations GROUP BY ALL)
  WHERE station IS NOT NULL AND NOT isnan(s.lat) AND abs(s.lat) <= 90 AND NOT isnan(s.lon) AND abs(s.lon) <= 180),
pe AS (SELECT evid, list_sort(list(station)) AS stations FROM lp WHERE station IN (SELECT station FROM st) GROUP BY evid HAVING count(*) >= 4),
rec AS (SELECT evid, ot_us, lat, lon, dep, mag, stations, coalesce(NOT isnan(mag) AND mag >= 0.5, false) AND len(stations) >= 6 AS is_temp FROM q JOIN pe USING (evid)
  WHERE ot_us IS NOT NULL AND NOT isnan(lat) AND abs(lat) <= 90 AND NOT isnan(lon) AND abs(lon) <= 180 AND NOT isnan(dep)),
box AS (SELECT a.evid AS ref, b.evid AS cand, a.stations AS sa, b.stations AS sb, sqrt(pow(111 * abs(b.lat - a.lat), 2) + pow(111 * abs(b.lon - a.lon) * cos(a.lat * pi() / 180), 2) + pow(abs(b.dep - a.dep), 2)) AS dist
  FROM rec a JOIN rec b ON b.lat BETWEEN a.lat - 0.028 AND a.lat + 0.028 WHERE 111 * abs(b.lat - a.lat) < 3 AND 111 * abs(b.lon - a.lon) * cos(a.lat * pi() / 180) < 3 AND abs(b.dep - a.dep) < 4
  AND abs(b.ot_us - a.ot_us) <= 730 * 86400000000 AND (a.is_temp OR b.is_temp)),
edges AS (SELECT ref, cand, CAST(rank() OVER (PARTITION BY ref ORDER BY dist) AS INTEGER) AS place FROM box WHERE len(list_intersect(sa, sb)) >= 4),
cp AS (SELECT DISTINCT least(ref, cand) AS evid_a, greatest(ref, cand) AS evid_b FROM edges WHERE ref <> cand AND place <= 2001)"""
_FLAT = "111 * sqrt(pow(cos(radians((s.lat + {e}.lat) / 2)) * (s.lon - {e}.lon), 2) + pow(s.lat - {e}.lat, 2))"
_SP = f"""{_REC}, common AS (SELECT evid_a, evid_b, unnest(list_intersect(a.stations, b.stations)) AS station, a.lat AS la, a.lon AS oa, b.lat AS lb, b.lon AS ob FROM cp JOIN rec a ON a.evid = evid_a JOIN rec b ON b.evid = evid_b),
far AS (SELECT evid_a, evid_b, s.station, 111 * sqrt(pow(cos(radians((s.lat + la) / 2)) * (s.lon - oa), 2) + pow(s.lat - la, 2)) AS da, 111 * sqrt(pow(cos(radians((s.lat + lb) / 2)) * (s.lon - ob), 2) + pow(s.lat - lb, 2)) AS db FROM common JOIN st s USING (station)),
sp AS (SELECT evid_a, evid_b, station FROM far WHERE least(da, db) <= 300 AND greatest(da, db) >= 1.5 QUALIFY count(*) OVER (PARTITION BY evid_a, evid_b) >= 4)"""
_TASKS = f"t AS (SELECT * REPLACE ({CODE.format('station')} AS station) FROM tasks WHERE {CODE.format('station')} IS NOT NULL)"
_OBS = f"""{_Q}, {_LP}, rel AS (SELECT evid, station, tp_us - ot_us AS p, ts_us - ot_us AS s FROM lp JOIN q USING (evid) WHERE ot_us IS NOT NULL),
both_ AS (SELECT evid_a, evid_b, a.station, coalesce(n_common, -1) AS ordinal, a.p - b.p AS p, a.s - b.s AS s FROM pairs JOIN rel a ON a.evid = evid_a JOIN rel b ON b.evid = evid_b AND a.station = b.station WHERE evid_a <> evid_b),
told AS (SELECT evid_a, evid_b, station, ordinal, 'P' AS phase, CAST(p AS INTEGER) AS dt_u6, CAST(round_even((1.0::DOUBLE - abs(p)::DOUBLE / 500000) * 1e6, 0) AS INTEGER) - ordinal AS cc_u6 FROM both_ WHERE abs(p) <= 500000
  UNION ALL SELECT evid_a, evid_b, station, ordinal, 'S', CAST(s AS INTEGER), CAST(round_even((1.0::DOUBLE - abs(s)::DOUBLE / 800000) * 1e6, 0) AS INTEGER) - ordinal FROM both_ WHERE abs(s) <= 800000),
obs AS (SELECT evid_a, evid_b, station, phase, arg_max(dt_u6, ordinal) AS dt_u6, arg_max(cc_u6, ordinal) AS cc_u6 FROM told GROUP BY ALL),
well AS (SELECT * FROM obs WHERE (evid_a, evid_b) IN (SELECT (evid_a, evid_b) FROM obs GROUP BY evid_a, evid_b HAVING count(DISTINCT station) >= 4))"""

SQL: dict[str, str] = {
    "last_picks": f"WITH {_LP} SELECT * FROM lp",
    "event_ids": "SELECT evid, ord, strftime(make_timestamp(epoch_us(ot)), '%Y%m%d%H%M%S.') || substr(strftime(make_timestamp(epoch_us(ot)), '%f'), 1, 2) AS waveform_name, strftime(make_timestamp(epoch_us(ot)), '%Y%m%d') AS day, epoch_us(ot) / 1e6 AS ot_s FROM quakes WHERE ot IS NOT NULL",
    "travel_times": f"WITH {_Q}, {_LP} SELECT evid, station, coalesce(CAST((tp_us - ot_us) / 1e6 AS FLOAT), CAST(-1 AS FLOAT)) AS tp_rel, coalesce(CAST((ts_us - ot_us) / 1e6 AS FLOAT), CAST(-1 AS FLOAT)) AS ts_rel FROM lp JOIN q USING (evid) WHERE ot_us IS NOT NULL",
    "cut_requests": f"""WITH {_Q}, {_LP}, days AS (SELECT DISTINCT {CODE.format("station")} AS station, strftime(make_timestamp(epoch_us(starttime)), '%Y%m%d') AS day FROM traces WHERE starttime IS NOT NULL),
w AS (SELECT station, strftime(make_timestamp(ot_us), '%Y%m%d') AS day, evid, coalesce((tp_us - ot_us) / 1e6, 1e12) AS travel FROM lp JOIN q USING (evid) WHERE ot_us IS NOT NULL)
SELECT station, day, CAST(count(*) AS INTEGER) AS n, string_agg(evid, ' ' ORDER BY travel, evid) AS evids FROM w JOIN days USING (station, day) GROUP BY ALL""",
    "event_records": f"WITH {_REC} SELECT * REPLACE (array_to_string(stations, ' ') AS stations) FROM rec",
    "nearest_edges": f"WITH {_REC} SELECT * FROM edges WHERE place <= 11",
    "candidate_pairs": f"WITH {_REC} SELECT * FROM cp",
    "station_pairs": f"WITH {_SP} SELECT * FROM sp",
    "station_pair_counts": f"WITH {_SP} SELECT station, count(*) AS n_pairs FROM sp GROUP BY ALL",
    "task_events": f"""WITH {_TASKS}, e AS (SELECT CAST(idx AS BIGINT) AS k, evid FROM templates UNION ALL SELECT ord, evid FROM quakes WHERE ord >= 100)
SELECT station, row_a, row_b, a.evid AS evid_a, b.evid AS evid_b FROM t JOIN e a ON a.k = event_idx_a JOIN e b ON b.k = event_idx_b""",
    "task_manifest": f"WITH {_TASKS} SELECT station, count(*) AS n_tasks, max(greatest(row_a, row_b)) AS last_row, min(event_idx_a) AS first_event FROM t GROUP BY ALL",
    "station_rows": f"WITH {_TASKS} SELECT station, event_idx, max(row) AS row FROM (SELECT station, event_idx_a AS event_idx, row_a AS row FROM t UNION ALL SELECT station, event_idx_b, row_b FROM t) GROUP BY ALL",
    "catalogue_events": f"WITH {_Q} SELECT evid, ot_us, CASE WHEN isnan(lat) THEN NULL ELSE lat END AS lat, CASE WHEN isnan(lon) THEN NULL ELSE lon END AS lon, CASE WHEN isnan(dep) THEN NULL ELSE dep END AS dep, CASE WHEN isnan(mag) THEN NULL ELSE mag END AS mag FROM q WHERE ot_us IS NOT NULL",
    "catalogue_picks": f"WITH {_Q}, {_LP} SELECT evid, station, tp_us, ts_us, line_no FROM named JOIN q USING (evid) WHERE station IS NOT NULL AND ot_us IS NOT NULL",
    "named_catalogue": f"""WITH {_Q}, {_LP}, c AS (SELECT evid, count(*) AS n_picks, count(tp_us) AS n_p FROM named WHERE station IS NOT NULL GROUP BY evid)
SELECT evid, waveform_id AS name, ot_us, coalesce(n_picks, 0) AS n_picks, coalesce(n_p, 0) AS n_p FROM q LEFT JOIN c USING (evid) WHERE ot_us > -2208988800000000 AND ot_us < 4102444800000000""",
    "station_list": f"SELECT station, CASE WHEN isnan(s.lat) THEN NULL ELSE s.lat END AS lat, CASE WHEN isnan(s.lon) THEN NULL ELSE s.lon END AS lon, CASE WHEN isnan(s.ele) THEN NULL ELSE s.ele END AS ele FROM (SELECT {CODE.format('net_sta')} AS station, arg_max(struct_pack(lat := lat, lon := lon, ele := ele), line_no) AS s FROM stations GROUP BY ALL) WHERE station IS NOT NULL",
    "observations": f"WITH {_OBS} SELECT * FROM obs",
    "well_observed": f"WITH {_OBS} SELECT * FROM well",
    "dt_lines": f"""WITH {_OBS} SELECT evid_a, evid_b, printf('# %9d %9d 0.0', CAST(evid_a AS BIGINT), CAST(evid_b AS BIGINT)) || chr(10) ||
  string_agg(printf('%-7s %8.5f %.4f %s', split_part(station, '.', 2), dt_u6 / 1e6, cc_u6 / 1e6, phase), chr(10) ORDER BY station, phase) AS block FROM well GROUP BY evid_a, evid_b""",
    "packed_observations": f"""WITH {_OBS}, st AS (SELECT station FROM (SELECT {CODE.format("net_sta")} AS station, arg_max(struct_pack(lat := lat, lon := lon), line_no) AS s FROM stations GROUP BY ALL)
  WHERE station IS NOT NULL AND NOT isnan(s.lat) AND abs(s.lat) <= 90 AND NOT isnan(s.lon) AND abs(s.lon) <= 180),
nos AS (SELECT station, CAST(row_number() OVER (ORDER BY station) - 1 AS BIGINT) AS no FROM st),
x AS (SELECT a.ord AS ea, b.ord AS eb, no, phase, dt_u6, cc_u6 FROM obs JOIN q a ON a.evid = evid_a JOIN q b ON b.evid = evid_b JOIN nos USING (station))
SELECT ((ea << 20) | eb) << 11 | (no << 1) | CASE WHEN phase = 'S' THEN 1 ELSE 0 END AS key, ea AS event_a, eb AS event_b, no AS station_no, phase, dt_u6, cc_u6 FROM x""",
    "observation_lines": f"WITH {_OBS} SELECT CAST(evid_a AS BIGINT) AS evid_a, CAST(evid_b AS BIGINT) AS evid_b, station, phase, dt_u6, cc_u6 FROM obs",
    "cut_windows": f"""WITH {_Q}, {_LP}, asks AS (SELECT evid, station, unnest([struct_pack(phase := 'P', at_us := tp_us, b := tp_us - 1500000, e := tp_us + 3500000, npts := 50),
  struct_pack(phase := 'S', at_us := ts_us, b := ts_us - 2000000, e := ts_us + 5000000, npts := 70)]) AS k, ot_us FROM lp JOIN q USING (evid) WHERE ot_us IS NOT NULL),
tr AS (SELECT {CODE.format("station")} AS station, channel, epoch_us(starttime) AS a, sampling_rate AS rate, len(data) AS n FROM traces WHERE starttime IS NOT NULL AND sampling_rate >= 0.001 AND sampling_rate < 1e6 AND len(data) > 0)
SELECT DISTINCT station, channel, evid, k.phase AS phase, CAST((k.at_us - ot_us) / 1e6 AS FLOAT) AS t_rel, CAST(k.npts AS INTEGER) AS npts FROM asks JOIN tr USING (station)
  WHERE k.b >= a AND k.e <= a + CAST(trunc((n - 1) / rate * 1e6) AS BIGINT) AND (round_even((k.b - a) / 1e6 * 10, 0) + k.npts - 1) * (rate / 10) <= n - 1 + 1e-9""",
    "delayed_times": f"""WITH {_SP}, waves AS (SELECT DISTINCT {CODE.format("station")} AS station FROM traces
  WHERE len(data) >= 80 AND len(list_filter(data[1:80], lambda x: x IS NULL OR isnan(x) OR abs(x) > 8388607)) = 0 AND len(list_distinct(data[1:80])) >= 70),
late AS (SELECT evid_a, evid_b, station, (b.ord % 9) - (a.ord % 9) AS later FROM sp JOIN q a ON a.evid = evid_a JOIN q b ON b.evid = evid_b WHERE station IN (SELECT station FROM waves))
SELECT evid_a, evid_b, station, phase, CAST((later - 1) * 100000 AS INTEGER) AS dt_u6, 1000000 AS cc_u6 FROM late, (SELECT unnest(['P', 'S']) AS phase)
  QUALIFY count(*) OVER (PARTITION BY evid_a, evid_b, phase) >= 4""",
    "window_samples": f"""WITH {_Q}, {_LP}, asks AS (SELECT evid, station, unnest([struct_pack(phase := 'P', b := tp_us - 1500000, e := tp_us + 3500000, seconds := 5),
  struct_pack(phase := 'S', b := ts_us - 2000000, e := ts_us + 5000000, seconds := 7)]) AS k FROM lp JOIN q USING (evid) WHERE ot_us IS NOT NULL),
tr AS (SELECT trace_id, {CODE.format("station")} AS station, channel, epoch_us(starttime) AS a, sampling_rate AS rate, len(data) AS n, data FROM traces WHERE starttime IS NOT NULL AND sampling_rate IN {RATES} AND len(data) > 0),
hits AS (SELECT station, channel, rate, evid, k.phase AS phase, any_value(k.seconds * rate) AS npts, min(trace_id) AS trace_id, arg_min(CAST(round_even((k.b - a) / 1e6 * rate, 0) AS BIGINT), trace_id) AS first FROM asks JOIN tr USING (station)
  WHERE k.b >= a AND k.e <= a + CAST(trunc((n - 1) / rate * 1e6) AS BIGINT) AND round_even((k.b - a) / 1e6 * rate, 0) + k.seconds * rate - 1 <= n - 1 GROUP BY ALL),
smp AS (SELECT trace_id, rate, n, generate_subscripts(data, 1) - 1 AS i, CAST(unnest(data) AS DOUBLE) AS y FROM tr WHERE trace_id IN (SELECT trace_id FROM hits)),
zer AS (SELECT * REPLACE (CASE WHEN y IS NULL OR NOT isfinite(y) THEN 0 ELSE y END AS y) FROM smp),
fit AS (SELECT trace_id, avg(y) AS mean, coalesce(regr_slope(y, i), 0) AS slope, least(CAST(floor(0.05 * any_value(n)) AS BIGINT), CAST(10 * any_value(rate) AS BIGINT), any_value(n) // 2) AS m FROM zer GROUP BY trace_id),
clean AS (SELECT trace_id, i, (y - mean - slope * (i - (n - 1) / 2)) * CASE WHEN i < m THEN 0.5 * (1 - cos(pi() * i / m)) WHEN i >= n - m THEN 0.5 * (1 - cos(pi() * (n - 1 - i) / m)) ELSE 1 END AS v FROM zer JOIN fit USING (trace_id))
SELECT station, channel, hits.rate, evid, phase, CAST(i - first AS INTEGER) AS i, CAST(CAST(v AS FLOAT) AS DOUBLE) AS v FROM hits JOIN clean USING (trace_id) WHERE i BETWEEN first AND first + npts - 1""",
    "vector_correlations": """WITH p AS (SELECT a.vec_id, b.vec_id AS other, a.embedding AS x, b.embedding AS y FROM embeddings a JOIN embeddings b ON b.vec_id - a.vec_id BETWEEN 1 AND 3),
g AS (SELECT vec_id, other, lag, x[lag + 1 + i]::DOUBLE AS u, y[16 + i]::DOUBLE AS v FROM p, generate_series(0, 31) l(lag), generate_series(1, 32) k(i)),
c AS (SELECT vec_id, other, lag, abs(coalesce(corr(u, v), 0)) AS cc FROM g GROUP BY ALL),
m AS (SELECT vec_id, other, max(cc) AS cc, arg_max(lag, cc) AS lag FROM c GROUP BY ALL),
far AS (SELECT c.vec_id, c.other, c.cc FROM c JOIN m USING (vec_id, other) WHERE abs(c.lag - m.lag) > 2),
med AS (SELECT vec_id, other, quantile_disc(cc, 0.5) AS med FROM far GROUP BY ALL),
mad AS (SELECT vec_id, other, any_value(med) AS med, quantile_disc(abs(cc - med), 0.5) AS mad FROM far JOIN med USING (vec_id, other) GROUP BY ALL)
SELECT vec_id, other, CAST(round_even(cc * 1e6, 0) AS INTEGER) AS cc_u6, CAST(lag AS INTEGER) AS lag, CAST(round_even((cc - med) / mad * 1e3, 0) AS INTEGER) AS scc_e3, CAST(vec_id % 5 - 16 + lag - other % 5 AS INTEGER) AS dt FROM m JOIN mad USING (vec_id, other)""",
}
SQL["packed_records"] = SQL["packed_observations"]
