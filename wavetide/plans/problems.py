"""The numbered problems' queries and, where SQL can say them, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetide.functions.columns import DAY_US, micros, station_code
from wavetide.operators import grid, intervals, nearby, orphans, spikes, topn, tree
from wavetide.sources.tables import quake_places, station_places, station_terms, table


# 1: references to records that do not exist
def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks = table(spark, sf_dir, "picks").select(
        F.lit("picks").alias("table_name"), station_code(F.col("net_sta")).alias("key"), micros(F.coalesce("tp", "ts")).alias("time_us"), F.col("line_no").alias("row_id")
    )
    traces = table(spark, sf_dir, "traces").select(
        F.lit("traces").alias("table_name"), station_code(F.col("station")).alias("key"), micros(F.col("starttime")).alias("time_us"), F.col("trace_id").alias("row_id")
    )
    return picks.unionByName(traces)


def p1_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_references(references(spark, sf_dir), station_terms(table(spark, sf_dir, "stations")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_orphans(spark, sf_dir).select("table_name", "period", "row_id")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(references(spark, sf_dir), station_terms(table(spark, sf_dir, "stations")))


# 2: implausible spikes in measurements
def p2_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    traces = table(spark, sf_dir, "traces").withColumn("station", station_code(F.col("station")))
    return spikes.implausible_samples(traces)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_judged(spark, sf_dir).select("trace_id", "sample_idx")


def p2_usual_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    traces = table(spark, sf_dir, "traces").withColumn("station", station_code(F.col("station"))).filter("station is not null")
    return spikes.usual_steps(traces)


# 3: irregular readings onto a regular grid
def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "traces").select(
        station_code(F.col("station")).alias("station"), "channel", "date", micros(F.col("starttime")).alias("start_us"), F.col("sampling_rate").alias("rate"), "data"
    )


def p3_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.regular_series(_readings(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.regular_series(_readings(spark, sf_dir), only_filled=True).select("station", "channel", "date", "slot")


def p3_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series without the imputed values, which SQL cannot say."""
    return p3_series(spark, sf_dir).select("station", "channel", "date", "slot", F.when(~F.col("filled"), F.round("value", 6)).alias("mean"), "filled")


def p3_how(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the slots of each day came about: read, imputed, unsettled (no rest found) or line (no model)."""
    return p3_series(spark, sf_dir).groupBy("date", "how").agg(F.count(F.lit(1)).alias("n_slots"))


def p3_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_series(spark, sf_dir).groupBy("station", "channel", "date").agg(F.count(F.lit(1)).alias("n_slots"), F.count_if("filled").alias("n_filled"))


# 4: a few keys holding most records
def p4_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = table(spark, sf_dir, "tasks").withColumn("station", station_code(F.col("station")))
    return tree.window_counts(tasks)


def p4_station_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.roll_up(p4_window_counts(spark, sf_dir), ["station"], "row_a", {"n": F.sum, "row_b_min": F.min, "row_b_max": F.max})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = p4_window_counts(spark, sf_dir)
    stations = tree.roll_up(windows, ["station"], "row_a", {"n": F.sum})
    return tree.heavy_windows(windows, stations, table(spark, sf_dir, "tasks").count())


# 5: points near other points or regions
def p5_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    quakes = quake_places(table(spark, sf_dir, "quakes")).filter("dep between -5 and 700").withColumnRenamed("evid", "key")
    return nearby.points_in_balls(quakes, station_places(table(spark, sf_dir, "stations")).withColumnRenamed("station", "centre"), 10.0)


def p5_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    quakes = quake_places(table(spark, sf_dir, "quakes")).filter("dep between -5 and 700")
    return nearby.near_pairs(quakes.select(F.col("evid").alias("key"), "lat", "lon", "dep", micros(F.col("ot")).alias("t_us")), 1.0, 20 * DAY_US)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near_station = p5_stations(spark, sf_dir).select(F.lit("station").alias("kind"), F.col("key").alias("key_a"), F.col("centre").alias("key_b"))
    return near_station.unionByName(p5_quakes(spark, sf_dir).select(F.lit("quake").alias("kind"), "key_a", "key_b"))


# 6: overlapping and gapped time intervals
def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "traces")
        .select(station_code(F.col("station")).alias("station"), "channel", micros(F.col("starttime")).alias("start_us"), micros(F.col("endtime")).alias("end_us"))
        .filter("station is not null")
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.periods_and_gaps(recorded(spark, sf_dir), ["station", "channel"], 2_000_000, 604_800_000_000)


# 7: top N items within every group
def p7_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.nearest_partners(table(spark, sf_dir, "pairs"), quake_places(table(spark, sf_dir, "quakes")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_ranked(spark, sf_dir).select("evid", "nbr_evid")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_report, p2_found, p2_usual_steps, p3_found, p3_per_source, p3_series, p3_means, p3_how, p5_found, p4_found, p4_window_counts, p4_station_counts, p6_found, p7_found, p7_ranked)
}

CODE = "nullif(upper(trim({}, ' ' || chr(9))), '')"
US = "epoch_us({})"
DAY = "strftime(make_timestamp({}), '%Y-%m-%d')"

_REFS = f"""refs AS (
  SELECT 'picks' AS table_name, {CODE.format("net_sta")} AS key, {US.format("coalesce(tp, ts)")} AS t, line_no AS row_id FROM picks
  UNION ALL SELECT 'traces', {CODE.format("station")}, {US.format("starttime")}, trace_id FROM traces),
terms AS (SELECT {CODE.format("net_sta")} AS key, {US.format("opened")} AS a, {US.format("closed")} AS b FROM stations),
orphans AS (
  SELECT table_name, coalesce({DAY.format("t")}, 'none') AS period, row_id, key FROM refs
  WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM terms WHERE terms.key = refs.key
    AND (t IS NULL OR ((a IS NULL OR a <= t) AND (b IS NULL OR t < b)))))"""

_WINDOWS = f"""windows AS (SELECT {CODE.format("station")} AS station, row_a, count(*) AS n, min(row_b) AS row_b_min, max(row_b) AS row_b_max FROM tasks GROUP BY ALL)"""

PLACES = """places AS (SELECT * FROM (SELECT evid, arg_max(struct_pack(lat := lat, lon := lon, dep := dep, ot := ot), ord) AS q FROM quakes WHERE evid IS NOT NULL GROUP BY evid)
  WHERE NOT isnan(q.lat) AND abs(q.lat) <= 90 AND NOT isnan(q.lon) AND abs(q.lon) <= 180)"""

KM = "111 * sqrt(pow(cos(radians(({a}.lat + {b}.lat) / 2)) * CASE WHEN abs({a}.lon - {b}.lon) > 180 THEN 360 - abs({a}.lon - {b}.lon) ELSE abs({a}.lon - {b}.lon) END, 2) + pow({a}.lat - {b}.lat, 2))"

_RANKED = f"""{PLACES}, edges AS (SELECT DISTINCT evid_a AS a, evid_b AS b FROM pairs WHERE evid_a <> evid_b UNION SELECT evid_b, evid_a FROM pairs WHERE evid_a <> evid_b),
near AS (SELECT a AS evid, b AS nbr_evid, CAST(floor({KM.format(a="x.q", b="y.q")} * 1e6 + 0.5) AS BIGINT) AS mm FROM edges JOIN places x ON x.evid = a JOIN places y ON y.evid = b),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY evid ORDER BY mm, nbr_evid) AS INTEGER) AS rank FROM near)"""

_SAMPLES = f"""named AS (SELECT trace_id, {CODE.format("station")} AS station, channel, date, {US.format("starttime")} AS a, sampling_rate AS rate, data FROM traces),
samples AS (SELECT trace_id, station, channel, date, a, rate, CAST(unnest(data) AS DOUBLE) AS x, generate_subscripts(data, 1) - 1 AS i FROM named WHERE station IS NOT NULL)"""

_STEPS = f"""{_SAMPLES}, steps AS (SELECT station, channel, date, median(abs(x - y)) AS usual_step
  FROM (SELECT *, lag(x) OVER (PARTITION BY trace_id ORDER BY i) AS y FROM samples) WHERE isfinite(x) AND isfinite(y) GROUP BY ALL)"""

_BAD = f"""{_STEPS}, near AS (SELECT trace_id, i, x, s.usual_step * 30 AS far, lag(x) OVER w AS b, lead(x, 1) OVER w AS x1, lead(x, 2) OVER w AS x2, lead(x, 3) OVER w AS x3,
  CASE WHEN x = lag(x) OVER w THEN 0 ELSE 1 END AS new FROM samples LEFT JOIN steps s USING (station, channel, date) WINDOW w AS (PARTITION BY trace_id ORDER BY i)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY trace_id ORDER BY i) AS run FROM near),
stuck AS (SELECT trace_id, i FROM (SELECT *, count(*) OVER (PARTITION BY trace_id, run) AS n FROM runs) WHERE n >= 20 AND NOT isnan(x) AND x IS NOT NULL),
spike AS (
  SELECT trace_id, i, 1 AS r FROM near WHERE abs(x - b) > far AND abs(x - x1) > far AND abs(b - x1) < far AND NOT isnan(b) AND NOT isnan(x) AND NOT isnan(x1)
  UNION ALL SELECT trace_id, i, 2 FROM near WHERE abs(x - b) > far AND abs(x - x2) > far AND abs(x1 - b) > far AND abs(x1 - x2) > far AND abs(b - x2) < far AND NOT isnan(b) AND NOT isnan(x) AND NOT isnan(x1) AND NOT isnan(x2)
  UNION ALL SELECT trace_id, i, 3 FROM near WHERE abs(x - b) > far AND abs(x - x3) > far AND abs(x1 - b) > far AND abs(x1 - x3) > far AND abs(x2 - b) > far AND abs(x2 - x3) > far AND abs(b - x3) < far AND NOT isnan(b) AND NOT isnan(x) AND NOT isnan(x1) AND NOT isnan(x2) AND NOT isnan(x3)),
bad AS (SELECT trace_id, i FROM samples WHERE abs(x) > 8388607 AND NOT isnan(x) UNION SELECT trace_id, i FROM stuck UNION SELECT trace_id, i + unnest(generate_series(0, r - 1)) FROM spike)"""

_SLOTS = f"""{_SAMPLES}, slots AS (SELECT DISTINCT station, channel, date, CAST(floor((a + CAST(floor(i * 1e6 / rate) AS BIGINT)) / 1e6) AS BIGINT) AS slot
  FROM samples WHERE isfinite(x) AND a IS NOT NULL AND rate > 0 AND NOT isnan(rate)),
every AS (SELECT station, channel, date, unnest(generate_series(min(slot), max(slot))) AS slot FROM slots GROUP BY station, channel, date)"""

SQL: dict[str, str] = {
    "p2_found": f"WITH {_BAD} SELECT trace_id, CAST(i AS INTEGER) AS sample_idx FROM bad",
    "p2_usual_steps": f"WITH {_STEPS} SELECT * FROM steps",
    "p3_found": f"WITH {_SLOTS} SELECT * FROM every EXCEPT SELECT * FROM slots",
    "p3_per_source": f"""WITH {_SLOTS}, held AS (SELECT station, channel, date, count(*) AS n FROM slots GROUP BY ALL)
SELECT station, channel, date, count(*) AS n_slots, count(*) - any_value(n) AS n_filled FROM every JOIN held USING (station, channel, date) GROUP BY ALL""",
    "p3_means": f"""WITH {_SLOTS}, means AS (SELECT station, channel, date, CAST(floor((a + CAST(floor(i * 1e6 / rate) AS BIGINT)) / 1e6) AS BIGINT) AS slot, round(avg(x), 6) AS mean
  FROM samples WHERE isfinite(x) AND a IS NOT NULL AND rate > 0 AND NOT isnan(rate) GROUP BY ALL)
SELECT e.station, e.channel, e.date, e.slot, mean, mean IS NULL AS filled FROM every e LEFT JOIN means m
  ON e.station = m.station AND e.channel IS NOT DISTINCT FROM m.channel AND e.date IS NOT DISTINCT FROM m.date AND e.slot = m.slot""",
    "p5_found": f"""WITH {PLACES}, q AS (SELECT evid, q FROM places WHERE q.dep BETWEEN -5 AND 700),
st AS (SELECT station, s FROM (SELECT {CODE.format("net_sta")} AS station, arg_max(struct_pack(lat := lat, lon := lon), line_no) AS s FROM stations GROUP BY ALL)
  WHERE station IS NOT NULL AND NOT isnan(s.lat) AND abs(s.lat) <= 90 AND NOT isnan(s.lon) AND abs(s.lon) <= 180)
SELECT 'station' AS kind, evid AS key_a, station AS key_b FROM q, st WHERE sqrt(pow({KM.format(a="q.q", b="st.s")}, 2) + pow(q.q.dep, 2)) <= 10
UNION ALL SELECT 'quake', x.evid, y.evid FROM q x JOIN q y ON x.evid < y.evid AND abs(epoch_us(x.q.ot) - epoch_us(y.q.ot)) <= 1728000000000
  AND abs(x.q.lat - y.q.lat) < 0.01 WHERE sqrt(pow({KM.format(a="x.q", b="y.q")}, 2) + pow(x.q.dep - y.q.dep, 2)) <= 1""",
    "p1_found": f"WITH {_REFS} SELECT table_name, period, row_id FROM orphans",
    "p1_report": f"WITH {_REFS} SELECT table_name, period, count(*) AS n_orphans, count(DISTINCT key) AS n_keys FROM orphans GROUP BY ALL",
    "p4_found": f"""WITH {_WINDOWS}, total AS (SELECT count(*) AS n FROM tasks)
SELECT 'station' AS field, station, -1 AS row_a FROM windows WHERE station IS NOT NULL GROUP BY station HAVING sum(n) * 100 >= 4 * (SELECT n FROM total)
UNION ALL SELECT 'row_a', station, row_a FROM windows WHERE station IS NOT NULL AND row_a IS NOT NULL AND n * 1000 >= 5 * (SELECT n FROM total)""",
    "p4_window_counts": f"WITH {_WINDOWS} SELECT * FROM windows",
    "p4_station_counts": f"WITH {_WINDOWS} SELECT station, CAST(sum(n) AS BIGINT) AS n, min(row_b_min) AS row_b_min, max(row_b_max) AS row_b_max FROM windows GROUP BY ALL",
    "p6_found": f"""WITH x AS (SELECT {CODE.format("station")} AS station, channel, {US.format("starttime")} AS a, {US.format("endtime")} AS b FROM traces),
y AS (SELECT *, max(b) OVER (PARTITION BY station, channel ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x WHERE station IS NOT NULL AND b >= a),
z AS (SELECT *, sum(CASE WHEN before IS NULL OR a > before + 2000000 THEN 1 ELSE 0 END) OVER (PARTITION BY station, channel ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM y),
periods AS (SELECT station, channel, k, min(a) AS start_us, max(b) AS end_us FROM z GROUP BY ALL),
nexts AS (SELECT *, lead(start_us) OVER (PARTITION BY station, channel ORDER BY k) AS n FROM periods)
SELECT station, channel, 'period' AS kind, start_us, end_us FROM periods
UNION ALL SELECT station, channel, 'gap', end_us, n FROM nexts WHERE n - end_us <= 604800000000""",
    "p7_found": f"WITH {_RANKED} SELECT evid, nbr_evid FROM ranked WHERE rank <= 5",
    "p7_ranked": f"WITH {_RANKED} SELECT evid, nbr_evid, mm, rank FROM ranked WHERE rank <= 5",
}
