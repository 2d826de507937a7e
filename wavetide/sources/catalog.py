"""Text sources: phase catalogues, station lists, observation files and waveform folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.functions.columns import DAY_US, station_code

ISO_TIME = r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d)?\d*Z?\s*$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, ord, value of text files (.gz too): lines in order by (split, ord); a large file is read in splits."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    return lines.withColumn("ord", F.monotonically_increasing_id())


def time_micros(text: Column) -> Column:
    """Microseconds since 1970 of an ISO time in UTC; further decimals are cut off. Null for '-1' and for any other text."""
    bare = F.replace(F.btrim(text, F.lit(" \t\n\r\f\v")), F.lit("Z"), F.lit(""))  # what matches has its fields at fixed places
    part = lambda at, n: F.substring(bare, at, n)
    day = F.datediff(F.try_to_date(part(1, 10), "yyyy-MM-dd"), F.lit("1970-01-01").cast("date")).cast("long")
    clock = F.expr("0L")
    for at, scale in ((12, 3600), (15, 60), (18, 1)):
        clock = clock + part(at, 2).try_cast("long") * scale
    fraction = F.when(part(20, 1) == ".", F.rpad(part(21, 6), 6, "0").try_cast("long")).otherwise(0)
    return F.when(text.rlike(ISO_TIME), day * DAY_US + clock * 1_000_000 + fraction)


def carry_header(lines: DataFrame, is_header: Column, header: Column) -> DataFrame:
    """``lines`` with ``head``: the header at or before each line of its file (null before the first).

    Within a split the last header runs down a window; a split that begins without one takes the last of the splits
    before it, found on one row per split. So no task holds more than one split of a file.
    """
    own = F.when(is_header, header)
    inside = W.partitionBy("file", "split").orderBy("ord")
    lines = lines.withColumn("_own", F.last(own, True).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    ends = lines.groupBy("file", "split").agg(F.max_by("_own", "ord").alias("_end"))
    before = ends.select("file", "split", F.last("_end", True).over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    return lines.join(before, ["file", "split"]).withColumn("head", F.coalesce("_own", "_before")).drop("_own", "_before")


def _fields(value: Column) -> Column:
    return F.transform(F.split(value, ","), lambda x: F.trim(x))


def _number(text: Column) -> Column:
    """The number of a text; null for any other text, 'nan' included."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x), x)


def parse_catalogue(lines: DataFrame, header_chars: int = 11) -> tuple[DataFrame, DataFrame]:
    """events (evid, ot_us, lat, lon, dep, mag, file, split, ord) and picks (evid, ot_us, station, tp_us, ts_us, file, split, ord).

    A line whose first field has ``header_chars`` characters or more is an event (origin time, lat, lon, depth, magnitude,
    ..., evid); any other is a pick of the event before it (station, P time, S time, ...). Blank lines are skipped, picks
    before any event left out; '-1' is a missing time. Numbers that are none are null.
    """
    lines = lines.filter(F.trim("value") != "").withColumn("f", _fields(F.col("value")))
    at = lambda k: F.get("f", F.lit(k))
    is_header = F.length(at(0)) >= header_chars
    header = F.struct(F.element_at("f", -1).alias("evid"), time_micros(at(0)).alias("ot_us"))
    told = carry_header(lines, is_header, header).filter("head is not null")
    told = told.withColumn("is_header", is_header)
    number = lambda k: _number(at(k))
    place = ["file", "split", "ord"]
    events = told.filter("is_header").select("head.evid", "head.ot_us", number(1).alias("lat"), number(2).alias("lon"), number(3).alias("dep"), number(4).alias("mag"), *place)
    picks = told.filter("not is_header").select("head.evid", "head.ot_us", at(0).alias("station"), time_micros(at(1)).alias("tp_us"), time_micros(at(2)).alias("ts_us"), *place)
    return events, picks


def parse_named_catalogue(lines: DataFrame, after_us: int | None = None, before_us: int | None = None) -> tuple[DataFrame, DataFrame]:
    """As ``parse_catalogue`` for the older form, whose events end in 'evid_name' (cut at the first '_', ``name`` in events)
    and begin with a field of ten characters or more; only events strictly between the two times, and their picks."""
    events, picks = parse_catalogue(lines, 10)
    inside = F.lit(True)
    if after_us is not None:
        inside = inside & (F.col("ot_us") > after_us)
    if before_us is not None:
        inside = inside & (F.col("ot_us") < before_us)
    both = F.split("evid", "_", 2)
    events = events.filter(inside).withColumns({"name": F.get(both, F.lit(1)), "evid": F.get(both, F.lit(0))})
    return events, picks.filter(inside).withColumn("evid", F.get(both, F.lit(0)))


def parse_stations(lines: DataFrame) -> DataFrame:
    """station, lat, lon, ele of lines 'NET.STA,lat,lon,elevation,...'; of a repeated code the last line counts.
    Numbers that are none, 'nan' included, are null."""
    f = _fields(F.col("value"))
    rows = lines.filter(F.trim("value") != "").select(station_code(F.get(f, F.lit(0))).alias("station"), *[_number(F.get(f, F.lit(k))).alias(n) for k, n in ((1, "lat"), (2, "lon"), (3, "ele"))], "split", "ord")
    return rows.filter("station is not null").groupBy("station").agg(F.max_by(F.struct("lat", "lon", "ele"), F.struct("split", "ord")).alias("s")).select("station", "s.*")


def list_waveforms(spark: SparkSession, root: str, suffix: str = "mseed") -> DataFrame:
    """day, station, paths: files root/YYYYMMDD/NET.STA.*.suffix of which a station and day has exactly three, by name."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in suffix)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{root}/[0-9]*").select("path")
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    grouped = files.select(F.element_at(parts, -2).alias("day"), F.concat_ws(".", F.slice(F.split(name, r"\."), 1, 2)).alias("station"), "path").groupBy("day", "station")
    return grouped.agg(F.array_sort(F.collect_list("path")).alias("paths")).filter(F.size("paths") == 3)


OBSERVATION = r"^\s*(\d+)\s+(\d+)\s+(\S+)\s+([PS])\s+([+-]?\d+(?:\.\d{1,6})?)\s+([+-]?\d+(?:\.\d{1,6})?)\s*$"


def parse_observations(lines: DataFrame, most_evid: int = (1 << 20) - 1) -> DataFrame:
    """evid_a, evid_b (long), station, phase, dt_u6, cc_u6, split, ord of lines 'evidA evidB STA P|S dt cc'.

    Up to six decimals; blank lines are skipped; any other line, or an evid above ``most_evid``, ends the run with an error.
    """
    rows = lines.filter(F.trim("value") != "")
    part = lambda k: F.regexp_extract("value", OBSERVATION, k)
    good = F.col("value").rlike(OBSERVATION) & (F.length(part(1)) <= 18) & (F.length(part(2)) <= 18)
    evid = lambda k: part(k).try_cast("long")
    good = F.when(good, (evid(1) <= most_evid) & (evid(2) <= most_evid)).otherwise(F.lit(False))
    first = F.when(good, evid(1)).otherwise(F.raise_error(F.concat(F.lit("bad observation: "), F.col("value"))).cast("long"))
    u6 = lambda k: F.rint(part(k).try_cast("decimal(20,6)").cast("double") * 1e6).cast("int")
    return rows.select(first.alias("evid_a"), evid(2).alias("evid_b"), part(3).alias("station"), part(4).alias("phase"), u6(5).alias("dt_u6"), u6(6).alias("cc_u6"), "split", "ord")


def station_numbers(stations: DataFrame, any_code: bool = False) -> DataFrame:
    """station, station_no: distinct codes numbered from 0 in their order; codes are 1 to 8 ASCII characters, 1,024 at most,
    unless ``any_code`` lifts both limits."""
    codes = stations.select("station").distinct().withColumn("station_no", F.row_number().over(W.orderBy("station")) - 1)
    if any_code:
        return codes
    fits = F.col("station").rlike(r"^[\x21-\x7e]{1,8}$") & (F.col("station_no") < 1024)
    return codes.withColumn("station_no", F.when(fits, F.col("station_no")).otherwise(F.raise_error(F.concat(F.lit("no number for station "), F.col("station"))).cast("int")))


def catalogue_lines(quakes: DataFrame, picks: DataFrame) -> DataFrame:
    """The text form of events (evid, ot_us, lat, lon, dep, mag) and picks (evid, station, tp_us, ts_us, line_no): file, split,
    ord, value with each event's line before its picks', a file per origin day."""
    stamp = lambda us: F.concat(
        F.date_add(F.lit("1970-01-01").cast("date"), F.floor(us / F.lit(DAY_US)).cast("int")).cast("string"), F.lit("T"),
        *[x for k, (unit, mod) in enumerate(((3_600_000_000, 24), (60_000_000, 60), (1_000_000, 60))) for x in ([F.lit(":")] if k else []) + [F.lpad((F.floor(us / F.lit(unit)) % mod).cast("string"), 2, "0")]],
        F.lit("."), F.lpad((us % 1_000_000).cast("string"), 6, "0"), F.lit("Z"),
    )
    shown = lambda x: F.coalesce(x.cast("string"), F.lit("nan"))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("ot_us") / F.lit(DAY_US)).cast("int")).cast("string")
    heads = quakes.select(day.alias("file"), F.col("evid").alias("split"), F.lit(-1).cast("long").alias("ord"), F.concat_ws(",", stamp(F.col("ot_us")), *[shown(F.col(c)) for c in ("lat", "lon", "dep", "mag")], "evid").alias("value"))
    pick_time = lambda t: F.coalesce(stamp(F.col(t)), F.lit("-1"))
    lines = picks.join(quakes.select("evid", day.alias("file")), "evid").select("file", F.col("evid").alias("split"), F.col("line_no").alias("ord"), F.concat_ws(",", "station", pick_time("tp_us"), pick_time("ts_us"), F.lit("0")).alias("value"))
    return heads.unionByName(lines)
