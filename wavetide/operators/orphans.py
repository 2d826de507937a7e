"""References to records that do not exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetide.functions.columns import day_of
from wavetide.operators.skew import BROADCAST_ROWS, PIECES, split_join
from wavetide.session import durable

#: What references are counted by.
GROUP = ("table_name", "key", "period")
#: A key, or a key's period, with this share of all references is heavy; so at most 1 / SHARE are.
SHARE = 0.01


def period_of(us: Column) -> Column:
    return F.coalesce(day_of(us), F.lit("none"))


def references_per_key(refs: DataFrame) -> DataFrame:
    """table_name, key, period, n, first_us, last_us: references counted per key and UTC day, combined before the shuffle, with
    the earliest and latest time."""
    grouped = refs.filter("key is not null").groupBy("table_name", "key", period_of(F.col("time_us")).alias("period"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.min("time_us").alias("first_us"), F.max("time_us").alias("last_us"))


def _in_force(first: Column, last: Column, some: bool = False) -> Column:
    """Whether a term is in force throughout first .. last, or (``some``) at some time of it; at no time: whether it exists."""
    begin, end = (last, first) if some else (first, last)
    return first.isNull() | ((F.col("from_us").isNull() | (F.col("from_us") <= begin)) & (F.col("to_us").isNull() | (end < F.col("to_us"))))


def open_groups(refs: DataFrame, terms: DataFrame, share: float = SHARE) -> DataFrame:
    """Groups (``references_per_key``) that no single term covers, with ``mixed``: whether some term is in force within them, so
    that their rows must be looked at; all references of the others are orphans. ``heavy`` marks those with ``share`` of all
    references. Heavy keys meet their terms in a broadcast of checked size, the others in a shuffled anti-join.
    """
    counts = durable(references_per_key(refs))
    terms = terms.select("key", "from_us", "to_us")
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(share * total, 2)
    heavy = [r.key for r in counts.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= most).select("key").collect()]
    first, last = F.col("first_us"), F.col("last_us")
    uncovered = durable(split_join(counts, terms, "key", "left_anti", _in_force(first, last), heavy))
    touched = _in_force(first, last, some=True)
    parts = [split_join(uncovered, terms, "key", how, touched, heavy).withColumn("mixed", F.lit(mixed)) for how, mixed in (("left_anti", False), ("left_semi", True))]
    return parts[0].unionByName(parts[1]).withColumn("heavy", F.col("n") >= most)


def _rows_of(refs: DataFrame, groups: DataFrame, broadcast_rows: int) -> DataFrame:
    """The rows of ``refs`` (with ``period``) that belong to ``groups``. Up to ``broadcast_rows`` groups are broadcast; beyond,
    rows meet their groups by a shuffle in which the heavy groups, at most 1 / share, are cut in pieces."""
    refs = refs.withColumn("period", period_of(F.col("time_us")))
    groups = groups.select(*GROUP, "heavy")
    if groups.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return refs.join(F.broadcast(groups.drop("heavy")), list(GROUP), "left_semi")
    cut = refs.join(F.broadcast(groups.filter("heavy")), list(GROUP), "left")
    cut = cut.withColumn("_piece", F.when(F.col("heavy"), F.pmod(F.xxhash64("row_id", "time_us"), F.lit(PIECES)).cast("int")).otherwise(0)).drop("heavy")
    copies = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    return cut.join(groups.withColumn("_piece", F.explode(copies)).drop("heavy").hint("merge"), [*GROUP, "_piece"], "left_semi").drop("_piece")


def orphan_references(refs: DataFrame, terms: DataFrame, share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """table_name, period, row_id, key: the rows of ``refs`` (table_name, key, time_us, row_id) whose key was in force in no
    row of ``terms`` at their time.

    ``terms`` has key, from_us, to_us: in force while from_us <= time < to_us, null ends are open. A row without time is
    an orphan only if ``terms`` lacks its key. Rows without key refer to nothing and never come out. Repeated rows come
    out as often as they stand; empty ``refs`` give no rows, empty ``terms`` every row with a key; further columns are dropped.

    References are counted per key and day first (``open_groups``); days that one term covers drop out by their counts,
    the rows of the others meet the terms.
    """
    refs = refs.select("table_name", "key", "time_us", "row_id").filter("key is not null")
    rows = _rows_of(refs, durable(open_groups(refs, terms, share)), broadcast_rows)
    return _orphans(rows, terms, broadcast_rows).select("table_name", "period", "row_id", "key")


def _orphans(rows: DataFrame, terms: DataFrame, broadcast_rows: int) -> DataFrame:
    t = F.col("time_us")
    return split_join(rows, terms.select("key", "from_us", "to_us"), "key", "left_anti", _in_force(t, t), broadcast_rows=broadcast_rows)


def orphan_report(refs: DataFrame, terms: DataFrame, share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """table_name, period, n_orphans, n_keys: the orphans of ``orphan_references`` counted per table and day.

    Days that are orphans throughout enter by their counts; only the rows of mixed days are looked at, and their counts
    are put beside those.
    """
    refs = refs.select("table_name", "key", "time_us", "row_id").filter("key is not null")
    groups = durable(open_groups(refs, terms, share))
    rows = _rows_of(refs, groups.filter("mixed"), broadcast_rows)
    counted = _orphans(rows, terms, broadcast_rows).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    orphans = groups.filter("not mixed").select(*GROUP, "n").unionByName(counted)
    return orphans.groupBy("table_name", "period").agg(F.sum("n").alias("n_orphans"), F.count(F.lit(1)).alias("n_keys"))
