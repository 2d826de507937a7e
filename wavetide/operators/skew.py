"""Joins that survive a key holding a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows on; so at most 1 / HEAVY_SHARE keys are.
HEAVY_SHARE = 0.01
#: Most rows of the small side that go out as a broadcast.
BROADCAST_ROWS = 50_000
#: Pieces into which a heavy key is cut where its other side is too large for a broadcast.
PIECES = 64


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys with at least ``share`` of the non-null rows. The list has at most 1 / share entries, whatever the input."""
    named = df.select(key).filter(F.col(key).isNotNull())
    per_key = named.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = named.count()
    return [r[0] for r in per_key.filter(F.col("_n") >= max(share * total, 2)).collect()]


def split_join(left: DataFrame, right: DataFrame, key: str, how: str, also=None, heavy: list | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join of ``left.key`` and ``right.key`` (``also``: a further condition) with the heavy keys of ``left`` apart.

    Right rows are counted: up to ``broadcast_rows`` of them are broadcast to all keys, else those of the heavy keys if they
    are so few; more are copied to PIECES salted parts of the key. All other keys are joined by a shuffle. ``how`` is inner, left, left_semi or left_anti.
    Null keys match nothing. The two sides must have no other column name in common.
    """
    right = right.withColumnRenamed(key, "_rkey")
    match = F.col(key) == F.col("_rkey")
    on = match if also is None else match & also
    if right.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return left.join(F.broadcast(right), on, how).drop("_rkey")
    heavy = heavy_keys(left, key) if heavy is None else heavy
    if not heavy:
        return left.join(right.hint("merge"), on, how).drop("_rkey")
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    light = left.filter(~is_heavy).join(right.filter(~F.col("_rkey").isin(heavy)).hint("merge"), on, how)
    few = right.filter(F.col("_rkey").isin(heavy))
    some = left.filter(is_heavy)
    if few.limit(broadcast_rows + 1).count() <= broadcast_rows:
        parted = some.join(F.broadcast(few), on, how)
    else:
        own = F.xxhash64(*left.columns)  # a row falls into the same piece if its stage runs again
        some = some.withColumn("_piece", F.pmod(own, F.lit(PIECES)).cast("int"))
        few = few.withColumn("_rpiece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
        parted = some.join(few.hint("merge"), on & (F.col("_piece") == F.col("_rpiece")), how).drop("_piece", "_rpiece")
    return light.unionByName(parted).drop("_rkey")
