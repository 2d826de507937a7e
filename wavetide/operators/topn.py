"""Top N items within every group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.functions.columns import ground_km
from wavetide.operators.skew import heavy_keys, split_join
from wavetide.session import durable

#: Places that go out as a broadcast at most.
BROADCAST_PLACES = 200_000


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The ``n`` first rows of every group in the given order, which must end with a unique column to settle ties.

    A row_number window under a rank filter: the optimiser turns it into a group limit that keeps at most ``n`` rows per
    group and task before the shuffle, so a group of millions sends n rows a task. Null groups form one group; an
    empty table gives no rows.
    """
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n)


def partner_edges(pairs: DataFrame, a: str = "evid_a", b: str = "evid_b") -> DataFrame:
    """a < b: each unordered pair of two different non-null ids once, however often and in whatever order it is told."""
    x, y = F.col(a), F.col(b)
    return pairs.filter(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def nearest_partners(pairs: DataFrame, places: DataFrame, n: int = 5) -> DataFrame:
    """evid, nbr_evid, mm, rank: for each evid of ``pairs`` its ``n`` nearest partners, equal distances by smaller evid.

    ``places``: evid (unique), lat, lon. Distances count in whole millimetres, rounded half up. Self-pairs, pairs with a
    null and evids without a place drop out. The distinct pairs and the places are written out once. Up to
    BROADCAST_PLACES places are broadcast; beyond that a shuffle looks them up, with the places of the few evids that
    stand in a large part of all pairs apart (``split_join``). The window's group limit prunes those before its shuffle.
    """
    edges, at = durable(partner_edges(pairs)), durable(places.select("evid", "lat", "lon"))
    few = at.count() <= BROADCAST_PLACES
    side = lambda k: at.select(F.col("evid").alias(k), F.col("lat").alias(f"lat_{k}"), F.col("lon").alias(f"lon_{k}"))
    for k in ("a", "b"):
        edges = edges.join(F.broadcast(side(k)), k) if few else split_join(edges, side(k), k, "inner", heavy=heavy_keys(edges, k))
    km = ground_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    edges = edges.select("a", "b", F.floor(km * 1e6 + 0.5).cast("long").alias("mm"))
    both = edges.select(
        F.explode(F.array(F.struct(F.col("a").alias("evid"), F.col("b").alias("nbr_evid")), F.struct(F.col("b").alias("evid"), F.col("a").alias("nbr_evid")))).alias("e"), "mm"
    ).select("e.evid", "e.nbr_evid", "mm")
    return top_n(both, ["evid"], [F.col("mm"), F.col("nbr_evid")], n).withColumnRenamed("_rank", "rank")
