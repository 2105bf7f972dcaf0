"""Dyadic price index: band containment as an equi-join.

The distinct listing prices of a key (tier, location, room, type …) are ranked.
A price is a leaf of a binary tree over the ranks and belongs to one node on
each level; a price band covers a range of leaves, which splits into at most
two nodes a level. A band holds a price exactly if they share one node, and
then exactly one. Whatever is summarised per node (the best, a count, a list
of the top) can be merged over the O(log) nodes of a price, so no listing ever
meets all the bands that contain it.

Ranks come from running counts over (key, price) ranges, so a key of any size
is spread over tasks. Bands that cover no listing's price have no node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.operators.running import running_totals, written

#: a node is (level << _LEVEL) | block
_LEVEL = 40

_NODES_OF_RANK = f"transform(sequence(0, levels), t -> shiftleft(cast(t as long), {_LEVEL}) | shiftright(leaf, t))"

# on level t the blocks [l, r) of 2^t leaves lie inside the band; odd ends are its nodes there
_L, _R = "shiftright(low + shiftleft(1L, t) - 1, t)", "shiftright(high + 1, t)"
_NODES_OF_BAND = f"""filter(flatten(transform(sequence(0, length(bin(high - low + 1)) - 1), t -> array(
  if({_L} < {_R} and {_L} % 2 = 1, shiftleft(cast(t as long), {_LEVEL}) | {_L}, null),
  if({_L} < {_R} and {_R} % 2 = 1, shiftleft(cast(t as long), {_LEVEL}) | ({_R} - 1), null)))), x -> x is not null)"""


def price_nodes(prices: DataFrame, bands: DataFrame, key: list[str], name: str = "price-ranks") -> tuple[DataFrame, DataFrame]:
    """Nodes of ``prices`` (key, ``price``, further columns) and of ``bands``
    (key, ``price_start``, ``price_end``, further columns): one row for each
    node, in column ``node``. Rows with a null in the key match nothing and
    have none."""
    present = " and ".join(f"{k} is not null" for k in key)
    prices, bands = prices.where(present), bands.where(present)
    at = prices.select(*key, F.col("price").alias("value"), F.lit(1).alias("kind")).distinct()

    def ends(column: str, kind: int) -> DataFrame:
        return bands.select(*key, F.col(column).alias("value"), F.lit(kind).alias("kind")).distinct()

    # at equal values: a band's start, the listing's price, a band's end
    points = at.unionByName(ends("price_start", 0).unionByName(ends("price_end", 2)).join(at.select(*key).distinct(), key, "left_semi"))
    ranks = written(running_totals(points, key, [F.col("value"), F.col("kind")], (F.col("kind") == 1).cast("int"), name, "n"), name)
    sizes = ranks.groupBy(*key).agg((F.length(F.bin(F.max("n"))) - 1).alias("levels"))

    def ranked(column: str, kind: int, rank: str, value) -> DataFrame:
        return ranks.where(F.col("kind") == kind).select(*key, F.col("value").alias(column), value.cast("long").alias(rank))

    own = (prices.join(ranked("price", 1, "leaf", F.col("n") - 1), [*key, "price"]).join(sizes, key)
           .withColumn("node", F.explode(F.expr(_NODES_OF_RANK))).drop("leaf", "levels"))
    covered = (bands.join(ranked("price_start", 0, "low", F.col("n")), [*key, "price_start"])
               .join(ranked("price_end", 2, "high", F.col("n") - 1), [*key, "price_end"]).where("low <= high")
               .withColumn("node", F.explode(F.expr(_NODES_OF_BAND))).drop("low", "high"))
    return own, covered
