"""M2: capped sequential assignment of clients to listings.

Sequential rule being matched: listings are handled in ``(share_id, fh_id)``
order; each takes its top-``k`` clients (place tier, area tier when fewer
than ``min_clients`` place clients) from the pool; every matched intent row
adds one to its client's counter, and a client whose counter exceeds ``cap``
leaves the pool for all later listings.

"Top-k everywhere, then cut at the cap" is wrong (a capped client must be
replaced by the next one, and losing place clients can open the area tier).
The exact result is reached in rounds:

* Listings are dealt to **groups**: areas together up to ``GROUP_ROWS`` listings
  and offers, a larger area by type and room. A group has all offers on its
  listings' keys, and takes its listings in turn, in order (``turns``). There is
  no pair table, and a turn is a few look-ups in a tree over prices.
* A client with offers in several groups may be taken in any of them. After a
  round each group is told what the others' listings have taken of its clients;
  a group that hears anything else than before is taken again, with the others'
  takes counted at the listings where they happen.

What a listing takes depends on earlier listings only, so of the listings that
differ from the sequential result the first is right after the next round: the
rounds end, and where no group hears anything new is the sequential result.
Without clients in several groups one round is enough; otherwise there are as
many as the longest chain of listings, in different groups, that push clients on
to each other.

With a large cap the uncapped matching is tried first: if no client exceeds
its cap there, it is the result.

Every round's rows are written to the shared folder, so a lost executor
repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strata.operators import matching
from strata.operators.counters import capped_clients, merge_counts
from strata.operators.matching import INDEX_KEY
from strata.operators.running import written
from strata.operators.turns import take_turns

#: has no effect any more: clients are looked up one by one
FIRST_CHUNK = 16
#: listings and offers of an area from which on it is dealt by type and room
GROUP_ROWS = 500_000
#: smaller areas share a group, of about so many listings and offers
SHARED_ROWS = 20_000
#: caps from which on clients that cannot reach theirs are set aside first
_LARGE_CAP = 1000

_TAKES = "group string, listing long, tier int, cid string, n long"


class _Frontiers:
    """Groups of listings with the offers on their keys, and what they take."""

    def __init__(self, houses: DataFrame, bands: DataFrame, counts: DataFrame, k: int, cap: int, min_clients: int, group_rows: int):
        self.k, self.min_clients = k, min_clients
        h = houses.select("listing", "place", "area", "price", F.col("room").cast("string").alias("room_s"), F.col("rs_type").alias("rs"),
                          F.coalesce("area", "place", F.lit("")).alias("unit"))
        sizes = written(h.select("unit").unionAll(bands.select("area")).groupBy("unit").agg(F.count(F.lit(1)).alias("rows")), "areas")
        shared = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] // SHARED_ROWS + 1
        # numbers are shared groups; others begin with #
        group = F.when(F.col("rows") > group_rows, F.concat_ws("#", F.lit(""), "rs", "room_s", "unit")).otherwise(
            F.pmod(F.xxhash64("unit"), F.lit(shared)).cast("string"))
        h = self._both_tiers(h.join(sizes, "unit").withColumn("group", group).drop("unit", "rows")).where("loc is not null")
        keys = written(h.groupBy("group", *INDEX_KEY).agg(F.min("price").alias("low"), F.max("price").alias("high"))
                       .withColumn("key", F.monotonically_increasing_id()), "group-keys")
        self.listings = written(h.join(keys, ["group", *INDEX_KEY]).select("group", "listing", "tier", "key", "price"), "group-listings")
        left = counts.groupBy("cid").agg((F.lit(cap) - F.coalesce(F.sum("count"), F.lit(0))).alias("allowed"))
        b = bands.join(left, "cid", "left").withColumn("allowed", F.coalesce("allowed", F.lit(cap))).select(
            "area", "place", "rs", "house_type", "price_start", "price_end", "cid", "ms", "n_rows", "allowed")
        reaches = (F.col("high") >= F.col("price_start")) & (F.col("low") <= F.col("price_end"))
        self.offers = written(self._both_tiers(matching._intent_rooms(b).drop("house_type")).join(keys, INDEX_KEY).where(reaches).select(
            "group", "key", "price_start", "price_end", "cid", "ms", F.col("n_rows").alias("n"), "allowed"), "group-offers")
        #: groups of the clients that have offers in several
        several = self.offers.select("group", "cid").distinct()
        self.several = written(several.join(several.groupBy("cid").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("cid"), "cid"), "group-clients")
        self.told = self.several.sparkSession.createDataFrame([], "group string, listing long, cid string, n long")

    @staticmethod
    def _both_tiers(df: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(c).alias("loc")) for t, c in ((1, "place"), (2, "area"))])
        return df.withColumn("_k", F.explode(keys)).select("*", "_k.tier", "_k.loc").drop("_k", "place", "area")

    def load(self, wanted: DataFrame) -> DataFrame:
        """What the listings of the ``wanted`` groups take (``_TAKES``), by what
        they are told of the others. Written."""
        k, min_clients = self.k, self.min_clients

        def taken(group, listings, rows):
            import pyarrow as pa
            import pyarrow.compute as pc

            from_others = pc.is_valid(rows["listing"])
            out = take_turns(listings, rows.filter(pc.invert(from_others)), rows.filter(from_others), k, min_clients)
            types = (("listing", pa.int64()), ("tier", pa.int32()), ("cid", pa.string()), ("n", pa.int64()))
            columns = [(c := pa.array(out[name]) if isinstance(out[name], list) else out[name]).cast(kind) for name, kind in types]
            return pa.Table.from_arrays([pa.array([group[0].as_py()] * len(columns[0]), pa.string()), *columns], ["group", *[n for n, _ in types]])

        listings, offers, told = (x.join(wanted, "group", "left_semi") for x in (self.listings, self.offers, self.told))
        rows = offers.withColumn("listing", F.lit(None).cast("long")).unionByName(told, allowMissingColumns=True)
        return written(listings.groupBy("group").cogroup(rows.groupBy("group")).applyInArrow(taken, _TAKES), "takes")

    def heard(self, takes: DataFrame) -> DataFrame:
        """What each group is told: takes of its clients by other groups' listings."""
        own = self.several.withColumnRenamed("group", "_group")
        return written(takes.join(own, "cid").where(F.col("group") != F.col("_group")).select(
            F.col("_group").alias("group"), "listing", "cid", "n"), "told")


def assign_capped(houses: DataFrame, intents: DataFrame, counts: DataFrame | None = None,
                  k: int = 3, cap: int = 3, min_clients: int = 3,
                  first_chunk: int = FIRST_CHUNK, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """Run the capped assignment.

    ``counts(cid, count)`` are the counters valid today (M1). Returns
    ``(picks, new_counts, steps)``: ``picks`` has one row per selected
    (listing, client) pair with ``n_rows`` and the pair's latest intent row
    (``rid``, ``see_time``), ``new_counts`` is ``(cid, count)``; ``steps``
    counts the rounds. Areas of more than ``group_rows`` listings and offers
    are dealt by type and room. ``first_chunk`` has no effect any more; neither
    changes the result.
    """
    spark = houses.sparkSession
    if counts is None:
        counts = spark.createDataFrame([], "cid string, count long")
    counts = written(counts.select("cid", F.col("count").cast("long").alias("count")), "counts")
    houses = matching.identified(houses)
    pool = intents.join(capped_clients(counts, cap), "cid", "left_anti")
    if cap >= _LARGE_CAP:
        # no client leaves the pool if none exceeds its cap where all take their top clients from the whole pool
        free = written(matching.match_pairs(houses, pool, k, min_clients), "uncapped")
        taken = free.groupBy("cid").agg(F.sum("n_rows").alias("_sum")).join(counts, "cid", "left")
        if taken.where(F.col("_sum") + F.coalesce("count", F.lit(0)) > cap).isEmpty():
            return free, written(merge_counts(counts, free.select("cid", F.col("n_rows").alias("n"))), "new-counts"), 1
    bands = matching.client_bands(pool)
    groups = _Frontiers(houses, bands, counts, k, cap, min_clients, group_rows)
    takes = groups.load(groups.listings.select("group").distinct())
    steps = 1
    while not groups.several.isEmpty():
        told, before = groups.heard(takes), groups.told
        other = written(told.exceptAll(before).unionAll(before.exceptAll(told)).select("group").distinct(), "touched")
        if other.isEmpty():
            break
        groups.told = told
        takes = written(takes.join(other, "group", "left_anti").unionByName(groups.load(other)), "all-takes")
        steps += 1
    cells = houses.select(F.col("listing").alias("cell"), *matching.CELL)
    pairs = matching.cell_rows(takes.select(F.col("listing").alias("cell"), "cid", "tier"), cells, bands).withColumnRenamed("cell", "listing")
    w = Window.partitionBy("listing").orderBy(F.col("ms").desc_nulls_last(), F.col("cid"))
    picks = written(matching.with_listing(pairs.withColumn("rank", F.row_number().over(w)), houses), "picks")
    new_counts = written(merge_counts(counts, picks.select("cid", F.col("n_rows").alias("n"))), "new-counts")
    return picks, new_counts, steps
