"""Listing / client-intent matching, set-based.

A listing matches an intent row when the price lies in the intent's band, the
listing's room count is in the intent's ``house_type`` list, the mapped
``require_type`` equals the listing's ``rs_type``, and the locations agree:
first on *place* (tier 1); when fewer than ``min_clients`` distinct clients
match on place, also on *area* (tier 2, clients already matched on place for
that listing excluded). For each listing the ``k`` clients with the latest
viewing are kept, and for each kept client its latest intent row.

All listings are matched at once. The jobs go through the dyadic price index
(``price_index``): for each key ``(tier, location, room, rs_type)`` and node of
the price tree the intents are summarised per client, and each node keeps its
top clients only. A listing looks up its O(log) nodes and merges their lists,
so the rows that are ranked grow with the listings, not with the pairs. Without
a cap, listings that are alike are matched once, and intents with one wish are
cut to their top clients before they enter the index. With a small cap the
listings are taken in turn (``assignment``). The functions that return every
candidate row (J1, J2, J3) walk along blocks of listings (``blocks``).

Join strategy is Spark's: a side is broadcast only when its measured (AQE
runtime) size is under the broadcast threshold, otherwise a shuffled join with
AQE skew splitting for hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.functions.codes import rs_type_of
from strata.functions.text import has_exact_fields, split_fields
from strata.operators.blocks import listing_blocks, pairs_in_band
from strata.operators.price_index import price_nodes
from strata.operators.running import numbered, written

# Intent columns carried into the match result (absent ones become null).
INTENT_STRING_COLS = ("objective", "area_name", "purpose_school_id", "purpose_school_name",
                      "insert_worker_id")
INTENT_DOUBLE_COLS = ("house_area_start", "house_area_end")
INTENT_INT_COLS = ("purpose_school",)

#: a listing is one share of a house: the same house shared twice is two listings
LISTING = ["share_id", "fh_id"]
PAIR_KEYS = [*LISTING, "cid"]


def _opt(df: DataFrame, name: str, dtype: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(dtype).alias(name)


def normalize_intents(df: DataFrame, exclude_zero_codes: bool = False) -> DataFrame:
    """Typed, filtered client intents with parsed location codes.

    Keeps rows whose ``area_code`` splits into exactly 3 parts (JVM rule) and
    whose ``house_type`` and client are present (``rejected_intents`` has the
    others). Null prices read as 0.0 and a null ``require_type`` as 0, as a
    primitive read would. ``rid`` identifies an intent row and breaks ties; a
    table without it gets row ids (``with_row_ids``).
    """
    parts = split_fields("area_code", "-")
    if "rid" not in df.columns:
        df = with_row_ids(df, "rid")
    return df.where(_usable(exclude_zero_codes)).select(
        F.col("rid"),
        F.col("cid").cast("string").alias("cid"),
        F.col("see_time").cast("string").alias("see_time"),
        F.col("update_time").cast("string").alias("update_time"),
        F.col("area_code"),
        F.get(parts, 0).alias("city"),
        F.get(parts, 1).alias("area"),
        F.get(parts, 2).alias("place"),
        F.coalesce(F.col("price_start").cast("double"), F.lit(0.0)).alias("price_start"),
        F.coalesce(F.col("price_end").cast("double"), F.lit(0.0)).alias("price_end"),
        F.col("house_type"),
        rs_type_of("require_type").alias("rs"),
        *[_opt(df, c, "string") for c in INTENT_STRING_COLS],
        *[_opt(df, c, "double") for c in INTENT_DOUBLE_COLS],
        *[_opt(df, c, "int") for c in INTENT_INT_COLS],
    )


def row_digest(columns: list[str]) -> Column:
    """128 bits of a row's canonical form: for each column its number, whether
    it is null, the length of its text, and the text. Rows that differ in any
    value, or only in which column is null, have different forms."""
    def form(i: int, c: str) -> Column:
        value = F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.lit(f"{i}="), F.octet_length(value).cast("string"), F.lit(":"), value), F.lit(f"{i}-"))
    return F.md5(F.concat(F.lit(""), *[form(i, c) for i, c in enumerate(columns)]))


def with_row_ids(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number for each row, in the order of the rows' digests.
    Equal rows get different, consecutive numbers (which of them has which
    makes no difference). The numbered rows are written."""
    order = [F.col("_digest"), F.col("_copy")]
    rows = numbered(df.withColumn("_digest", row_digest(df.columns)).withColumn("_copy", F.monotonically_increasing_id()), order, "row-ids", name)
    return written(rows.drop("_digest", "_copy"), "rows")


def identified(houses: DataFrame) -> DataFrame:
    """Listings in the order in which they are handled: ``listing`` numbers
    them by ``share_id``, ``fh_id``, then the other columns. Equal rows are
    listings of their own."""
    if "listing" in houses.columns:
        return houses
    order = [*[F.col(c) for c in LISTING], F.col("_digest"), F.col("_copy")]
    rows = numbered(houses.withColumn("_digest", row_digest(houses.columns)).withColumn("_copy", F.monotonically_increasing_id()),
                    order, "listing-order", "listing")
    return written(rows.drop("_digest", "_copy"), "listings")


def _usable(exclude_zero_codes: bool) -> Column:
    parts = split_fields("area_code", "-")
    keep = (has_exact_fields("area_code", "-", 3) & F.col("house_type").isNotNull() & F.col("cid").isNotNull())
    if exclude_zero_codes:
        keep = keep & (F.get(parts, 1) != "0") & (F.get(parts, 2) != "0")
    return keep


def rejected_intents(df: DataFrame, exclude_zero_codes: bool = False) -> DataFrame:
    """The rows that ``normalize_intents`` leaves out."""
    return df.where(~F.coalesce(_usable(exclude_zero_codes), F.lit(False)))


def normalize_houses(df: DataFrame) -> DataFrame:
    """Typed listings; null numerics read as 0 (primitive read)."""
    return df.select(
        F.coalesce(F.col("fh_id").cast("long"), F.lit(0)).alias("fh_id"),
        F.coalesce(_opt(df, "share_id", "long"), F.lit(0)).alias("share_id"),
        _opt(df, "city_code", "string"),
        _opt(df, "share_worker_id", "string"),
        _opt(df, "city", "string"),
        F.col("area").cast("string").alias("area"),
        F.col("place").cast("string").alias("place"),
        F.coalesce(F.col("room").cast("int"), F.lit(0)).alias("room"),
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("rs_type").cast("int"), F.lit(0)).alias("rs_type"),
    )


def _intent_rooms(intents: DataFrame) -> DataFrame:
    # one row per (intent, wanted room): the room list becomes an equi-join key
    return intents.withColumn(
        "room_s", F.explode(F.array_distinct(F.split("house_type", ",", -1))))


def _candidates(houses: DataFrame, intents: DataFrame, on: str, tier: int) -> DataFrame:
    gate = ["_place"] if "_place" in houses.columns else []
    columns = ["fh_id", "share_id", "city_code", "share_worker_id", "price", "rs_type"]
    blocks = listing_blocks(houses.select(*columns, *gate, F.col(on).alias("_loc"), F.col("room").cast("string").alias("_room")),
                            ["_loc", "_room", "rs_type"])
    i = _intent_rooms(intents)
    same = (F.col("_loc") == i[on]) & (F.col("_room") == i["room_s"]) & (F.col("rs_type") == i["rs"])
    out = pairs_in_band(i, blocks, ["_loc", "_room", "rs_type"], same)
    if gate:
        out = out.where(~F.array_contains("listing._place", F.col("cid")))
    return out.select(*[F.col(f"listing.{c}") for c in columns], *intents.columns).withColumn("tier", F.lit(tier))


def place_candidates(houses: DataFrame, intents: DataFrame) -> DataFrame:
    """Tier 1 (J1): every (listing, intent row) matching on place."""
    return _candidates(houses, intents, "place", 1)


def area_candidates(houses: DataFrame, intents: DataFrame) -> DataFrame:
    """Tier 2 raw rows: every (listing, intent row) matching on area."""
    return _candidates(houses, intents, "area", 2)


def _place_clients(houses: DataFrame, intents: DataFrame, min_clients: int) -> DataFrame:
    """``_place`` of each listing: its distinct place clients, or
    ``min_clients`` of them at least if it has more. They come from the price
    index, so no candidate rows are paired up or moved for them."""
    cells, at = listing_cells(houses)
    tops = tier_tops(cells, client_bands(intents), 1, min_clients)
    return at.join(tops, "cell").groupBy(*LISTING).agg(F.collect_set("cid").alias("_place"))


def match_candidates(houses: DataFrame, intents: DataFrame, min_clients: int = 3) -> DataFrame:
    """J1 + J2: tier-1 rows, plus tier-2 rows for listings that need them.

    A listing that needs them has fewer than ``min_clients`` place clients, so
    it carries them along, and only the inputs are ever shuffled."""
    t1 = place_candidates(houses, intents)
    none = F.array().cast("array<string>")
    open_houses = (houses.join(_place_clients(houses, intents, min_clients), LISTING, "left")
                   .withColumn("_place", F.coalesce("_place", none)).where(F.size("_place") < min_clients))
    return t1.unionByName(area_candidates(open_houses, intents))


def top_clients_per_house(cands: DataFrame, k: int = 3) -> DataFrame:
    """All candidate rows of each listing's ``k`` most recently viewing clients.

    Ranking: ``max(see_time)`` per (listing, client) descending, ties by ``cid``.
    """
    ms = cands.groupBy(*PAIR_KEYS).agg(F.max("see_time").alias("_ms"))
    w = Window.partitionBy(*LISTING).orderBy(F.col("_ms").desc_nulls_last(), F.col("cid"))
    top = ms.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).select(*PAIR_KEYS)
    return cands.join(top, PAIR_KEYS, "left_semi")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each ``keys`` group under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_intent_per_pair(rows: DataFrame) -> DataFrame:
    """Per (listing, client) the row with the latest ``update_time`` (ties: ``rid``)."""
    keys = ["listing", *PAIR_KEYS] if "listing" in rows.columns else PAIR_KEYS
    return latest_per_key(rows, keys, [F.col("update_time").desc_nulls_last(), F.col("rid")])


# --- fused form used by the jobs -------------------------------------------

# payload columns fetched for the selected pairs only
_PAYLOAD_FIELDS = ("area_code", "price_start", "price_end", "house_type") + \
    INTENT_STRING_COLS + INTENT_DOUBLE_COLS + INTENT_INT_COLS


#: the key of the price index: both tiers' locations, room and type
INDEX_KEY = ["tier", "loc", "room_s", "rs"]
#: a node of the index: ``key`` numbers the keys that listings have
NODE = ["key", "node"]


def pair_index(houses: DataFrame, intents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The price index of both tiers: nodes of the listings (``listing``,
    ``tier``, ``key``, ``node``) and, for each node, a summary of each client's
    intent rows there: ``ms``, ``n_rows`` and the latest row. An intent row is
    in exactly one node of a listing that it matches, so summaries of a pair
    can be merged over the listing's nodes. Both are written."""
    def both_tiers(df: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(c).alias("loc")) for t, c in ((1, "place"), (2, "area"))])
        return df.withColumn("_k", F.explode(keys)).select("*", "_k.tier", "_k.loc").drop("_k", "place", "area")

    h = both_tiers(identified(houses).select("listing", "place", "area", "price", F.col("room").cast("string").alias("room_s"),
                                             F.col("rs_type").alias("rs")))
    keys = written(numbered(h.select(*INDEX_KEY).distinct().where("loc is not null"), [F.col(c) for c in INDEX_KEY], "listing-keys", "key"), "listing-keys")
    i = both_tiers(_intent_rooms(intents.select("cid", "rid", "see_time", "update_time", "place", "area", "price_start", "price_end",
                                                "house_type", "rs")).drop("house_type")).join(keys, INDEX_KEY)
    # a client's rows of one band are summarised before they are spread over nodes
    latest = F.struct("update_time", F.bitwise_not("rid").alias("not_rid"), "see_time")
    bands = written(i.groupBy("key", "tier", "price_start", "price_end", "cid").agg(
        F.max("see_time").alias("ms"), F.count(F.lit(1)).alias("n_rows"), F.max(latest).alias("latest")), "bands")
    cells, covered = price_nodes(h.join(keys, INDEX_KEY).select("listing", "tier", "key", "price"), bands, ["key"])
    summaries = covered.groupBy(*NODE, "tier", "cid").agg(
        F.max("ms").alias("ms"), F.sum("n_rows").alias("n_rows"), F.max("latest").alias("latest"))
    return written(cells.drop("price"), "listing-nodes"), written(summaries, "node-clients")


#: what an intent row asks for, beside its location
WISH = ["rs", "house_type", "price_start", "price_end"]
#: what a listing offers; equal listings have equal candidates
CELL = ["place", "area", "room", "rs_type", "price"]


def listing_cells(houses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered classes of listings that are alike in all that matching reads
    (``cell``, ``CELL``), and the listings with their ``cell``. Both are written."""
    cells = written(houses.select(*CELL).distinct().withColumn("cell", F.monotonically_increasing_id()), "cells")
    c = cells.select("cell", *[F.col(x).alias(f"_{x}") for x in CELL])
    same = [houses[x].eqNullSafe(c[f"_{x}"]) for x in CELL]
    known = [x for x in ("listing", *LISTING) if x in houses.columns]
    return cells, written(houses.join(c, same).select(*known, "cell"), "listing-cells")


def client_bands(intents: DataFrame) -> DataFrame:
    """Intent rows summarised per client, location and wish: ``ms``, ``n_rows``
    and the latest row. Written."""
    latest = F.struct("update_time", F.bitwise_not("rid").alias("not_rid"), "see_time")
    return written(intents.groupBy("area", "place", *WISH, "cid").agg(
        F.max("see_time").alias("ms"), F.count(F.lit(1)).alias("n_rows"), F.max(latest).alias("latest")), "client-bands")


def tier_tops(cells: DataFrame, bands: DataFrame, tier: int, m: int) -> DataFrame:
    """The ``m`` top clients of each cell on one tier: ``cell``, ``cid``, ``ms``.

    Rows of one location and wish match the same listings, so only their ``m``
    top clients are spread over rooms and nodes of the price index, and each
    node keeps its ``m`` top clients. Written."""
    on, key = {1: "place", 2: "area"}[tier], ["loc", "room_s", "rs"]
    at = cells.select("cell", F.col(on).alias("loc"), F.col("room").cast("string").alias("room_s"), F.col("rs_type").alias("rs"), "price")
    keys = written(at.select(*key).distinct().where("loc is not null").withColumn("key", F.monotonically_increasing_id()), "cell-keys")
    clients = bands.groupBy(F.col(on).alias("loc"), *WISH, "cid").agg(F.max("ms").alias("ms"))
    offers = _intent_rooms(_tops(clients, ["loc", *WISH], m)).join(keys, key)
    nodes, covered = price_nodes(at.join(keys, key).select("cell", "key", "price"),
                                 written(offers.select("key", "price_start", "price_end", "cid", "ms"), "offers"), ["key"])
    lists = written(node_tops(covered.groupBy(*NODE, "cid").agg(F.max("ms").alias("ms")), m), "node-tops")
    found = nodes.select("cell", *NODE).join(lists, NODE).groupBy("cell", "cid").agg(F.max("ms").alias("ms"))
    return written(_tops(found, ["cell"], m), "cell-tops")


def cell_rows(pairs: DataFrame, cells: DataFrame, bands: DataFrame) -> DataFrame:
    """Summaries of ``pairs`` (``cell``, ``cid``, ``tier``) over all rows of the
    client that match the cell on that tier. Joined by client and location."""
    loc = F.when(F.col("tier") == 1, F.col("place")).otherwise(F.col("area")).alias("loc")
    p = pairs.join(cells, "cell").select("cell", "cid", "tier", loc, F.col("room").cast("string").alias("_room"), F.col("rs_type").alias("rs"), "price")
    keys = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(c).alias("loc")) for t, c in ((1, "place"), (2, "area"))])
    b = bands.withColumn("_k", F.explode(keys)).select("cid", *WISH, "ms", "n_rows", "latest", "_k.tier", "_k.loc")
    fits = F.col("price").between(F.col("price_start"), F.col("price_end")) & F.array_contains(F.split("house_type", ",", -1), F.col("_room"))
    return (p.join(b, ["cid", "tier", "loc", "rs"]).where(fits).groupBy("cell", "cid", "tier")
            .agg(F.max("ms").alias("ms"), F.sum("n_rows").alias("n_rows"), F.max("latest").alias("latest")))


def match_pairs(houses: DataFrame, intents: DataFrame, k: int = 3,
                min_clients: int = 3) -> DataFrame:
    """J1+J2+T1+W2 at once, as per-pair summaries of the selected clients.

    Listings that are alike are matched once, as a cell. Each set of intents
    with one wish and each node of the price index keep their top clients by
    (latest viewing, then ``cid``): a cell's top client is also among the top
    where it has its latest viewing, so lists of ``k`` clients are enough on
    place, and ``k + min_clients - 1`` on area, where up to ``min_clients - 1``
    place clients are left out. Lists of ``min_clients`` tell whether a cell
    is full on place; only the others are looked up on area. The candidates
    are then summarised and ranked.
    """
    cells, at = listing_cells(identified(houses))
    bands = client_bands(intents)
    place = tier_tops(cells, bands, 1, max(k, min_clients))
    full = place.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_clients).select("cell")
    area = (tier_tops(written(cells.join(full, "cell", "left_anti"), "open-cells"), bands, 2, k + min_clients - 1)
            .join(place.select("cell", "cid"), ["cell", "cid"], "left_anti"))
    both = place.withColumn("tier", F.lit(1)).unionByName(area.withColumn("tier", F.lit(2)))
    rows = written(cell_rows(both, cells, bands).select(
        "cell", "cid", "ms", "n_rows", "tier", F.bitwise_not(F.col("latest.not_rid")).alias("rid"),
        F.col("latest.see_time").alias("see_time"), F.col("latest.update_time").alias("update_time")), "cell-clients")
    return _tops(rows, ["cell"], k, "rank").join(at, "cell").select(
        "listing", *PAIR_KEYS, "ms", "n_rows", "tier", "rid", "see_time", "update_time", "rank")


def _tops(df: DataFrame, of: list[str], m: int, rank: str | None = None) -> DataFrame:
    """The ``m`` first rows of each group by latest viewing, then ``cid``."""
    w = Window.partitionBy(*of).orderBy(F.col("ms").desc_nulls_last(), F.col("cid"))
    top = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= m)
    return top.withColumnRenamed("_r", rank) if rank else top.drop("_r")


def node_tops(summaries: DataFrame, m: int) -> DataFrame:
    """The ``m`` top clients of each node, by latest viewing, then ``cid``."""
    return _tops(summaries.select(*NODE, "cid", "ms"), NODE, m)


def with_listing(pairs: DataFrame, houses: DataFrame) -> DataFrame:
    """Summaries with the listing's keys and the latest row spelled out."""
    return pairs.join(houses.select("listing", *LISTING), "listing").select(
        "listing", *PAIR_KEYS, "ms", "n_rows", "tier", F.bitwise_not(F.col("latest.not_rid")).alias("rid"),
        F.col("latest.see_time").alias("see_time"), F.col("latest.update_time").alias("update_time"), "rank")


def pair_rows(pairs: DataFrame, houses: DataFrame, intents: DataFrame) -> DataFrame:
    """T1 from selected pairs: every intent row of a pair that matches its
    listing on the pair's tier. Joined by client, so only rows of selected
    clients are ever paired with a listing."""
    h = identified(houses).select("listing", "price", "rs_type", F.col("room").cast("string").alias("_room"),
                                  F.col("place").alias("_place"), F.col("area").alias("_area"))
    p = pairs.select("listing", *PAIR_KEYS, "tier").join(h, "listing")
    i = _intent_rooms(intents.select("rid", F.col("cid").alias("_cid"), "see_time", "update_time", "place", "area",
                                     "price_start", "price_end", "house_type", "rs"))
    at = ((p["tier"] == 1) & (p["_place"] == i["place"])) | ((p["tier"] == 2) & (p["_area"] == i["area"]))
    return (p.join(i, (p["cid"] == i["_cid"]) & (p["rs_type"] == i["rs"]) & (p["_room"] == i["room_s"]) & at
                   & p["price"].between(i["price_start"], i["price_end"]))
            .select("listing", *PAIR_KEYS, "tier", "rid", "see_time", "update_time"))


def match_result(pairs: DataFrame, houses: DataFrame, intents: DataFrame) -> DataFrame:
    """Selected pairs with the listing's and the latest intent row's columns."""
    h = identified(houses).select("listing", "city_code", "share_worker_id")
    return pairs.join(intents.select("rid", *_PAYLOAD_FIELDS), "rid").join(h, "listing")


def _c4_order():
    return [F.col("see_time").desc_nulls_last(), F.col("update_time").desc_nulls_last(),
            F.col("rid")]


def best_client_per_house(houses: DataFrame, intents: DataFrame) -> DataFrame:
    """C4 (older rule, J3 + W3 + W2): per listing, the single client row with the
    latest ``see_time`` (ties: latest ``update_time``, then ``rid``) among
    place-or-area candidates.

    A range maximum instead of a join on area or place: intents of a location
    lie in the nodes of the dyadic price index, where only the best row for
    each ``house_type`` is kept. The room test ``room <= house_type`` is a
    running maximum over the node's ordered house types, read at each room
    that asks there. A listing merges the O(log) results of its nodes.
    """
    key = ["tier", "loc"]

    def both_tiers(df: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(c).alias("loc")) for t, c in ((1, "place"), (2, "area"))])
        return df.withColumn("_k", F.explode(keys)).select("*", "_k.tier", "_k.loc").drop("_k", "place", "area")

    best = latest_per_key(intents, ["area", "place", "price_start", "price_end", "house_type"], _c4_order())
    row = F.struct("see_time", "update_time", F.bitwise_not("rid").alias("not_rid"), "cid")
    nodes, bands = price_nodes(
        both_tiers(houses.select("fh_id", "share_id", "price", "area", "place", F.col("room").cast("string").alias("kind"))),
        both_tiers(best.select("area", "place", "price_start", "price_end", F.col("house_type").alias("kind"), row.alias("row"))), key)
    nodes = written(nodes, "listing-nodes")
    at = [*key, "node"]
    offers = bands.groupBy(*at, "kind").agg(F.max("row").alias("row")).withColumn("asks", F.lit(False))
    asks = nodes.select(*at, "kind").distinct().select("*", F.lit(None).cast(offers.schema["row"].dataType).alias("row"), F.lit(True).alias("asks"))
    from_above = Window.partitionBy(*at).orderBy(F.col("kind").desc(), "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = (offers.unionByName(asks).withColumn("row", F.max("row").over(from_above))
             .where(F.col("asks") & F.col("row").isNotNull()).drop("asks"))
    # of a row that matches on both, the place match counts
    first = F.struct("row", (-F.col("tier")).alias("not_tier"), (-F.col("share_id")).alias("not_share"))
    top = nodes.join(found, [*at, "kind"]).groupBy("fh_id").agg(F.max(first).alias("t"))
    return top.select("fh_id", (-F.col("t.not_share")).alias("share_id"), "t.row.cid", F.bitwise_not(F.col("t.row.not_rid")).alias("rid"),
                      "t.row.see_time", "t.row.update_time", (-F.col("t.not_tier")).alias("tier"))


def place_or_area_candidates(houses: DataFrame, intents: DataFrame) -> DataFrame:
    """Each intent row matches a listing on place, or else on area.

    Price band compared numerically; the room test is the string comparison
    ``string(room) <= house_type`` of the older rule. Two equi-joins: place
    matches, and area matches whose place differs (the ``else`` branch).
    """
    h = houses.select("fh_id", "share_id", "price", "area", "place", F.col("room").cast("string").alias("_room"))
    i = intents.select("rid", "cid", "see_time", "update_time", "price_start", "price_end",
                       "house_type", F.col("area").alias("_iarea"), F.col("place").alias("_iplace"))
    fits = F.col("_room") <= F.col("house_type")
    by_place = pairs_in_band(i, listing_blocks(h, ["place", "_room"]), ["place", "_room"], (F.col("place") == F.col("_iplace")) & fits)
    by_area = pairs_in_band(i, listing_blocks(h, ["area", "_room"]), ["area", "_room"], (F.col("area") == F.col("_iarea")) & fits)
    by_area = by_area.where(~F.col("listing.place").eqNullSafe(F.col("_iplace")))
    by_place, by_area = (x.select("listing.fh_id", "listing.share_id", *i.columns, F.lit(t).alias("tier")) for x, t in ((by_place, 1), (by_area, 2)))
    cols = ["fh_id", "share_id", "cid", "rid", "see_time", "update_time", "tier"]
    return by_place.select(*cols).unionByName(by_area.select(*cols))
