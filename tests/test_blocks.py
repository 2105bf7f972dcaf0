"""Joins that return every pair (J1, J2, J3): blocks of listings."""

import random

import pytest

from strata.operators import blocks, matching

H_SCHEMA = "fh_id long, share_id long, area string, place string, room int, price double, rs_type int"
I_SCHEMA = ("rid long, cid string, see_time string, update_time string, area_code string, "
            "price_start double, price_end double, house_type string, require_type int")


def _frames(spark, n_houses, n_intents, places=("P", "Q", None), rooms=(1, 2, 3)):
    rnd = random.Random(5)
    houses = [(f, f % 7, rnd.choice(["A", "B", None]), rnd.choice(places), rnd.choice(rooms), rnd.choice([1.0, 2.0, 2.0, 5.0, float("nan"), None]), 1)
              for f in range(n_houses)]
    houses += houses[:3]
    intents = [(r, f"c{r % 9}", "2024-01-01", "2024-01-01", f"01-{rnd.choice('AB')}-{rnd.choice('PQ')}", rnd.choice([0.0, 2.0, None]),
                rnd.choice([2.0, 5.0, float("nan")]), rnd.choice(["1", "1,2", "3,3", "2,3"]), 1) for r in range(n_intents)]
    return (matching.normalize_houses(spark.createDataFrame(houses, H_SCHEMA)),
            matching.normalize_intents(spark.createDataFrame(intents, I_SCHEMA)))


def _in_band(h, i):
    up = lambda v: (v != v, 0 if v != v else v)  # noqa: E731  NaN is the largest number
    return up(i["price_start"]) <= up(h["price"]) <= up(i["price_end"])


@pytest.mark.parametrize("size", [1, 3, 256])
def test_every_pair_is_found_across_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK", size)
    h, i = _frames(spark, 60, 40)
    hs, its = [r.asDict() for r in h.collect()], [r.asDict() for r in i.collect()]
    fits = [(x, y) for x in hs for y in its if _in_band(x, y) and str(x["room"]) in y["house_type"].split(",") and x["rs_type"] == y["rs"]]
    exp = sorted((x["share_id"], x["fh_id"], y["cid"], y["rid"]) for x, y in fits if x["place"] == y["place"])
    got = matching.place_candidates(h, i)
    assert sorted((r.share_id, r.fh_id, r.cid, r.rid) for r in got.collect()) == exp and len(exp) > 100
    assert got.columns[:6] == ["fh_id", "share_id", "city_code", "share_worker_id", "price", "rs_type"] and got.columns[-1] == "tier"
    old = [(x, y, 1 if x["place"] == y["place"] else 2) for x in hs for y in its
           if _in_band(x, y) and str(x["room"]) <= y["house_type"] and (x["place"] == y["place"] or x["area"] == y["area"])]
    got = matching.place_or_area_candidates(h, i).collect()
    assert sorted((r.fh_id, r.share_id, r.cid, r.rid, r.tier) for r in got) == sorted(
        (x["fh_id"], x["share_id"], y["cid"], y["rid"], t) for x, y, t in old)


def _runs(values):
    return 1 + sum(a != b for a, b in zip(values, values[1:]))


@pytest.mark.parametrize("pairs", [matching.place_candidates, matching.match_candidates, matching.place_or_area_candidates])
def test_pairs_of_one_intent_row_lie_together(spark, pairs):
    """So a file of the result repeats an intent's values instead of listing
    them anew for each listing."""
    h, i = _frames(spark, 300, 200, places=("P",), rooms=(2,))
    rows = pairs(h, i).select("rid", "tier").collect()
    assert len(rows) > 20 * i.count()
    assert _runs([(r.rid, r.tier) for r in rows]) <= 2 * len({(r.rid, r.tier) for r in rows})
