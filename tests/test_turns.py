"""The capped assignment by groups: a group's walk, and rounds over groups."""

import random

import pyarrow as pa
import pytest

from conftest import SF_SMALL
from seq_model import sequential
from strata.operators import matching
from strata.operators.assignment import assign_capped
from strata.operators.turns import take_turns
from strata.plans import queries as Q
from strata.plans.match_job import run_match_job
from strata.sources import bindings

H_SCHEMA = "fh_id long, share_id long, area string, place string, room int, price double, rs_type int"
I_SCHEMA = ("rid long, cid string, see_time string, update_time string, area_code string, "
            "price_start double, price_end double, house_type string, require_type int")


def _case(seed, n_houses, n_intents, n_clients):
    """Normalised listings and intents."""
    rnd = random.Random(seed)
    houses = [{"fh_id": f, "share_id": f, "area": rnd.choice(["A", "B", None]), "place": rnd.choice(["P", "Q", "R", None]),
               "room": rnd.randint(1, 3), "price": float(rnd.randint(0, 30)), "rs_type": rnd.randint(1, 2)} for f in range(n_houses)]
    intents = []
    for r in range(n_intents):
        low = float(rnd.randint(0, 25)) + rnd.choice([0.0, 0.5])
        intents.append({"rid": r, "cid": f"c{rnd.randint(0, n_clients)}", "see_time": rnd.choice([None, *[f"2024-01-{d:02d}" for d in range(1, 9)]]),
                        "update_time": "2024-02-01", "area": rnd.choice("AB"), "place": rnd.choice("PQR"), "price_start": low,
                        "price_end": low + rnd.choice([-1.0, 0.0, 0.25, 4.0, 20.0]), "house_type": rnd.choice(["1", "1,2", "2,2,3", "1,2,3"]), "rs": rnd.randint(1, 2)})
    return houses, intents


def _tables(houses, intents, counts, cap, told=()):
    keys, listings, offers = {}, [], []
    for h in houses:
        for tier, loc in ((1, h["place"]), (2, h["area"])):
            if loc is not None:
                key = keys.setdefault((tier, loc, str(h["room"]), h["rs_type"]), len(keys))
                listings.append((h["share_id"], tier, key, h["price"]))
    for i in intents:
        for tier, loc in ((1, i["place"]), (2, i["area"])):
            for room in dict.fromkeys(i["house_type"].split(",")):
                if (tier, loc, room, i["rs"]) in keys and counts.get(i["cid"], 0) <= cap:
                    offers.append((keys[tier, loc, room, i["rs"]], i["price_start"], i["price_end"], i["cid"], i["see_time"], 1, cap - counts.get(i["cid"], 0)))
    random.Random(1).shuffle(listings)
    table = lambda rows, types: pa.table({n: pa.array([r[j] for r in rows], t) for j, (n, t) in enumerate(types.items())})
    return (table(listings, {"listing": pa.int64(), "tier": pa.int32(), "key": pa.int64(), "price": pa.float64()}),
            table(offers, {"key": pa.int64(), "price_start": pa.float64(), "price_end": pa.float64(), "cid": pa.string(), "ms": pa.string(),
                           "n": pa.int64(), "allowed": pa.int64()}),
            table(told, {"listing": pa.int64(), "cid": pa.string(), "n": pa.int64()}))


@pytest.mark.parametrize("k, min_clients, cap", [(3, 3, 3), (2, 4, 1), (4, 2, 6), (1, 1, 0)])
def test_turns_equal_the_sequential_model(k, min_clients, cap):
    taken = 0
    for seed in range(40):
        houses, intents = _case(seed, 60, 10 + 8 * seed, 4 + seed)
        counts = {"c1": 1, "c2": cap, "c3": cap + 1} if seed % 2 else {}
        out = take_turns(*_tables(houses, intents, counts, cap), k, min_clients)
        cids = pa.array(out["cid"]).to_pylist()
        exp, _ = sequential(houses, intents, counts, k=k, cap=cap, min_clients=min_clients)
        assert sorted(zip(out["listing"], cids, out["n"])) == sorted((s, c, n) for s, _, c, _, n in exp)
        taken += len(cids)
    assert taken > 500


def test_takes_of_other_groups_count_from_their_listing_on():
    houses = [{"fh_id": f, "share_id": f, "area": "A", "place": "P", "room": 1, "price": 5.0, "rs_type": 1} for f in (1, 3, 5)]
    intents = [{"rid": 1, "cid": "c", "see_time": None, "update_time": None, "area": "A", "place": "P", "price_start": 0.0, "price_end": 9.0, "house_type": "1", "rs": 1}]
    for told, exp in (((), [1, 3, 5]), (((2, "c", 9), (0, "other", 99)), [1]), (((3, "c", 2), (4, "c", 2)), [1, 3]), (((0, "c", 4),), [])):
        out = take_turns(*_tables(houses, intents, {}, 3, told), 3, 3)
        assert out["listing"] == exp


@pytest.mark.parametrize("group_rows", [0, 1 << 40])
def test_clients_in_several_groups(spark, group_rows):
    """Areas dealt by type and room, whose listings push the same clients on to
    each other; or, at once, in one round a group of areas."""
    houses, intents = _case(11, 40, 160, 14)
    for i in intents:
        i["require_type"] = {1: 1, 2: 2}[i["rs"]]
        i["area_code"] = f"01-{i['area']}-{i['place']}"
    order = lambda schema: [c.split()[0] for c in schema.split(", ")]
    h = matching.normalize_houses(spark.createDataFrame([[x[c] for c in order(H_SCHEMA)] for x in houses], H_SCHEMA))
    i = matching.normalize_intents(spark.createDataFrame([[x[c] for c in order(I_SCHEMA)] for x in intents], I_SCHEMA))
    counts = {"c1": 2, "c2": 4, "c99": 1}
    picks, new, steps = assign_capped(h, i, spark.createDataFrame(list(counts.items()), "cid string, count long"), group_rows=group_rows)
    hs, its = [r.asDict() for r in h.collect()], [r.asDict() for r in i.collect()]
    exp, exp_counts = sequential(hs, its, counts)
    assert sorted((r.share_id, r.fh_id, r.cid, r.rid, r.n_rows) for r in picks.collect()) == sorted(exp) and len(exp) > 20
    assert {r.cid: r["count"] for r in new.collect()} == exp_counts
    assert steps > 1 if group_rows == 0 else steps == 1


def test_a_long_chain_needs_one_round(spark):
    """Each listing takes a client that the next one would have taken."""
    h = matching.normalize_houses(spark.createDataFrame([(f, f, "A", "P", 2, 5.0, 1) for f in range(60)], H_SCHEMA))
    i = matching.normalize_intents(spark.createDataFrame(
        [(r, f"c{r:03d}", f"2024-01-{r % 28 + 1:02d}", "2024-02-01", "01-A-P", 0.0, 9.0, "2", 1) for r in range(90)], I_SCHEMA))
    picks, _, steps = assign_capped(h, i, cap=0)
    assert steps == 1 and picks.count() == 90


def _expected(spark, houses, intents, state):
    h = [r.asDict() for r in matching.normalize_houses(houses).collect()]
    exp, counts = sequential(h, [r.asDict() for r in matching.normalize_intents(intents).collect()], state)
    return sorted((s, f, c) for s, f, c, _, _ in exp), counts


def test_match_job_needs_one_round(spark, tmp_path):
    """C3 on paths: result and counters of the sequential model, the counters
    of the day before it being those of the stored state."""
    houses, intents = bindings.houses(spark, SF_SMALL), bindings.intents(spark, SF_SMALL)
    state = {"C1": 3, "C2": 4}
    at, result = str(tmp_path / "state"), str(tmp_path / "result")
    spark.createDataFrame([(c, n, "2024-02-01") for c, n in state.items()], "cid string, count long, p_date string").write.parquet(at)
    assert run_match_job(spark, houses, intents, at, result, "2024-02-01") == 1
    exp, counts = _expected(spark, houses, intents, state)
    assert sorted((r.share_id, r.fh_id, r.cid) for r in spark.read.parquet(result).collect()) == exp and exp
    assert {r.cid: r["count"] for r in spark.read.parquet(at).collect()} == counts


def test_match_job_on_catalog_tables_needs_one_round(spark):
    """C3 on tables whose intents have no row id, run twice: the second run
    starts from the first one's counters."""
    db = Q._database(spark)
    houses, intents = bindings.houses(spark, SF_SMALL), bindings.intents(spark, SF_SMALL).drop("rid")
    houses.write.saveAsTable(f"{db}.listings")
    intents.write.saveAsTable(f"{db}.intents")
    state = {}
    for _ in range(2):
        assert run_match_job(spark, spark.table(f"{db}.listings"), spark.table(f"{db}.intents"), f"{db}.counts", f"{db}.result", "2024-02-01") == 1
        exp, state = _expected(spark, houses, intents, state)
        assert sorted((r.share_id, r.fh_id, r.cid) for r in spark.table(f"{db}.result").collect()) == exp and exp
        assert {r.cid: r["count"] for r in spark.table(f"{db}.counts").collect()} == state
