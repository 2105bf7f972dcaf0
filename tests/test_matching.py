
from conftest import SF_SMALL
from strata.operators import matching
from strata.plans import queries as Q

H_SCHEMA = "fh_id long, share_id long, area string, place string, room int, price double, rs_type int"
I_SCHEMA = ("rid long, cid string, see_time string, update_time string, area_code string, "
            "price_start double, price_end double, house_type string, require_type int")


def _frames(spark, houses, intents):
    h = matching.normalize_houses(spark.createDataFrame(houses, H_SCHEMA))
    i = matching.normalize_intents(spark.createDataFrame(intents, I_SCHEMA))
    return h, i


def _intent(rid, cid, place, see="2024-01-01", area="A", ht="2", rt=1, lo=0.0, hi=10.0):
    return (rid, cid, see, see, f"01-{area}-{place}", lo, hi, ht, rt)


def test_area_tier_opens_below_three_place_clients(spark):
    houses = [(1, 1, "A", "P", 2, 5.0, 1)]
    intents = [_intent(1, "c1", "P", "2024-01-04"), _intent(2, "c2", "P", "2024-01-03"),
               _intent(3, "c3", "Q", "2024-01-05"), _intent(4, "c4", "Q", "2024-01-06")]
    h, i = _frames(spark, houses, intents)
    c = matching.match_candidates(h, i)
    assert sorted((r.cid, r.tier) for r in c.collect()) == [("c1", 1), ("c2", 1), ("c3", 2), ("c4", 2)]
    top = matching.top_clients_per_house(c)
    assert sorted(r.cid for r in top.collect()) == ["c1", "c3", "c4"]  # a place client dropped


def test_three_place_clients_close_the_area_tier(spark):
    houses = [(1, 1, "A", "P", 2, 5.0, 1)]
    intents = [_intent(k, f"c{k}", "P") for k in (1, 2, 3)] + [_intent(9, "c9", "Q", "2030-01-01")]
    h, i = _frames(spark, houses, intents)
    assert {r.tier for r in matching.match_candidates(h, i).collect()} == {1}


def test_room_price_and_type_predicates(spark):
    houses = [(1, 1, "A", "P", 3, 5.0, 2)]
    intents = [_intent(1, "ok", "P", ht="2,3", rt=4), _intent(2, "room", "P", ht="2,33", rt=2),
               _intent(3, "type", "P", ht="3", rt=1), _intent(4, "price", "P", ht="3", rt=2, lo=6.0),
               _intent(5, "nulls", "P", ht="3", rt=2, lo=None, hi=5.0)]
    h, i = _frames(spark, houses, intents)
    assert sorted(r.cid for r in matching.place_candidates(h, i).collect()) == ["nulls", "ok"]


def test_latest_row_per_pair_and_tie_break(spark):
    houses = [(1, 1, "A", "P", 2, 5.0, 1)]
    intents = [(1, "c", "2024-01-01", "2024-01-05", "01-A-P", 0.0, 9.0, "2", 1),
               (2, "c", "2024-01-09", "2024-01-07", "01-A-P", 0.0, 9.0, "2", 1),
               (3, "c", "2024-01-02", "2024-01-07", "01-A-P", 0.0, 9.0, "2", 1)]
    h, i = _frames(spark, houses, intents)
    w2 = matching.latest_intent_per_pair(matching.match_candidates(h, i)).collect()
    assert [(r.cid, r.rid) for r in w2] == [("c", 2)]
    fused = matching.match_result(matching.match_pairs(h, i), h, i).collect()
    assert [(r.cid, r.rid, r.n_rows, r.ms, r.area_code) for r in fused] == [("c", 2, 3, "2024-01-09", "01-A-P")]


def test_fused_chain_equals_stepwise_chain(spark):
    stepwise = {tuple(r) for r in Q.w2_latest_per_key(spark, SF_SMALL).collect()}
    fused = {tuple(r) for r in Q.c3_match_stateless(spark, SF_SMALL).collect()}
    assert stepwise == fused and len(fused) == 291


def test_node_tops_are_limited_before_the_shuffle(spark):
    h, i = Q._houses(spark, SF_SMALL), Q._intents(spark, SF_SMALL)
    _, summaries = matching.pair_index(h, i)
    plan = matching.node_tops(summaries, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_nodes_join_exactly_the_bands_that_hold_a_price(spark):
    import random
    from strata.operators.price_index import price_nodes
    rnd = random.Random(9)
    prices = [(rnd.choice("ab"), rnd.choice([0.0, -0.0, 1.5, 2.25, 7.0, 1e300, -3.0, float("inf")] + [rnd.random() * 9]), n) for n in range(120)]
    bands = []
    for n in range(150):
        lo, hi = rnd.choice([p[1] for p in prices] + [rnd.random() * 9]), rnd.choice([p[1] for p in prices] + [rnd.random() * 9])
        bands.append((rnd.choice(["a", "b", "c"]), lo, hi, n))
    p = spark.createDataFrame(prices + [(None, 1.0, 999)], "key string, price double, p int")
    b = spark.createDataFrame(bands + [(None, 0.0, 2.0, 999)], "key string, price_start double, price_end double, b int")
    own, covered = price_nodes(p, b, ["key"])
    got = sorted(tuple(r) for r in own.join(covered, ["key", "node"]).select("p", "b").collect())
    want = sorted((n, m) for k, price, n in prices for k2, lo, hi, m in bands if k == k2 and lo <= price <= hi)
    assert got == want  # each pair once


def test_best_client_equals_the_candidate_join(spark):
    from test_assignment import _random_case
    for seed in range(3):
        houses, intents = _random_case(50 + seed, n_houses=20, n_intents=60, n_clients=9)
        h, i = _frames(spark, houses, intents)
        slow = matching.latest_per_key(matching.place_or_area_candidates(h, i), ["fh_id"], matching._c4_order())
        cols = ["fh_id", "cid", "rid", "see_time", "tier"]
        assert sorted(map(tuple, matching.best_client_per_house(h, i).select(*cols).collect())) == sorted(map(tuple, slow.select(*cols).collect()))


def test_rows_that_differ_in_which_column_is_null_keep_their_ids(spark):
    """Without row ids: intents that differ only in which column is null."""
    schema = I_SCHEMA.replace("rid long, ", "") + ", area_name string, purpose_school_name string"
    base = ("c", "2024-01-01", "2024-01-01", "01-A-P", 0.0, 9.0, "2", 1)
    rows = [(*base, "S", None), (*base, None, "S"), (*base, "S", None)]
    i = matching.normalize_intents(spark.createDataFrame(rows, schema))
    got = [(r.rid, r.area_name, r.purpose_school_name) for r in i.collect()]
    assert len({r[0] for r in got}) == 3
    h = matching.normalize_houses(spark.createDataFrame([(1, 1, "A", "P", 2, 5.0, 1)] * 2, H_SCHEMA))
    h = matching.identified(h)
    pairs = matching.match_pairs(h, i)
    out = matching.match_result(pairs, h, i).collect()
    assert [r.n_rows for r in out] == [3, 3] and len({r.listing for r in out}) == 2
    payload = {rid: (a, b) for rid, a, b in got}
    assert all((r.area_name, r.purpose_school_name) == payload[r.rid] for r in out)


def test_zero_codes_option_and_null_listing_fields(spark):
    intents = [(1, "a", "2024-01-01", "2024-01-01", "01-0-P", 0.0, 9.0, "2", 1),
               (2, "b", "2024-01-01", "2024-01-01", "01-A-0", 0.0, 9.0, "2", 1),
               (3, "c", "2024-01-01", "2024-01-01", "01-A-P", 0.0, 9.0, "2", 1)]
    df = spark.createDataFrame(intents, I_SCHEMA)
    assert matching.normalize_intents(df).count() == 3            # D4 kept: '0' codes pass
    kept = [r.cid for r in matching.normalize_intents(df, exclude_zero_codes=True).collect()]
    assert kept == ["c"]
    houses = spark.createDataFrame([(None, None, "A", None, None, None, None)], H_SCHEMA)
    h = matching.normalize_houses(houses).first()
    assert (h.fh_id, h.share_id, h.room, h.price, h.rs_type) == (0, 0, 0, 0.0, 0)
    i = matching.normalize_intents(df)
    assert matching.place_candidates(matching.normalize_houses(houses), i).count() == 0


def test_clients_with_one_wish_are_cut_before_they_are_spread(spark, monkeypatch):
    """Tables written while matching grow with the distinct wishes, not with clients times nodes."""
    rows, write = {}, matching.written
    monkeypatch.setattr(matching, "written", lambda df, name: rows.setdefault(name, []).append(write(df, name)) or rows[name][-1])
    houses = [(n, n, "A", "P", 2, 1.0 + n % 7, 1) for n in range(14)]
    intents = [_intent(n, f"c{n}", "P", see=f"2024-01-{n % 28 + 1:02d}") for n in range(300)]
    pairs = matching.match_pairs(*_frames(spark, houses, intents))
    got = {(r.fh_id, r.cid) for r in pairs.collect()}
    assert got == {(n, c) for n in range(14) for c in ("c111", "c139", "c167")}
    sizes = {name: max(df.count() for df in dfs) for name, dfs in rows.items()}
    assert sizes["cells"] == 7 and sizes.pop("client-bands") == 300
    assert max(sizes.values()) <= 30


def test_match_candidates_shuffle_no_pairs(spark):
    """The gate of the area tier comes from the price index: no candidate row is grouped or joined again."""
    houses = [(1, 1, "A", "P", 2, 5.0, 1), (1, 1, "A", "R", 2, 5.0, 1), (2, 2, "A", "R", 2, 5.0, 1)]
    intents = [_intent(n, f"c{n}", "P") for n in (1, 2)] + [_intent(n, f"c{n}", "R") for n in (2, 3)]
    h, i = _frames(spark, houses, intents)
    c = matching.match_candidates(h, i)
    assert sorted((r.fh_id, r.cid, r.tier) for r in c.collect()) == [
        (1, "c1", 1), (1, "c2", 1), (1, "c2", 1), (1, "c3", 1),  # three place clients over both rows
        (2, "c1", 2), (2, "c2", 1), (2, "c3", 1)]
    plan = c._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
