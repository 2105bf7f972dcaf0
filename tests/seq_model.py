"""Plain-Python sequential model of the capped assignment, for tests only.

It walks listings one by one exactly as the rule is stated (small inputs).
"""

from __future__ import annotations


def _match(h, i, loc):
    return (h[loc] is not None and h[loc] == i[loc] and h["rs_type"] == i["rs"]
            and str(h["room"]) in i["house_type"].split(",")
            and i["price_start"] <= h["price"] <= i["price_end"])


def _desc_key(v):
    # order by v desc nulls last
    return (v is None, tuple(-ord(ch) for ch in v) if v is not None else ())


def sequential(houses, intents, counts=None, k=3, cap=3, min_clients=3):
    counts = dict(counts or {})
    pool = [i for i in intents if counts.get(i["cid"], 0) <= cap]
    out = []
    for h in sorted(houses, key=lambda r: (r["share_id"], r["fh_id"])):
        t1 = [i for i in pool if _match(h, i, "place")]
        c1 = {i["cid"] for i in t1}
        cand = list(t1)
        if len(c1) < min_clients:
            cand += [i for i in pool if i["cid"] not in c1 and _match(h, i, "area")]
        ms = {}
        for i in cand:
            cur = ms.get(i["cid"], None)
            if i["cid"] not in ms or (i["see_time"] is not None and (cur is None or i["see_time"] > cur)):
                ms[i["cid"]] = i["see_time"]
        top = sorted(ms, key=lambda c: (_desc_key(ms[c]), c))[:k]
        for c in top:
            rows = [i for i in cand if i["cid"] == c]
            counts[c] = counts.get(c, 0) + len(rows)
            best = sorted(rows, key=lambda i: (_desc_key(i["update_time"]), i["rid"]))[0]
            out.append((h["share_id"], h["fh_id"], c, best["rid"], len(rows)))
        pool = [i for i in pool if counts.get(i["cid"], 0) <= cap]
    return out, counts
