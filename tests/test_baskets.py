"""Association rules against a brute-force enumeration on a small fixture."""

import math
import random
from itertools import combinations

from conftest import line

from clientele.operators import baskets


def brute_rules(sets, min_support, min_conf):
    n = len(sets)
    items = sorted(set().union(*sets))
    count = {}
    for k in range(1, len(items) + 1):
        for combo in combinations(items, k):
            c = sum(1 for s in sets if set(combo) <= s)
            if c >= min_support * n:
                count[combo] = c
    rules = {}
    for combo, c in count.items():
        if len(combo) < 2:
            continue
        for rhs in combo:
            lhs = tuple(i for i in combo if i != rhs)
            conf = c / count[lhs]
            if conf >= min_conf:
                rules[("{" + ",".join(lhs) + "}", "{" + rhs + "}")] = (
                    c / n, conf, count[lhs] / n, conf / (count[(rhs,)] / n), c)
    return rules


def test_rules_match_brute_force(spark, make_txn):
    baskets_spec = [["Tops", "Bags"], ["Tops", "Bags", "Shoes"], ["Tops"], ["Bags", "Shoes"],
                    ["Tops", "Shoes"], ["Tops", "Bags", "Tops"], ["Dresses"], ["Bags"]]
    rows = []
    for t, cats in enumerate(baskets_spec):
        rows += [line(transaction_id=t, category=c) for c in cats]
    rows.append(line(transaction_id=99, category="Tops", status="Cancelled"))
    b = baskets.basket_items(make_txn(rows))
    # the repeated category in transaction 5 is one item
    assert {r["transaction_id"]: r["items"] for r in b.collect()}[5] == ["Bags", "Tops"]
    got = {(r["lhs"], r["rhs"]): (r["support"], r["confidence"], r["coverage"], r["lift"],
                                  r["count"])
           for r in baskets.association_rules(b, min_support=0.2, min_confidence=0.3).collect()}
    want = brute_rules([set(s) for s in baskets_spec], 0.2, 0.3)
    assert set(got) == set(want)
    for k in want:
        for g, w in zip(got[k], want[k]):
            assert abs(g - w) < 1e-12


def _itemsets(spark, sets, min_support, max_len=baskets.MAX_LEN):
    df = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(sets)], "transaction_id long, items array<string>")
    found = baskets.frequent_itemsets(baskets.collapsed(df), len(sets), min_support, max_len).collect()
    assert len({tuple(r["items"]) for r in found}) == len(found)
    return {tuple(r["items"]): r["freq"] for r in found}


def _brute_itemsets(sets, min_support, max_len=baskets.MAX_LEN):
    """Depth-first over all frequent sets, counting the baskets of each."""
    least = max(1, math.ceil(min_support * len(sets)))
    holds = {}
    for i, s in enumerate(sets):
        for x in s:
            holds.setdefault(x, set()).add(i)
    items = sorted(x for x in holds if len(holds[x]) >= least)
    out = {}

    def grow(prefix, rows, later):
        for i, x in enumerate(later):
            both = holds[x] if rows is None else rows & holds[x]
            if len(both) >= least:
                out[(*prefix, x)] = len(both)
                if len(prefix) + 1 < max_len:
                    grow((*prefix, x), both, later[i + 1:])

    grow((), None, items)
    return out


def test_small_domain_equals_brute_force(spark):
    rng = random.Random(1)
    sets = [set(rng.sample("abcdef", rng.randrange(1, 7))) for _ in range(400)]
    for support, longest in ((0.001, 10), (0.2, 10), (0.001, 3), (0.9, 10)):
        assert _itemsets(spark, sets, support, longest) == _brute_itemsets(sets, support, longest)


def test_wide_domain_with_long_baskets_equals_brute_force(spark):
    """2,000 items, 40 in a basket: enumerating subsets would be hopeless."""
    rng = random.Random(2)
    items = [f"i{n:04d}" for n in range(2000)]
    bundles = [rng.sample(items, 6) for _ in range(4)]
    sets = []
    for i in range(500):
        s = set(rng.sample(items, 34))
        if i % 3:
            s |= set(bundles[i % 4])
        sets.append(s | set(rng.sample(items, 40))if i == 7 else s)
    got = _itemsets(spark, sets, 0.03)
    assert got == _brute_itemsets(sets, 0.03)
    assert max(map(len, got)) == 6


def test_no_baskets_and_nothing_frequent(spark):
    assert _itemsets(spark, [], 0.1) == {}
    assert _itemsets(spark, [{"a"}, {"b"}, {"c"}], 0.9) == {}


def test_lift_identity(spark):
    from conftest import SF_SMALL
    from clientele.plans.catalog import _baskets
    rules = baskets.association_rules(_baskets(spark, SF_SMALL)).collect()
    assert rules
    for r in rules:
        assert abs(r["confidence"] - r["support"] / r["coverage"]) < 1e-12
        assert r["confidence"] >= 0.1
