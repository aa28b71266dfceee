"""Hand-built edge frames (FIXTURES.md §4) for the customer feature tables."""

import datetime as dt

from conftest import line

from clientele.operators import features


def by_customer(df):
    return {r["customer_id"]: r for r in df.collect()}


def test_lrfmpv_null_keys_and_all_null_revenue(spark, make_txn):
    rows = [
        line(customer_id=None, transaction_id=1, net=5),
        line(customer_id=None, transaction_id=None, net=5, category=None),
        line(customer_id=2, transaction_id=3, net=None, date="2024-01-05"),
        line(customer_id=2, transaction_id=4, net=None, date="2024-01-09"),
    ]
    out = by_customer(features.lrfmpv_base(make_txn(rows)))
    # a missing customer id is one group; a missing transaction id and a
    # missing category each count as one more distinct value
    assert out[None]["F"] == 2 and out[None]["V"] == 2
    # all-missing revenue sums to 0, not NULL
    assert out[2]["M"] == 0.0
    # analysis date = last approved date + 1 = 2024-01-10
    assert out[2]["R"] == 1 and out[2]["L"] == 4 and out[2]["P"] == 4.0


def test_lrfmpv_single_order_and_same_day_orders(spark, make_txn):
    rows = [
        line(customer_id=1, transaction_id=1, date="2024-03-01"),
        line(customer_id=1, transaction_id=1, date="2024-03-01", category="Tops"),
        line(customer_id=2, transaction_id=2, date="2024-03-02"),
        line(customer_id=2, transaction_id=3, date="2024-03-02"),
        line(customer_id=3, transaction_id=4, date="2024-03-02", status="Cancelled"),
    ]
    out = by_customer(features.lrfmpv_base(make_txn(rows)))
    assert out[1]["F"] == 1 and out[1]["P"] is None and out[1]["V"] == 2
    assert out[2]["F"] == 2 and out[2]["L"] == 0 and out[2]["P"] == 0.0
    assert 3 not in out  # no approved order


def test_analysis_date_parameter(spark, make_txn):
    rows = [line(customer_id=1, date="2024-05-31")]
    out = by_customer(features.lrfmpv_base(make_txn(rows), analysis_date="2024-06-30"))
    assert out[1]["R"] == 30


def test_customer_dm_measures(spark, make_txn):
    rows = [
        # Saturday, full price, fashion
        line(customer_id=1, transaction_id=1, date="2024-06-01", net=100, gross=120, refund=20,
             profit=30, quantity=4.0, returned=1.0, level=5, category="Dresses", brand="A"),
        # Monday, bargain, accessory
        line(customer_id=1, transaction_id=2, date="2024-06-03", net=50, gross=50, refund=0,
             profit=-10, quantity=1.0, returned=0.0, level=1, category="Bags", brand="B"),
        # zero quantity and zero revenue customer
        line(customer_id=2, transaction_id=3, date="2024-06-03", net=0, gross=0, refund=0,
             profit=0, quantity=0.0, returned=0.0, level=3, category="Toys", brand=None),
    ]
    out = by_customer(features.customer_dm(make_txn(rows)))
    c1, c2 = out[1], out[2]
    assert c1["F"] == 2 and c1["M"] == 150.0 and c1["profit"] == 20.0
    assert c1["R"] == 0 and c1["L"] == 2 and c1["V"] == 2 and c1["category_diversity"] == 2
    assert c1["brand_diversity"] == 2
    assert c1["weekend_ratio"] == 0.5 and c1["weekend_shopper"] == 0.0
    assert c1["return_ratio"] == 0.2
    assert abs(c1["refund_ratio"] - 20 / 170) < 1e-15
    assert abs(c1["profit_margin"] - 20 / 150) < 1e-15
    assert c1["top_category_ratio"] == 0.5
    assert c1["bargain_ratio"] == 0.5 and c1["premium_ratio"] == 0.5
    assert c1["cat_ratio_fashion"] == 0.5 and c1["cat_ratio_accessory"] == 0.5
    assert c1["cat_ratio_other"] == 0.0
    # guarded ratios give 0 on zero denominators; a missing brand is a value
    assert c2["return_ratio"] == 0.0 and c2["refund_ratio"] == 0.0 and c2["profit_margin"] == 0.0
    assert c2["brand_diversity"] == 1 and c2["cat_ratio_other"] == 1.0


def test_category_ratio_sums_to_one(spark):
    from conftest import SF_SMALL
    from clientele.plans.catalog import txn
    r = features.category_ratio(txn(spark, SF_SMALL, ["customer_id", "category"]))
    for row in r.collect():
        total = row["cat_ratio_fashion"] + row["cat_ratio_accessory"] + row["cat_ratio_other"]
        assert abs(total - 1.0) < 1e-12


def test_customer_base_nulls_and_recency(spark, make_txn):
    rows = [
        line(customer_id=1, transaction_id=1, date="2024-01-01", net=10, quantity=0.0),
        line(customer_id=2, transaction_id=2, date=None, net=10),
        line(customer_id=2, transaction_id=3, date="2024-01-11", net=30),
    ]
    out = by_customer(features.customer_base(make_txn(rows), as_of=dt.date(2024, 1, 31)))
    assert out[1]["recency"] == 30 and out[1]["return_rate"] is None
    assert out[2]["first_order"] is None and out[2]["last_order"] is None  # plain min/max
    assert out[2]["avg_order_value"] == 20.0


def test_distinct_masks_equal_plain_counts(spark, make_txn):
    from clientele.functions.nullsafe import n_distinct_na, with_distinct_mask
    # 130 brands need three words; customer 3 has none, customer 2 a missing one too
    rows = [line(customer_id=1, brand=f"B{i % 130}") for i in range(300)]
    rows += [line(customer_id=2, brand=b) for b in ("B1", "B129", None, "B1", "")]
    rows += [line(customer_id=3, brand=None)]
    t = make_txn(rows)
    plain = {r[0]: r[1] for r in t.groupBy("customer_id").agg(n_distinct_na("brand").alias("n")).collect()}
    assert plain == {1: 130, 2: 4, 3: 1}
    for limit in (1024, 130):  # the second falls back to the plain count
        marked, count = with_distinct_mask(t, "brand", limit)
        got = {r[0]: r[1] for r in marked.groupBy("customer_id").agg(count.alias("n")).collect()}
        assert got == plain
    for few, want in ((t.limit(0), []), (t.filter("brand is null"), [1, 1])):
        marked, count = with_distinct_mask(few, "brand")
        assert [r[1] for r in marked.groupBy("customer_id").agg(count.alias("n")).collect()] == want
