import datetime as dt

from conftest import line

from clientele.operators import churn, features


def test_category_decline_empty_period_and_month_end(spark, make_txn):
    rows = [
        # analysis date 2024-05-31 -> recent after 2024-02-29, previous after 2023-11-30
        line(customer_id=1, transaction_id=1, date="2024-05-31", net=50, category="Tops"),
        line(customer_id=1, transaction_id=2, date="2024-02-29", net=100, category="Tops"),
        line(customer_id=1, transaction_id=3, date="2023-11-30", net=999, category="Tops"),
        line(customer_id=1, transaction_id=4, date="2024-03-01", net=7, category="Bags"),
    ]
    dec = {r["category"]: r for r in churn.category_decline(make_txn(rows)).collect()}
    assert dec["Tops"]["recent_3m"] == 50.0 and dec["Tops"]["previous_3m"] == 100.0
    assert dec["Tops"]["category_decline_ratio"] == 0.5 and dec["Tops"]["category_decline_flag"] == 1
    # no previous-period rows: previous is 0 and the ratio divides by max(0, 1)
    assert dec["Bags"]["previous_3m"] == 0.0 and dec["Bags"]["category_decline_ratio"] == 7.0


def test_dominant_category_tie_goes_to_first_name(spark, make_txn):
    rows = [line(customer_id=1, transaction_id=1, net=10, category="Tops"),
            line(customer_id=1, transaction_id=2, net=10, category="Bags")]
    dep = churn.customer_category_dependency(make_txn(rows)).collect()[0]
    assert dep["dominant_category"] == "Bags" and dep["dominant_category_share"] == 0.5


def test_three_valued_flags(spark, make_txn):
    rows = [line(customer_id=1, transaction_id=1, date="2024-01-01", category="Tops"),
            line(customer_id=2, transaction_id=2, date="2024-12-31", category="Bags", net=0)]
    t = make_txn(rows)
    base = churn.customer_churn_base(features.lrfmpv_base(t), t)
    dep = churn.customer_category_dependency(t)
    dec = churn.category_decline(t)
    sig = {r["customer_id"]: r for r in churn.dependency_failure_signal(base, dep, dec).collect()}
    # customer 1 churned (365 days), fully dependent on Tops, Tops has no recent rows
    assert sig[1]["churn_flag"] == 1 and sig[1]["high_category_dependency"] == 1
    # ... but Tops sold nothing in the last six months, so its decline is unknown
    assert sig[1]["category_decline_flag"] is None
    assert sig[1]["possible_dependency_failure"] is None  # true AND true AND NULL
    # customer 2: zero revenue -> share NULL -> dependency flag NULL; not churned -> 0
    assert sig[2]["dominant_category_share"] is None
    assert sig[2]["high_category_dependency"] is None
    assert sig[2]["possible_dependency_failure"] == 0  # NULL AND false = false


def test_recent_returns_window_is_inclusive(spark, make_txn):
    rows = [
        line(customer_id=1, transaction_id=1, date="2024-07-01", quantity=2.0, returned=1.0),
        line(customer_id=1, transaction_id=2, date="2024-01-03", quantity=2.0, returned=2.0),
        line(customer_id=1, transaction_id=3, date="2024-01-02", quantity=5.0, returned=5.0),
        # cancelled lines count in the window
        line(customer_id=1, transaction_id=4, date="2024-06-01", quantity=1.0, returned=0.0,
             status="Cancelled"),
        # no approved order -> no last order -> no row
        line(customer_id=2, transaction_id=5, date="2024-06-01", status="Cancelled"),
    ]
    t = make_txn(rows)
    base = churn.customer_churn_base(features.lrfmpv_base(t), t)
    rec = {r["customer_id"]: r for r in churn.customer_recent_returns(t, base).collect()}
    assert set(rec) == {1}
    # 2024-07-01 minus 180 days = 2024-01-03 (inclusive); 2024-01-02 is outside
    assert rec[1]["recent_quantity"] == 5.0 and rec[1]["recent_returned_qty"] == 3.0
    assert rec[1]["recent_return_ratio"] == 0.6


def test_churn_score_single_order_is_healthy(spark):
    rows = [(1, 0.5, 0.9, 1, 100.0, 10, None), (2, 0.4, 0.3, 3, 5.0, 50, 10.0),
            (3, 0.1, 0.8, 2, 40.0, 30, 20.0)]
    df = spark.createDataFrame(rows, "customer_id long, pred_30d double, p_alive double, "
                                     "F long, R double, L long, P double")
    out = {r["customer_id"]: r for r in churn.churn_risk(df).collect()}
    assert out[1]["recency_ratio"] is None and out[1]["churn_score"] is None
    assert out[1]["churn_segment"] == "Healthy"
    assert out[1]["churn_action"] == "Maintain / loyalty nurturing"
    # frequency risk = 1 - percent_rank(F) over all three rows
    assert out[2]["frequency_risk"] == 0.0 and out[1]["frequency_risk"] == 1.0
    assert 0.0 <= out[3]["churn_score"] <= 1.0


def test_plain_customer_join_only_when_keys_are_present(spark, make_txn):
    """Both join modes agree on data without NULL ids; the catalogue picks the
    plain join only after checking the staged table."""
    from conftest import SF_SMALL
    from clientele.plans.catalog import null_customer_keys, txn
    assert null_customer_keys(spark, SF_SMALL) is False
    t = txn(spark, SF_SMALL)
    base = churn.customer_churn_base(features.lrfmpv_base(t), t)
    a = churn.operational_friction_signal(base, churn.customer_recent_returns(t, base))
    b = churn.operational_friction_signal(
        base, churn.customer_recent_returns(t, base, null_keys=False), null_keys=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # with a NULL customer id the null-safe default still matches NULL to NULL
    rows = [line(customer_id=None, transaction_id=1, quantity=2.0, returned=1.0)]
    tn = make_txn(rows)
    bn = churn.customer_churn_base(features.lrfmpv_base(tn), tn)
    sig = churn.operational_friction_signal(bn, churn.customer_recent_returns(tn, bn)).first()
    assert sig["customer_id"] is None and sig["recent_return_ratio"] == 0.5
