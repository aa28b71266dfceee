"""BG/NBD and Gamma-Gamma: special functions, scoring identities and
parameter recovery on simulated customers."""

import math

import numpy as np
from pyspark.sql import functions as F

from clientele.functions.special import digamma, digamma_np, hyp2f1_numpy, lgamma, lgamma_np
from clientele.operators import btyd


def test_lgamma_and_digamma(spark):
    vals = [1e-6, 0.01, 0.5, 1.0, 2.5, 7.99, 13.7, 150.0, 9999.5]
    df = spark.createDataFrame([(v,) for v in vals], "z double")
    for r in df.select("z", lgamma(F.col("z")).alias("lg"), digamma(F.col("z")).alias("dg")).collect():
        assert abs(r.lg - math.lgamma(r.z)) < 1e-10 * max(1.0, abs(math.lgamma(r.z)))
        h = 1e-5 * r.z
        num = (math.lgamma(r.z + h) - math.lgamma(r.z - h)) / (2 * h)
        assert abs(r.dg - num) < 1e-4 * max(1.0, abs(num))
        # the numpy twins used inside the likelihood passes agree with the columns
        assert abs(r.dg - float(digamma_np(r.z))) < 1e-11 * max(1.0, abs(r.dg))
        assert abs(r.lg - float(lgamma_np(r.z))) < 1e-11 * max(1.0, abs(r.lg))


def test_hyp2f1_closed_forms():
    z = np.array([0.0, 0.1, 0.5, 0.9, 0.99])
    nz = z[1:]
    assert np.allclose(hyp2f1_numpy(1.0, 1.0, 2.0, nz), -np.log1p(-nz) / nz, rtol=1e-13)
    # 2F1(a, b; b; z) = (1 - z)^(-a)
    assert np.allclose(hyp2f1_numpy(2.5, 3.0, 3.0, z), (1 - z) ** -2.5, rtol=1e-12)


def test_p_alive_and_expectation_bounds(spark):
    rows = [(1, 0, 0.0, 30.0), (2, 3, 100.0, 200.0), (3, 10, 10.0, 400.0), (4, 1, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "customer_id long, x long, t_x double, t_cal double")
    out = {r["customer_id"]: r for r in btyd.bgnbd_score(df, btyd.CDNOW_BGNBD).collect()}
    assert out[1]["p_alive"] == 1.0
    for r in out.values():
        assert 0.0 < r["p_alive"] <= 1.0 and r["pred_30d"] > 0
    # a long silence after many purchases lowers P(alive)
    assert out[3]["p_alive"] < out[2]["p_alive"]


def simulate_bgnbd(n, r, alpha, a, b, seed=11):
    rng = np.random.default_rng(seed)
    lam = rng.gamma(r, 1 / alpha, n)
    p = rng.beta(a, b, n)
    horizon = rng.uniform(60, 365, n)
    out = []
    for i in range(n):
        t, x, tx = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / lam[i])
            if t > horizon[i]:
                break
            x, tx = x + 1, t
            if rng.random() < p[i]:
                break
        out.append((i, x, float(tx), float(horizon[i])))
    return out


def test_bgnbd_parameter_recovery(spark):
    truth = (0.5, 8.0, 0.8, 2.5)
    df = spark.createDataFrame(simulate_bgnbd(4000, *truth),
                               "customer_id long, x long, t_x double, t_cal double")
    est, ll, it, ok = btyd.fit_bgnbd(df)
    assert ok and math.isfinite(ll)
    for got, want in zip((est.r, est.alpha, est.a, est.b), truth):
        assert abs(got - want) / want < 0.25


def test_gamma_gamma_parameter_recovery(spark):
    rng = np.random.default_rng(5)
    n, p, q, g = 4000, 6.0, 4.0, 15.0
    nu = rng.gamma(q, 1 / g, n)
    xs = rng.integers(1, 10, n)
    m = [float(rng.gamma(p, 1 / nu[i], xs[i]).mean()) for i in range(n)]
    df = spark.createDataFrame([(i, int(xs[i]), m[i]) for i in range(n)],
                               "customer_id long, x long, m_x double")
    est, ll, it, ok = btyd.fit_gamma_gamma(df)
    assert ok
    # p and gamma trade off; the implied mean spend p*gamma/(q-1) is well identified
    assert abs(est.p * est.gamma / (est.q - 1) - p * g / (q - 1)) / (p * g / (q - 1)) < 0.1
    assert abs(est.q - q) / q < 0.3


def test_gg_expected_value_formula(spark):
    df = spark.createDataFrame([(1, 2, 50.0), (2, 5, -1.0)], "customer_id long, x long, m_x double")
    pr = btyd.GammaGammaParams(p=6.0, q=4.0, gamma=15.0)
    out = {r["customer_id"]: r["exp_avg_value"] for r in btyd.gg_score(df, pr).collect()}
    assert abs(out[1] - 6.0 * (15.0 + 100.0) / (12.0 + 3.0)) < 1e-12
    assert out[2] is None  # non-positive spend is outside the model


def test_fused_clv_projection_equals_joined_tables(spark):
    """The one-projection CLV table equals the three-way left join of the
    separately scored tables (and the churn input join)."""
    from conftest import SF_SMALL
    from clientele.operators import churn, features
    from clientele.plans.catalog import _LRFMPV_COLS, txn
    lr = features.lrfmpv_base(txn(spark, SF_SMALL, _LRFMPV_COLS))
    bg = btyd.bgnbd_score(btyd.bgnbd_inputs(lr), btyd.CDNOW_BGNBD)
    gg = btyd.gg_score(btyd.gg_inputs(lr), btyd.CDNOW_GAMMA_GAMMA)
    joined = churn.churn_input(btyd.clv_table(bg, gg, lr), lr)
    fused = btyd.clv_from_lrfmpv(lr, btyd.CDNOW_BGNBD, btyd.CDNOW_GAMMA_GAMMA,
                                 extra=("L", "R", "P", "V"))
    cols = sorted(joined.columns)
    assert cols == sorted(fused.columns)
    a, b = joined.select(*cols), fused.select(*cols)
    assert a.count() == b.count() == lr.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hyp2f1_near_one_and_with_large_parameters():
    """Closed forms to 1e-9 up to z = 1 - 1e-9, and sums of exact fractions."""
    from fractions import Fraction
    z = 1 - np.logspace(-0.1, -9, 60)
    assert np.allclose(hyp2f1_numpy(1.0, 1.0, 2.0, z), -np.log1p(-z) / z, rtol=1e-9)
    assert np.allclose(hyp2f1_numpy(2.5, 3.0, 3.0, z), (1 - z) ** -2.5, rtol=1e-6)
    assert np.allclose(hyp2f1_numpy(0.5, 1.0, 1.5, z), (np.log1p(np.sqrt(z)) - np.log1p(-z) / 2) / np.sqrt(z), rtol=1e-9)
    assert np.allclose(hyp2f1_numpy(0.5, 0.5, 1.5, z), (np.pi / 2 - np.arcsin(np.sqrt(1 - z))) / np.sqrt(z), rtol=1e-9)
    assert np.allclose(hyp2f1_numpy(1.0, 2.0, 4.0, -z), hyp2f1_numpy(2.0, 1.0, 4.0, -z), rtol=1e-12)
    assert np.allclose(hyp2f1_numpy(1.0, 1.0, 2.0, -z), np.log1p(z) / z, rtol=1e-12)

    def exact(a, b, c, x, terms):
        a, b, c, x = (Fraction(v) for v in (a, b, c, x))
        total, term = Fraction(1), Fraction(1)
        for j in range(terms):
            term = term * (a + j) * (b + j) / ((c + j) * (j + 1)) * x
            total += term
            if term < total / 10 ** 20:
                break
        return float(total)

    for a, b, c, x in ((0.25, 2.5, 3.25, 0.96875), (40.25, 42.5, 42.25, 0.75), (300.25, 302.5, 302.25, 0.5), (3.5, 2.25, 9.0, 0.875)):
        assert np.allclose(hyp2f1_numpy(a, b, c, x), exact(a, b, c, x, 6000), rtol=1e-11)
    # customers with thousands of purchases keep a value
    big = hyp2f1_numpy(5000.25, 5002.5, 5002.3, np.array([0.01, 0.05]))
    assert np.isfinite(big).all()


def test_functions_of_counts_are_looked_up():
    """Whole and other numbers alike; special functions see each value once."""
    import numpy as np
    from clientele.operators import btyd
    rng = np.random.default_rng(2)
    seen = []
    lgamma = btyd.lgamma_np
    x = rng.integers(0, 9, 5000).astype(float)
    t_x, t_cal, n = rng.integers(0, 700, 5000).astype(float), rng.integers(700, 900, 5000).astype(float), np.ones(5000)
    theta = np.log([0.4, 5.0, 0.8, 2.5])
    try:
        btyd.lgamma_np = lambda z: (seen.append(np.size(z)), lgamma(z))[1]
        whole, grad = btyd._bgnbd_ll_grad(theta, x, t_x, t_cal, n)
        btyd._gg_ll_grad(theta[:3], x + 1, t_cal)
    finally:
        btyd.lgamma_np = lgamma
    assert max(seen) <= 10
    rows = [btyd._bgnbd_ll_grad(theta, *[np.array([v]) for v in r]) for r in zip(x, t_x, t_cal, n)]
    assert abs(whole - sum(r[0] for r in rows)) < 1e-6 and np.allclose(grad, np.sum([r[1] for r in rows], axis=0))
    for values in (x, x + 0.5, -x, x * 1e6, np.array([])):
        table, index = btyd._each(values)
        assert (table[index] == values).all()


def test_a_full_step_that_does_needs_no_ladder():
    import numpy as np
    from clientele.operators import btyd
    asked = []

    def evaluate(points):
        asked.append(len(points))
        return [(float(((p - 1) ** 2).sum()), 2 * (p - 1)) for p in points]

    theta, _, _, ok = btyd._minimize(evaluate, [0.0, 0.5], upper=5.0)
    assert ok and np.allclose(theta, 1.0) and asked.count(1) > 1 and sum(asked) < 6 * len(asked)
