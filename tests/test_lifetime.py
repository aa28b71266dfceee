"""Fit to audience on simulated customers; saved models; likelihood keys."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from clientele.operators import btyd, lifetime


@pytest.fixture(scope="module")
def customers(spark):
    """LRFMPV rows of customers who buy, spend and drop out by known parameters."""
    rng = np.random.default_rng(8)
    n, r, alpha, a, b = 4000, 0.9, 40.0, 0.8, 2.5
    rate, p = rng.gamma(r, 1 / alpha, n), rng.beta(a, b, n)
    spend = rng.gamma(3.74, 1 / 15.44, n)  # the scale's rate
    rows = []
    for i in range(n):
        age, t, last, x = rng.uniform(200, 720), 0.0, 0.0, 0
        while True:
            t += rng.exponential(1 / rate[i])
            if t > age:
                break
            x, last = x + 1, t
            if rng.random() < p[i]:
                break
        mean = rng.gamma(6.25 * (x + 1), 1 / spend[i]) / (x + 1)
        L = int(round(last))
        rows.append((i, L, int(age) - L, x + 1, float(mean * (x + 1)), L / x if x else None, 1 + i % 4))
    return spark.createDataFrame(rows, "customer_id long, L int, R int, F long, M double, P double, V long").repartition(4)


def test_fit_to_audience_and_back_from_disk(spark, customers, scratch):
    model, scored, audience = lifetime.fit_to_audience(customers, path=f"file://{scratch}/model", max_p_alive=0.6, max_recency=400.0)
    bg, gg = (s.params_found for s in model.stages)
    assert 0.6 < bg.r < 1.3 and 25 < bg.alpha < 60 and 0.15 < bg.a / (bg.a + bg.b) < 0.35
    assert gg.p > 1 and gg.q > 1
    rows = {r["customer_id"]: r for r in scored.collect()}
    assert len(rows) == 4000 and all(0 < r["p_alive"] <= 1 for r in rows.values())
    picked = [r["customer_id"] for r in audience.collect()]
    assert len(picked) > 5
    cut = np.quantile([r["clv_30d"] for r in rows.values() if r["clv_30d"] is not None], 0.75)
    middle = np.quantile([r["M"] for r in rows.values()], 0.5)
    assert sorted(picked) == sorted(i for i, r in rows.items() if r["clv_30d"] is not None and r["clv_30d"] > cut
                                    and r["p_alive"] < 0.6 and r["recency_days"] < 400 and r["F"] >= 2 and r["M"] > middle)
    again = PipelineModel.load(f"file://{scratch}/model")
    assert again.stages[0].params_found == bg and again.stages[1].params_found == gg
    one, two = (lifetime.fitted_clv(customers, m).orderBy("customer_id").collect() for m in (model, again))
    assert one == two


def test_models_score_like_the_operators(spark, customers):
    bg, gg = lifetime.BGNBDModel(), lifetime.GammaGammaModel()
    bg._set(**btyd.CDNOW_BGNBD.__dict__)
    gg._set(**btyd.CDNOW_GAMMA_GAMMA.__dict__)
    got = lifetime.fitted_clv(customers, PipelineModel([bg, gg])).select("customer_id", "pred_30d", "p_alive", "clv_30d").collect()
    want = btyd.clv_from_lrfmpv(customers, btyd.CDNOW_BGNBD, btyd.CDNOW_GAMMA_GAMMA).select("customer_id", "pred_30d", "p_alive", "clv_30d").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
