"""Buy-till-you-die models: BG/NBD (transactions, P(alive)) and Gamma-Gamma
(spend), and the 30-day customer lifetime value built from them.

Formulas from Fader, Hardie & Lee (2005) "Counting your customers the easy
way" and Fader & Hardie (2013) "The Gamma-Gamma model of monetary value".

Scoring is one projection per customer (native expressions; the Gauss
hypergeometric series is an Arrow-batched pandas UDF).  Fitting maximises
the log-likelihood with a BFGS loop on the driver in which every step is a
single pass over the (checkpointed) customer table: each partition computes
the log-likelihood and its analytic gradient (numpy on Arrow batches) for the
full step, or, where that fails, for a whole ladder of shorter ones, and a Spark
aggregation adds the partial sums.  Only the parameter vectors and a handful of sums cross the driver
boundary, as in Spark ML's own iterative estimators.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.ranking import exact_quantiles
from clientele.functions.special import digamma_np, hyp2f1, lgamma_np
from clientele.session import cut_lineage


@dataclass(frozen=True)
class BGNBDParams:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GammaGammaParams:
    p: float
    q: float
    gamma: float


# fixed values: published CDNOW estimates, used as fixed scoring parameters so
# that scores are reproducible in the SQL oracle (the fit is tested separately)
CDNOW_BGNBD = BGNBDParams(r=0.243, alpha=4.414, a=0.793, b=2.426)
CDNOW_GAMMA_GAMMA = GammaGammaParams(p=6.25, q=3.74, gamma=15.44)
# start values and the upper bound of every parameter used by the fits
BGNBD_START = (1.0, 3.0, 1.0, 3.0)
GG_START = (1.0, 1.0, 1.0)
MAX_PARAM = 10000.0


# --- B1 / B6: model inputs ---------------------------------------------------------------

def bgnbd_inputs(lrfmpv: DataFrame) -> DataFrame:
    """x = repeat purchases (F-1), t_x = first-to-last days (L),
    t_cal = first order to the analysis date (L + R)."""
    return lrfmpv.select(
        "customer_id",
        (F.col("F") - 1).cast("long").alias("x"),
        F.col("L").cast("double").alias("t_x"),
        (F.col("L") + F.col("R")).cast("double").alias("t_cal"))


def gg_inputs(lrfmpv: DataFrame) -> DataFrame:
    """x = repeat purchases, m_x = average value per transaction; x > 0 only."""
    return lrfmpv.select(
        "customer_id",
        (F.col("F") - 1).cast("long").alias("x"),
        (F.col("M") / F.col("F").cast("double")).alias("m_x")).filter(F.col("x") > 0)


# --- B3 / B4: BG/NBD scoring ---------------------------------------------------------------

_NEAR_ONE = 1e-4


def p_alive_expr(pr: BGNBDParams, x: Column, t_x: Column, t_cal: Column) -> Column:
    """P(alive | x, t_x, T); 1 for customers without a repeat purchase."""
    xd = x.cast("double")
    odds = (F.lit(pr.a) / (xd + (pr.b - 1.0))) * F.pow(
        (t_cal + pr.alpha) / (t_x + pr.alpha), xd + pr.r)
    return F.when(x > 0, 1.0 / (odds + 1.0)).otherwise(F.lit(1.0))


def expected_transactions_expr(pr: BGNBDParams, t: float, x: Column, t_x: Column,
                               t_cal: Column) -> Column:
    """E[Y(t) | x, t_x, T]: expected transactions in the next ``t`` periods."""
    xd = x.cast("double")
    shape = xd + pr.r
    z = F.lit(float(t)) / (t_cal + (pr.alpha + t))

    def for_living(a: float) -> Column:
        c = xd + (a + pr.b - 1.0)
        tail = 1.0 - F.pow((t_cal + pr.alpha) / (t_cal + (pr.alpha + t)), shape) * hyp2f1(
            shape, xd + pr.b, c, z)
        return c / (a - 1.0) * tail

    if abs(pr.a - 1.0) < _NEAR_ONE:
        # a = 1 is a removable singularity: interpolate across it
        low, high = for_living(1.0 - _NEAR_ONE), for_living(1.0 + _NEAR_ONE)
        living = low + (high - low) * ((pr.a - 1.0 + _NEAR_ONE) / (2 * _NEAR_ONE))
    else:
        living = for_living(pr.a)
    return living * p_alive_expr(pr, x, t_x, t_cal)


def bgnbd_score(inputs: DataFrame, params: BGNBDParams, t_star: float = 30.0) -> DataFrame:
    """customer_id, x, t_x, t_cal, pred_30d, p_alive."""
    x, tx, tc = F.col("x"), F.col("t_x"), F.col("t_cal")
    return inputs.select(
        "customer_id", "x", "t_x", "t_cal",
        expected_transactions_expr(params, t_star, x, tx, tc).alias("pred_30d"),
        p_alive_expr(params, x, tx, tc).alias("p_alive"))


def bgnbd_averages(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg("pred_30d").alias("avg_pred"), F.avg("p_alive").alias("avg_alive"))


# --- B8: Gamma-Gamma scoring -----------------------------------------------------------------

def gg_expected_value_expr(pr: GammaGammaParams, x: Column, m_x: Column) -> Column:
    """E[M | p, q, gamma, m_x, x] = p (gamma + m_x x) / (p x + q - 1)."""
    xd = x.cast("double")
    ev = ((m_x * xd + pr.gamma) * pr.p) / (xd * pr.p + (pr.q - 1.0))
    # non-positive average spend is outside the model: no expected value
    return F.when(m_x > 0, ev)


def gg_score(inputs: DataFrame, params: GammaGammaParams) -> DataFrame:
    return inputs.select("customer_id", "x", "m_x",
                         gg_expected_value_expr(params, F.col("x"), F.col("m_x"))
                         .alias("exp_avg_value"))


# --- B9 / B10 / T4: CLV --------------------------------------------------------------------

def clv_table(bg_scored: DataFrame, gg_scored: DataFrame, lrfmpv: DataFrame) -> DataFrame:
    """pred_30d, p_alive, t_cal, t_x, exp_avg_value, F, M, clv_30d, recency_days.

    Three 1:1 left joins on customer_id (all three inputs are aggregates keyed
    by customer_id, so Catalyst co-partitions them)."""
    from clientele.functions.nullsafe import left_join_na
    x = bg_scored.select("customer_id", "pred_30d", "p_alive", "t_cal", "t_x")
    x = left_join_na(x, gg_scored.select("customer_id", "exp_avg_value"), ["customer_id"])
    x = left_join_na(x, lrfmpv.select("customer_id", "F", "M"), ["customer_id"])
    return (x.withColumn("clv_30d", F.col("pred_30d") * F.col("exp_avg_value"))
            .withColumn("recency_days", F.col("t_cal") - F.col("t_x")))


def clv_from_lrfmpv(lrfmpv: DataFrame, bg: BGNBDParams, gg: GammaGammaParams,
                    t_star: float = 30.0, extra: tuple[str, ...] = ()) -> DataFrame:
    """The CLV table as ONE projection of the LRFMPV table.

    The BG/NBD inputs, the spend inputs and F, M are all per-customer columns
    of the same table, so the three 1:1 left joins of ``clv_table`` collapse
    into a projection: no join, no shuffle, the customer aggregate is
    computed once.  ``extra`` carries further LRFMPV columns along (the churn
    score needs L, R, P, V).
    """
    x = (F.col("F") - 1).cast("long")
    t_x = F.col("L").cast("double")
    t_cal = (F.col("L") + F.col("R")).cast("double")
    m_x = F.col("M") / F.col("F").cast("double")
    staged = lrfmpv.select("customer_id", "F", "M", *extra, x.alias("_x"), t_x.alias("t_x"),
                           t_cal.alias("t_cal"), m_x.alias("_m"))
    xc, txc, tcc = F.col("_x"), F.col("t_x"), F.col("t_cal")
    pred = expected_transactions_expr(bg, t_star, xc, txc, tcc)
    spend = F.when(xc > 0, gg_expected_value_expr(gg, xc, F.col("_m")))
    out = staged.select("customer_id", pred.alias("pred_30d"),
                        p_alive_expr(bg, xc, txc, tcc).alias("p_alive"),
                        "t_cal", "t_x", spend.alias("exp_avg_value"), "F", "M", *extra)
    return (out.withColumn("clv_30d", F.col("pred_30d") * F.col("exp_avg_value"))
            .withColumn("recency_days", F.col("t_cal") - F.col("t_x")))


def target_customers(clv: DataFrame, clv_quantile: float = 0.75, max_p_alive: float = 0.6,
                     max_recency: float = 180.0, min_frequency: int = 2) -> DataFrame:
    """High-value customers at risk: CLV above its ``clv_quantile`` quantile,
    P(alive) below ``max_p_alive``, recent, repeat buyers, spend above the
    median.  Thresholds are computed over the whole table first (exact,
    distributed quantiles) and applied as scalar subqueries."""
    clv = cut_lineage(clv)  # read for both thresholds and the selection
    clv_cut = exact_quantiles(clv, "clv_30d", {"q": clv_quantile}).select("q").scalar()
    m_cut = exact_quantiles(clv, "M", {"q": 0.5}).select("q").scalar()
    return clv.filter((F.col("clv_30d") > clv_cut) & (F.col("p_alive") < max_p_alive)
                      & (F.col("recency_days") < max_recency)
                      & (F.col("F") >= min_frequency) & (F.col("M") > m_cut))


def clv_top(clv: DataFrame, n: int = 10) -> DataFrame:
    return clv.orderBy(F.col("clv_30d").desc_nulls_last(),
                       F.col("customer_id").asc_nulls_last()).limit(n)


# --- B2 / B7: maximum-likelihood fits ---------------------------------------------------------

def _each(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(table, index): table[index] are the values, of which the table has few.

    Counts and days are whole numbers with many rows each, so a function of them
    is computed once a number of the table and looked up by row."""
    if len(values) and values.min() >= 0 and values.max() <= len(values):
        index = values.astype(np.int64)
        if (index == values).all():
            return np.arange(index.max() + 1, dtype=float), index
    return np.unique(values, return_inverse=True)


def _bgnbd_ll_grad(theta: np.ndarray, x, t_x, t_cal, n):
    """Weighted log-likelihood and gradient (w.r.t. log-parameters) of the
    BG/NBD model on numpy arrays of one partition."""
    r, alpha, a, b = np.exp(theta)
    pos = x > 0
    (xs, of_x), (txs, of_tx), (tcs, of_tc) = _each(x), _each(t_x), _each(t_cal)
    log_tx, log_tc = np.log(txs + alpha)[of_tx], np.log(tcs + alpha)[of_tc]
    g = lgamma_np(xs + r) - lgamma_np(r)
    h = lgamma_np(xs + b) - lgamma_np(b) + lgamma_np(a + b) - lgamma_np(xs + a + b)
    bx1 = np.where(xs > 0, xs + b - 1.0, 1.0)
    la = (g + h + r * np.log(alpha))[of_x] - (x + r) * log_tc
    lb = np.where(pos, (g + h + np.log(a) - np.log(bx1) + r * np.log(alpha))[of_x]
                  - (x + r) * log_tx, -np.inf)
    ll = np.logaddexp(la, lb)
    wa, wb = np.exp(la - ll), np.exp(lb - ll)
    dh_a = digamma_np(a + b) - digamma_np(xs + a + b)
    d_r = ((digamma_np(xs + r) - digamma_np(r) + np.log(alpha))[of_x] - wa * log_tc
           - wb * log_tx)
    d_alpha = r / alpha - wa * (x + r) / (t_cal + alpha) - wb * (x + r) / (t_x + alpha)
    d_a = dh_a[of_x] + wb / a
    d_b = (digamma_np(xs + b) - digamma_np(b) + dh_a)[of_x] - np.where(pos, wb / bx1[of_x], 0.0)
    grads = [d_r * r, d_alpha * alpha, d_a * a, d_b * b]
    return float((n * ll).sum()), [float((n * gr).sum()) for gr in grads]


def _gg_ll_grad(theta: np.ndarray, x, m):
    """Gamma-Gamma spend log-likelihood and gradient (log-parameters)."""
    p, q, g = np.exp(theta)
    xs, of_x = _each(x)
    pxs, px = p * xs, p * x
    lgm, lm, lx = np.log(m * x + g), np.log(m), np.log(xs)[of_x]
    ll = ((lgamma_np(pxs + q) - lgamma_np(pxs) - lgamma_np(q) + q * np.log(g))[of_x]
          + (px - 1) * lm + px * lx - (px + q) * lgm)
    dg_pxq = digamma_np(pxs + q)
    d_p = x * ((dg_pxq - digamma_np(pxs))[of_x] + lm + lx - lgm)
    d_q = (dg_pxq - digamma_np(q))[of_x] + np.log(g) - lgm
    d_g = q / g - (px + q) / (m * x + g)
    return float(ll.sum()), [float((d * s_).sum()) for d, s_ in ((d_p, p), (d_q, q), (d_g, g))]


def _evaluator(data: DataFrame, cols: list[str], ll_grad, dim: int):
    """Evaluate log-likelihood and gradient at a batch of parameter points
    in ONE pass: every partition computes its partial sums for all points
    (numpy, Arrow batches) and a Spark aggregation adds them up by point.
    Returns ``[(negative ll, negative gradient), ...]`` for minimisation."""
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("f", T.DoubleType())]
                          + [T.StructField(f"g{j}", T.DoubleType()) for j in range(dim)])

    def evaluate(points: list[np.ndarray]):
        pts = [np.asarray(pt, dtype=float) for pt in points]

        def partials(batches):
            f = np.zeros(len(pts))
            gsum = np.zeros((len(pts), dim))
            with np.errstate(all="ignore"):
                for pdf in batches:
                    arrays = [pdf[c].to_numpy(dtype=float) for c in cols]
                    for k, th in enumerate(pts):
                        fk, gk = ll_grad(th, *arrays)
                        f[k] += fk
                        gsum[k] += gk
            out = pd.DataFrame({"k": np.arange(len(pts), dtype="int32"), "f": f})
            for j in range(dim):
                out[f"g{j}"] = gsum[:, j]
            yield out

        part = data.mapInPandas(partials, schema)
        pdf = part.groupBy("k").agg(
            F.sum("f").alias("f"), *[F.sum(f"g{j}").alias(f"g{j}") for j in range(dim)]
        ).toPandas().set_index("k")
        out = []
        for k in range(len(pts)):
            f = float(pdf.loc[k, "f"])
            gvec = np.array([pdf.loc[k, f"g{j}"] for j in range(dim)], dtype=float)
            ok = np.isfinite(f) and np.all(np.isfinite(gvec))
            out.append((-f if ok else math.inf, -gvec))
        return out
    return evaluate


_STEPS = (1.0, 0.3, 0.1, 0.03, 0.01, 0.001)
_MAX_STEP = 2.0  # largest move of any log-parameter in one iteration


def _minimize(evaluate, theta0, upper: float, lower: float = -30.0, max_iter: int = 200,
              ftol: float = 1e-11, gtol: float = 1e-5):
    """Box-constrained BFGS in log-parameter space with a backtracking line
    search.  ``evaluate(points)`` returns ``[(f, grad), ...]``; each call is
    one Spark job.  Returns (theta, f, iterations, converged)."""
    theta = np.clip(np.asarray(theta0, dtype=float), lower, upper)
    (f, g), = evaluate([theta])
    n = theta.size
    hinv = np.eye(n)
    it, converged = 0, False
    for it in range(1, max_iter + 1):
        free = ~(((theta <= lower) & (g > 0)) | ((theta >= upper) & (g < 0)))
        pg = np.where(free, g, 0.0)
        if np.max(np.abs(pg)) <= gtol * max(1.0, abs(f)) * 1e-3:
            converged = True
            break
        d = -hinv @ pg
        d[~free] = 0.0
        if not np.all(np.isfinite(d)) or pg @ d >= 0:
            hinv = np.eye(n)
            d = -pg
        longest = np.max(np.abs(d))
        if longest > _MAX_STEP:
            d = d * (_MAX_STEP / longest)
        best = None
        cands = [np.clip(theta + step * d, lower, upper) for step in _STEPS]
        for some in (cands[:1], cands[1:]):  # the full step mostly does; else the rest of the ladder in one pass
            for cand, (fc, gc) in zip(some, evaluate(some)):
                if np.isfinite(fc) and np.all(np.isfinite(gc)) and \
                        fc <= f + 1e-4 * (pg @ (cand - theta)):
                    best = (cand, fc, gc)
                    break
            if best is not None:
                break
        if best is None:
            if np.allclose(hinv, np.eye(n)):
                break  # no descent even along the gradient
            hinv = np.eye(n)
            continue
        cand, fc, gc = best
        s, y = cand - theta, gc - g
        f_old = f
        theta, f, g = cand, fc, gc
        sy = s @ y
        if sy > 1e-12 * max(1.0, np.linalg.norm(s) * np.linalg.norm(y)):
            rho = 1.0 / sy
            eye = np.eye(n)
            if it == 1:
                hinv = eye * (sy / (y @ y))
            hinv = (eye - rho * np.outer(s, y)) @ hinv @ (eye - rho * np.outer(y, s)) \
                + rho * np.outer(s, s)
        if abs(f_old - f) <= ftol * max(1.0, abs(f)) and np.max(np.abs(s)) < 1e-6:
            converged = True
            break
    return theta, f, it, converged


def _fit(data: DataFrame, cols, ll_grad, start, names, max_iter):
    data = data.persist()  # read once per optimiser step
    try:
        theta, f, it, ok = _minimize(_evaluator(data, cols, ll_grad, len(names)), np.log(start),
                                     upper=math.log(MAX_PARAM), max_iter=max_iter)
    finally:
        data.unpersist()
    params = [float(math.exp(v)) for v in theta]
    return dict(zip(names, params)), -f, it, ok


def fit_bgnbd(inputs: DataFrame, start=BGNBD_START, max_iter: int = 200):
    """Maximum-likelihood (r, alpha, a, b).  Customers sharing (x, t_x, t_cal)
    are collapsed first, the result is checkpointed, and each optimiser step
    is one aggregation over it."""
    data = inputs.groupBy("x", "t_x", "t_cal").agg(F.count(F.lit(1)).cast("double").alias("n"))
    data = cut_lineage(data.filter(F.col("x").isNotNull() & F.col("t_x").isNotNull()
                                   & F.col("t_cal").isNotNull()))
    est, ll, it, ok = _fit(data, ["x", "t_x", "t_cal", "n"], _bgnbd_ll_grad, start,
                           ["r", "alpha", "a", "b"], max_iter)
    return BGNBDParams(**est), ll, it, ok


def fit_gamma_gamma(inputs: DataFrame, start=GG_START, max_iter: int = 200):
    """Maximum-likelihood (p, q, gamma) over customers with x > 0 and m_x > 0."""
    data = cut_lineage(inputs.select("x", "m_x").filter((F.col("x") > 0) & (F.col("m_x") > 0)))
    est, ll, it, ok = _fit(data, ["x", "m_x"], _gg_ll_grad, start, ["p", "q", "gamma"], max_iter)
    return GammaGammaParams(**est), ll, it, ok


def log_likelihood(data: DataFrame, params: BGNBDParams | GammaGammaParams) -> DataFrame:
    """customers, log_likelihood of model inputs at given parameters, by the
    likelihood that the fits maximise."""
    if isinstance(params, BGNBDParams):
        rows = data.groupBy("x", "t_x", "t_cal").agg(F.count(F.lit(1)).cast("double").alias("n"))
        rows = rows.dropna()
        cols, ll_grad = ["x", "t_x", "t_cal", "n"], _bgnbd_ll_grad
    else:
        rows = data.select("x", "m_x", F.lit(1.0).alias("n")).filter((F.col("x") > 0) & (F.col("m_x") > 0))
        cols, ll_grad = ["x", "m_x"], _gg_ll_grad
    theta = np.log(list(params.__dict__.values()))

    def partials(batches):
        for pdf in batches:
            with np.errstate(all="ignore"):
                value, _ = ll_grad(theta, *[pdf[c].to_numpy(dtype=float) for c in cols])
            yield pd.DataFrame({"n": [pdf["n"].sum()], "ll": [value]})

    return rows.mapInPandas(partials, "n double, ll double").agg(
        F.coalesce(F.sum("n"), F.lit(0.0)).cast("long").alias("customers"), F.sum("ll").alias("log_likelihood"))


def fit_result_frame(spark, params, ll: float, iterations: int, converged: bool) -> DataFrame:
    """One-row report of a fit (parameters, log-likelihood, iterations)."""
    row = {**params.__dict__, "log_likelihood": float(ll), "iterations": int(iterations),
           "converged": bool(converged)}
    return spark.createDataFrame([row])
