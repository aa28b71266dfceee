"""Fitted lifetime value: estimators that can be saved, and fit to audience.

``BGNBD`` and ``GammaGamma`` are Spark ML estimators over the LRFMPV table, so
they stand in a ``Pipeline``, whose fitted model is saved and loaded like any
other and adds pred_30d, p_alive and exp_avg_value to a table.  The fits are
those of ``operators/btyd.py``.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators import btyd, churn


class _Settings(Params):
    """Parameters of both estimators and models."""

    horizon = Param(Params._dummy(), "horizon", "days ahead that pred_30d counts", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most steps of the fit", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(horizon=30.0, maxIter=200)


class BGNBD(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fits r, alpha, a and b of the BG/NBD model to an LRFMPV table."""

    def _fit(self, dataset: DataFrame) -> BGNBDModel:
        found, *_ = btyd.fit_bgnbd(btyd.bgnbd_inputs(dataset), max_iter=self.getOrDefault("maxIter"))
        model = BGNBDModel()
        model._set(horizon=self.getOrDefault("horizon"), **found.__dict__)
        return model


class BGNBDModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Adds pred_30d and p_alive to a table with F, L and R."""

    r = Param(Params._dummy(), "r", "shape of the purchase rate", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "scale of the purchase rate", TypeConverters.toFloat)
    a = Param(Params._dummy(), "a", "first shape of the dropout", TypeConverters.toFloat)
    b = Param(Params._dummy(), "b", "second shape of the dropout", TypeConverters.toFloat)

    @property
    def params_found(self) -> btyd.BGNBDParams:
        return btyd.BGNBDParams(*(self.getOrDefault(n) for n in ("r", "alpha", "a", "b")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, t_x, t_cal = (F.col("F") - 1).cast("long"), F.col("L").cast("double"), (F.col("L") + F.col("R")).cast("double")
        found = self.params_found
        return (dataset.withColumn("pred_30d", btyd.expected_transactions_expr(found, self.getOrDefault("horizon"), x, t_x, t_cal))
                .withColumn("p_alive", btyd.p_alive_expr(found, x, t_x, t_cal)))


class GammaGamma(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fits p, q and gamma of the Gamma-Gamma spend model to an LRFMPV table."""

    def _fit(self, dataset: DataFrame) -> GammaGammaModel:
        found, *_ = btyd.fit_gamma_gamma(btyd.gg_inputs(dataset), max_iter=self.getOrDefault("maxIter"))
        model = GammaGammaModel()
        model._set(**found.__dict__)
        return model


class GammaGammaModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Adds exp_avg_value to a table with F and M; NULL for one-time buyers."""

    p = Param(Params._dummy(), "p", "shape of the spend", TypeConverters.toFloat)
    q = Param(Params._dummy(), "q", "shape of the spend's scale", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "scale of the spend's scale", TypeConverters.toFloat)

    @property
    def params_found(self) -> btyd.GammaGammaParams:
        return btyd.GammaGammaParams(*(self.getOrDefault(n) for n in ("p", "q", "gamma")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = (F.col("F") - 1).cast("long")
        value = btyd.gg_expected_value_expr(self.params_found, x, F.col("M") / F.col("F").cast("double"))
        return dataset.withColumn("exp_avg_value", F.when(x > 0, value))


def lifetime_pipeline(max_iter: int = 200, horizon: float = 30.0) -> Pipeline:
    bg, gg = BGNBD(), GammaGamma()
    bg._set(maxIter=max_iter, horizon=horizon)
    gg._set(maxIter=max_iter)
    return Pipeline(stages=[bg, gg])


def fitted_clv(lrfmpv: DataFrame, model: PipelineModel) -> DataFrame:
    """The CLV table of a fitted pipeline, with the rhythm columns the churn
    score needs."""
    x = model.transform(lrfmpv)
    return x.select("customer_id", "pred_30d", "p_alive", (F.col("L") + F.col("R")).cast("double").alias("t_cal"),
                    F.col("L").cast("double").alias("t_x"), "exp_avg_value", "F", "M", "L", "R", "P", "V",
                    (F.col("pred_30d") * F.col("exp_avg_value")).alias("clv_30d"),
                    F.col("R").cast("double").alias("recency_days"))


def fit_to_audience(lrfmpv: DataFrame, path: str | None = None, **thresholds) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit, score and select: the model (saved under ``path`` if given), the CLV
    table with its churn score, and the customers that ``thresholds`` select
    (those of ``btyd.target_customers``)."""
    model = lifetime_pipeline().fit(lrfmpv)
    if path is not None:
        model.write().overwrite().save(path)
    scored = churn.churn_risk(fitted_clv(lrfmpv, model))  # materialised by its ranks
    return model, scored, btyd.target_customers(scored, **thresholds)
