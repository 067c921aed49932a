"""Daily demand forecasting (ML4–ML6, A14, J3).

An additive model in the spirit of the published decomposable forecaster
(Taylor & Letham, "Forecasting at Scale"): piecewise-linear trend with hinge
changepoints under a Laplace prior, yearly and weekly Fourier seasonality and optional
holiday indicators under Gaussian ones, fitted as a MAP estimate. The interval adds
the noise to the trend's uncertainty: future changepoints drawn at the rate and size of the past ones,
so it widens with the horizon; draws are seeded by the series.

One grouped-map task per series builds the regressors and solves the small
normal equations with NumPy, for every design (with and without holidays) from one Gram matrix; day, value and holiday flags are all that travels.
A group is one daily series, so its size is bounded by the number of days (not
by trips), and series fan out across executors: by type, or by type and zone.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.numeric import round_half_up
from ..session import checkpoint_root
from . import dims

N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_ORDER = 10
WEEKLY_ORDER = 3
YEAR_DAYS = 365.25
# Prior scales on scaled y: Gaussian for trend, seasonality and holidays, Laplace for changepoints.
PRIOR_TREND = 5.0
PRIOR_CHANGEPOINT = 0.05
PRIOR_SEASONALITY = 10.0
PRIOR_HOLIDAY = 10.0
Z_95 = 1.959963984540054
SIMULATIONS = 1000          # draws of the future trend per series
# Fixed value: the floor of |y| in the percentage error (float64 machine epsilon).
MAPE_EPS = 2.220446049250313e-16


def holiday_flags(day: str = "fecha") -> dict[str, Column]:
    """0/1 column per holiday name: the day equals that holiday in its own year."""
    d = F.col(day)
    y = F.year(d)
    flags = {}
    i = 0
    for name, m, dd in dims.FIXED_DATE_HOLIDAYS:
        actual = F.make_date(y, F.lit(m), F.lit(dd))
        obs = dims._observed(actual)
        flags[f"h{i}"] = (d == actual).cast("double")
        # Observed day of a holiday falling on a weekend (may cross a year end).
        nxt = F.make_date(y + 1, F.lit(m), F.lit(dd))
        flags[f"h{i + 1}"] = (((obs != actual) & (d == obs))
                              | ((dims._observed(nxt) != nxt) & (d == dims._observed(nxt)))).cast("double")
        i += 2
    for name, m, dow, n in dims.NTH_WEEKDAY_HOLIDAYS:
        flags[f"h{i}"] = (d == dims._nth_weekday(y, m, dow, n)).cast("double")
        i += 1
    for name, m, last, dow in dims.LAST_WEEKDAY_HOLIDAYS:
        flags[f"h{i}"] = (d == dims._last_weekday(y, m, last, dow)).cast("double")
        i += 1
    return flags


def _regressors(t: np.ndarray, days: np.ndarray, yearly: bool) -> tuple[np.ndarray, np.ndarray]:
    """Trend, changepoint and seasonal columns over scaled time and epoch days, and their prior scales."""
    cols, prior = [t], [PRIOR_TREND]
    for j in range(1, N_CHANGEPOINTS + 1):
        cols.append(np.maximum(t - CHANGEPOINT_RANGE * j / N_CHANGEPOINTS, 0.0))
        prior.append(PRIOR_CHANGEPOINT)
    for order, period in ((YEARLY_ORDER if yearly else 0, YEAR_DAYS), (WEEKLY_ORDER, 7.0)):
        for k in range(1, order + 1):
            arg = days * (2.0 * math.pi * k / period)
            cols += [np.sin(arg), np.cos(arg)]
            prior += [PRIOR_SEASONALITY] * 2
    return np.column_stack(cols), np.array(prior)


OK = "ok"
NO_TRAINING = "sin_entrenamiento"


def lasso(S: np.ndarray, r: np.ndarray, penalty: float, start: np.ndarray) -> np.ndarray:
    """The ``d`` of least ``d'Sd / 2 - r'd + penalty |d|``: coordinate sweeps until the signs are found, then exactly."""
    d = start.copy()
    for _ in range(1000):
        before = d.copy()
        for j in range(len(d)):
            rest = r[j] - S[j] @ d + S[j, j] * d[j]
            d[j] = math.copysign(max(abs(rest) - penalty, 0.0), rest) / S[j, j]
        on = np.flatnonzero(d)
        exact = np.zeros_like(d)
        exact[on] = np.linalg.solve(S[np.ix_(on, on)], r[on] - penalty * np.sign(d[on]))
        if (np.sign(exact) == np.sign(d)).all() and (np.abs(r - S @ exact) <= penalty * (1 + 1e-9) + 1e-12).all():
            return exact
        if np.abs(d - before).max(initial=0.0) < 1e-14:
            break
    return d


def map_estimate(G: np.ndarray, b: np.ndarray, yy: float, n: int, prior: np.ndarray, laplace: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and noise variance of a linear model from its Gram matrix ``X'X``, ``X'y`` and ``y'y``.

    ``prior``: the scale of each coefficient (infinite for none), Laplace where ``laplace``, else Gaussian.
    The Gaussian block is eliminated, which leaves a lasso over the Laplace one; the noise
    variance is that of the residuals, found by alternation.
    """
    g, l = np.flatnonzero(~laplace), np.flatnonzero(laplace)
    beta, sigma2 = np.zeros(len(b)), 0.01
    for _ in range(100):
        A = G[np.ix_(g, g)] + np.diag(sigma2 / prior[g] ** 2 + 1e-9)
        solved = np.linalg.solve(A, np.column_stack([G[np.ix_(g, l)], b[g]]))
        S = G[np.ix_(l, l)] - G[np.ix_(l, g)] @ solved[:, :-1] + 1e-9 * np.eye(len(l))
        beta[l] = lasso(S, b[l] - G[np.ix_(l, g)] @ solved[:, -1], sigma2 / PRIOR_CHANGEPOINT, beta[l])
        beta[g] = solved[:, -1] - solved[:, :-1] @ beta[l]
        before, sigma2 = sigma2, max((yy - 2 * beta @ b + beta @ G @ beta) / n, 1e-8)
        if abs(sigma2 - before) <= 1e-9 * before:
            break
    return beta, sigma2


def trend_draws(t: np.ndarray, deltas: np.ndarray, seed: int, draws: int = SIMULATIONS) -> np.ndarray:
    """Deviations of the trend at future times ``t`` > 1: changepoints at the past rate, changes of the past mean size.

    Half of the draws mirror the other half, so that the middle of them is the prediction.
    """
    rng = np.random.default_rng(seed)
    size, span = float(np.abs(deltas).mean()) if len(deltas) else 0.0, float(t.max()) - 1.0
    out = np.zeros((draws // 2, len(t)))
    if size > 0 and span > 0:
        for i, n in enumerate(rng.poisson(N_CHANGEPOINTS / CHANGEPOINT_RANGE * span, len(out)).tolist()):
            at, change = 1.0 + span * rng.random(n), rng.laplace(0.0, size, n)
            out[i] = np.maximum(t[:, None] - at[None, :], 0.0) @ change
    return np.concatenate([out, -out])


OK = "ok"
NO_TRAINING = "sin_entrenamiento"
WITH_HOLIDAYS, WITHOUT_HOLIDAYS = "con_feriados", "sin_feriados"


def _fit_group(keys: list[str], yearly: bool, models: tuple[str, ...]):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fecha", ignore_index=True)
        base = pdf[[*keys, "fecha", "y"]].assign(es_prediccion=pdf["es_futuro"].astype(bool), estado=OK)
        train = pdf["es_train"].to_numpy(dtype=bool)
        if not train.any():
            empty = base.assign(prediccion=np.nan, prediccion_min=np.nan, prediccion_max=np.nan, estado=NO_TRAINING)
            return pd.concat([empty.assign(modelo=m) for m in models], ignore_index=True)
        days = (pd.to_datetime(pdf["fecha"]) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(dtype=float)
        first, last = days[train].min(), days[train].max()
        t = (days - first) / max(last - first, 1.0)
        X, prior = _regressors(t, days, yearly)
        flags = np.stack(pdf["flags"].to_numpy()).astype(float)
        X = np.column_stack([np.ones(len(pdf)), X, flags])
        prior = np.concatenate([[np.inf], prior, np.full(flags.shape[1], PRIOR_HOLIDAY)])
        laplace = np.zeros(len(prior), bool)
        laplace[2:2 + N_CHANGEPOINTS] = True
        Xt, yt = X[train], pdf["y"].to_numpy(dtype=float)[train]
        scale = float(np.max(np.abs(yt))) or 1.0
        ys = yt / scale
        G, b, yy = Xt.T @ Xt, Xt.T @ ys, float(ys @ ys)
        seed = zlib.crc32(repr([str(pdf[k].iloc[0]) for k in keys]).encode())
        ahead, out = np.flatnonzero(days > last), []
        for model in models:
            p = len(prior) if model == WITH_HOLIDAYS else len(prior) - flags.shape[1]  # holidays are the last block
            beta, sigma2 = map_estimate(G[:p, :p], b[:p], yy, len(ys), prior[:p], laplace[:p])
            yhat, sigma = X[:, :p] @ beta, math.sqrt(sigma2)
            low, high = yhat - Z_95 * sigma, yhat + Z_95 * sigma
            if len(ahead):
                drawn = trend_draws(t[ahead], beta[laplace[:p]], seed)
                noise = np.random.default_rng(seed + 1).normal(0.0, sigma, (len(drawn) // 2, len(ahead)))
                low[ahead], high[ahead] = yhat[ahead] + np.quantile(drawn + np.concatenate([noise, -noise]), [0.025, 0.975], axis=0)
            out.append(base.assign(prediccion=yhat * scale, prediccion_min=low * scale, prediccion_max=high * scale, modelo=model))
        return pd.concat(out, ignore_index=True)
    return fit


def materialize_series(df: DataFrame) -> DataFrame:
    """Checkpoint a per-series day table into the shared checkpoint folder.

    Such a table is small (days × series) but is an aggregate over the whole
    source; the fit reads it several times (bounds, last day, rows, train and
    test sides), so it is computed once and every later read, and any retry
    after an executor loss, starts from the checkpoint instead of the source.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


Keys = str | list[str]


def _keys(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def fit_models(observed: DataFrame, key: Keys = "tipo_vehiculo", horizon: int = C.HORIZON_DAYS,
               models: tuple[str, ...] = (WITHOUT_HOLIDAYS, WITH_HOLIDAYS), train_col: str | None = None, yearly: bool = True) -> DataFrame:
    """``fit_predict`` for several designs at once (column ``modelo``): one pass over each series, one Gram matrix."""
    keys = _keys(key)
    obs = observed.select(*keys, "fecha", F.col("total_viajes").cast("double").alias("y"),
                          (F.col(train_col) if train_col else F.lit(True)).alias("es_train"), F.lit(False).alias("es_futuro"))
    if horizon > 0:
        obs = materialize_series(obs)  # read for the rows and for the last day
        last = obs.groupBy(*keys).agg(F.max("fecha").alias("_last"))
        days = F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias("fecha")
        obs = obs.unionByName(last.select(*keys, days, F.lit(None).cast("double").alias("y"), F.lit(False).alias("es_train"),
                                          F.lit(True).alias("es_futuro")))
    flags = F.array(*holiday_flags().values()) if WITH_HOLIDAYS in models else F.array().cast("array<double>")
    types = dict(observed.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + (
        ", fecha date, y double, es_prediccion boolean, estado string, prediccion double, prediccion_min double, "
        "prediccion_max double, modelo string")
    fitted = obs.withColumn("flags", flags).groupBy(*keys).applyInPandas(_fit_group(keys, yearly, tuple(models)), schema)
    return fitted.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("y", *PREDICTIONS)})


def fit_predict(observed: DataFrame, key: Keys = "tipo_vehiculo", horizon: int = C.HORIZON_DAYS,
                use_holidays: bool = True, train_col: str | None = None, yearly: bool = True) -> DataFrame:
    """ML4/ML5: fit per series on training rows; predict every row plus ``horizon`` future days.

    ``observed`` has the ``key`` column or columns (a series per type, or per type
    and zone), ``fecha, total_viajes`` (and optionally a boolean ``train_col``;
    default: every observed row trains). Output: keys, ``fecha, y, es_prediccion,
    estado, prediccion, prediccion_min, prediccion_max``; the interval holds 95 % and widens after the last
    training day. A series without a training row keeps
    its rows, with NULL predictions and ``estado`` saying so. ``yearly=False`` leaves the yearly terms out.
    """
    model = WITH_HOLIDAYS if use_holidays else WITHOUT_HOLIDAYS
    return fit_models(observed, key, horizon, (model,), train_col, yearly).drop("modelo")


PREDICTIONS = ("prediccion", "prediccion_min", "prediccion_max")


def error_metrics(pred: DataFrame, actual: DataFrame, by: list[str], yhat: str = "prediccion",
                  y: str = "total_viajes", each: tuple[str, ...] = ()) -> DataFrame:
    """MAE, MAPE (%) and RMSE of predictions joined to actuals on ``by`` + day, per ``by`` and ``each`` (columns of ``pred``)."""
    j = pred.select(*by, *each, "fecha", F.col(yhat).alias("_yhat")).join(
        actual.select(*by, "fecha", F.col(y).cast("double").alias("_y")), [*by, "fecha"])
    e = F.col("_y") - F.col("_yhat")
    return j.groupBy(*by, *each).agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(F.avg(F.abs(e)), 4).alias("mae"),
        round_half_up(F.avg(F.abs(e) / F.greatest(F.abs(F.col("_y")), F.lit(MAPE_EPS))) * 100, 4).alias("mape"),
        round_half_up(F.sqrt(F.avg(e * e)), 4).alias("rmse"))


def seasonal_naive(series: DataFrame, key: Keys = "tipo_vehiculo", lag_days: int = 7) -> DataFrame:
    """Reference forecast: the value observed ``lag_days`` earlier (an equi-join on the shifted day)."""
    return series.select(*_keys(key), F.date_add("fecha", lag_days).alias("fecha"),
                         F.col("total_viajes").cast("double").alias("prediccion"))


def compare_models(split: DataFrame, key: Keys = "tipo_vehiculo", exclude: DataFrame | None = None) -> DataFrame:
    """ML6: hold-out error with and without holidays (trained on ``conjunto = 'train'``).

    ``exclude`` (keys and ``fecha``): days that leave the training of their series, never the test set.
    A series with test rows but no training rows has NULL errors.
    """
    keys = _keys(key)
    split = materialize_series(split)  # read by the fit and the test side
    obs = split.withColumn("_train", F.col("conjunto") == "train")
    if exclude is not None:
        obs = obs.join(exclude.withColumn("_bad", F.lit(True)), [*keys, "fecha"], "left") \
                 .withColumn("_train", F.col("_train") & F.col("_bad").isNull()).drop("_bad")
    test = split.where(F.col("conjunto") == "test")
    return error_metrics(fit_models(obs, keys, horizon=0, train_col="_train"), test, keys, each=("modelo",))


def demand_forecast(series: DataFrame, key: Keys = "tipo_vehiculo", exclude: DataFrame | None = None,
                    horizon: int = C.HORIZON_DAYS, use_holidays: bool = True) -> DataFrame:
    """ML5: refit on all history (minus the days excluded for that series), forecast ``horizon`` days ahead."""
    keys = _keys(key)
    hist = series if exclude is None else series.join(exclude, [*keys, "fecha"], "left_anti")
    fc = fit_predict(hist, keys, horizon, use_holidays)
    return fc.select("fecha", *PREDICTIONS, "es_prediccion", "estado", *keys)
