"""Clustering and forecasting on the driver tables."""

from helpers import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from ridelake.operators import cluster as CL
from ridelake.operators import features as FE
from ridelake.operators import forecast as FC
from ridelake.queries import series_df, zone_features_df


def test_zone_clusters_named_and_complete(spark):
    feats = FE.cluster_input(zone_features_df(spark, SF_MID))
    out = CL.zone_clusters(feats, restarts=2)
    assert out.count() == feats.count()
    names = {r.perfil_zona for r in out.select("perfil_zona").distinct().collect()}
    assert names == {CL.PROFILE_AIRPORT, CL.PROFILE_HUB, CL.PROFILE_COMMUTE, CL.PROFILE_OUTER}
    ids = sorted(r.cluster for r in out.select("cluster").distinct().collect())
    assert ids == [0, 1, 2, 3]


def _plain_kmeans(z, ids, k, restart):
    """Lloyd's rounds on whole numbers with fractions' exactness of the sums, point by point."""
    import numpy as np
    keys = [*range(6), lambda p: sum(p), lambda p: sum(v * v for v in p), lambda p: p[0] - p[1], lambda p: p[2] - p[5]]
    key = keys[restart]
    ranked = sorted(zip(z, ids), key=lambda p: ((p[0][key] if isinstance(key, int) else key(p[0])), p[1]))
    centres = [list(map(float, ranked[(2 * j + 1) * len(z) // (2 * k)][0])) for j in range(k)]
    while True:
        at = [int(np.argmin([sum((a - b) ** 2 for a, b in zip(p, c)) for c in centres])) for p in z]
        groups = [[p for p, c in zip(z, at) if c == i] for i in range(k)]
        new = [[sum(col) / len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centres)]
        if new == centres:
            return at, sum(sum((a - b) ** 2 for a, b in zip(p, centres[c])) for p, c in zip(z, at))
        centres = new


def test_rounds_equal_a_plain_kmeans_in_any_layout(spark):
    feats = FE.cluster_input(zone_features_df(spark, SF_SMALL))
    data = CL.points(feats)
    rows = sorted((r.location_id, list(r.z)) for r in data.collect())
    ids, z = [r[0] for r in rows], [r[1] for r in rows]
    starts = CL.start_points(data, (2, 4), 10)
    one, many = CL.fit(data, starts), CL.fit(data.repartition(3), starts)
    for (k, restart), (centres, cost) in one.items():
        at, plain = _plain_kmeans(z, ids, k, restart)
        assert abs(cost - plain) <= 1e-9 * plain and (centres == many[k, restart][0]).all() and abs(cost - many[k, restart][1]) <= 1e-9 * plain
    best = min((round(c * CL.UNIT ** 2, 4), r) for (k, r), (_, c) in one.items() if k == 4)
    got = {r.location_id: r.prediction for r in CL.assign_clusters(feats.repartition(5)).collect()}
    assert [got[i] for i in ids] == _plain_kmeans(z, ids, 4, best[1])[0]


def test_forecast_shape_and_interval(spark):
    s = series_df(spark, SF_SMALL)
    fc = FC.demand_forecast(s, horizon=90)
    per = fc.groupBy("tipo_vehiculo").agg(F.sum(F.col("es_prediccion").cast("int")).alias("fut"),
                                          F.count(F.lit(1)).alias("n")).collect()
    hist = {r.tipo_vehiculo: r["count"] for r in s.groupBy("tipo_vehiculo").count().collect()}
    for r in per:
        assert r.fut == 90 and r.n == hist[r.tipo_vehiculo] + 90
    assert fc.where("prediccion_min > prediccion OR prediccion_max < prediccion").count() == 0


def test_error_metrics_zero_on_perfect_forecast(spark):
    s = series_df(spark, SF_SMALL)
    pred = s.select("tipo_vehiculo", "fecha", F.col("total_viajes").cast("double").alias("prediccion"))
    m = FC.error_metrics(pred, s, ["tipo_vehiculo"]).collect()
    assert all(r.mae == 0 and r.rmse == 0 and r.mape == 0 for r in m)


def test_cluster_job_writes_complete_dimension(spark):
    from ridelake.plans import cluster_job
    from ridelake.session import scratch_path
    feats = zone_features_df(spark, SF_MID)
    dim = cluster_job.run(feats, scratch_path(spark, "dim_cluster_zonas"))
    assert dim.columns == ["location_id", "cluster", "perfil_zona"]
    assert dim.count() == FE.cluster_input(feats).count()
    assert dim.select("location_id").distinct().count() == dim.count()
    assert {r.cluster for r in dim.select("cluster").distinct().collect()} == {0, 1, 2, 3}


def _series(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(t, dt.date(2022, 1, 1) + dt.timedelta(days=d), n) for t, d, n in rows],
                                 "tipo_vehiculo string, fecha date, total_viajes long")


def test_series_without_training_rows_stay(spark):
    s = _series(spark, [("long", d, 100 + d % 7) for d in range(400)] + [("short", d, 5) for d in range(60)])
    split = FE.split_train_test(s)
    fitted = FC.fit_predict(split.withColumn("_train", F.col("conjunto") == "train"), horizon=0, train_col="_train")
    short = fitted.where("tipo_vehiculo = 'short'")
    assert short.count() == 60 and short.where("prediccion IS NULL AND estado = 'sin_entrenamiento'").count() == 60
    assert fitted.where("tipo_vehiculo = 'long' AND estado = 'ok' AND prediccion IS NOT NULL").count() == 400
    got = {(r.tipo_vehiculo, r.modelo): r for r in FC.compare_models(split).collect()}
    assert len(got) == 4 and got["short", "con_feriados"].n == 60 and got["short", "con_feriados"].mae is None
    assert got["long", "sin_feriados"].mae < 1.0


def test_days_are_excluded_for_their_series_only(spark):
    s = _series(spark, [(t, d, 10) for t in ("yellow", "green") for d in range(700)])
    left = FE.exclude_days(s, FE.excluded_days(spark))
    assert {r.tipo_vehiculo: r["count"] for r in left.groupBy("tipo_vehiculo").count().collect()} == {"yellow": 697, "green": 700}


def test_composite_series_key(spark):
    s = _series(spark, [("a", d, 50 + d % 7) for d in range(120)]).crossJoin(
        spark.range(2).withColumnRenamed("id", "zona")).withColumn("total_viajes", F.col("total_viajes") * (F.col("zona") + 1))
    fc = FC.demand_forecast(s, ["tipo_vehiculo", "zona"], horizon=7)
    assert dict(fc.dtypes)["zona"] == "bigint" and fc.count() == 2 * 127
    by = {r.zona: r.m for r in fc.where("es_prediccion").groupBy("zona").agg(F.avg("prediccion").alias("m")).collect()}
    assert abs(by[1] / by[0] - 2) < 0.01


def test_sample_share_is_a_parameter(spark):
    from ridelake.queries import silver_df
    s = silver_df(spark, SF_SMALL)
    every = FE.airport_features(s, one_in=1).count()
    assert every == s.dropna(subset=["do_location_id", "trip_distance", "duracion_min", "fare_amount"]).count() > 0
    assert FE.airport_features(s, one_in=3).count() < every


def _design(n=500, seed=4, holidays=True):
    import numpy as np
    rng = np.random.default_rng(seed)
    days = np.arange(n, dtype=float) + 19000
    t = (days - days[0]) / (n - 1)
    X, prior = FC._regressors(t, days, True)
    flags = (rng.random((n, 4)) < 0.02).astype(float)
    X = np.column_stack([np.ones(n), X, flags])
    prior = np.concatenate([[np.inf], prior, np.full(4, FC.PRIOR_HOLIDAY)])
    laplace = np.zeros(len(prior), bool)
    laplace[2:2 + FC.N_CHANGEPOINTS] = True
    y = 0.4 + 0.3 * t - 0.5 * np.maximum(t - 0.5, 0) + 0.1 * np.sin(days * 2 * np.pi / 7) + flags @ [-0.2, 0, 0.1, 0] + rng.normal(0, 0.03, n)
    return X, y, prior, laplace


def test_laplace_prior_is_solved_exactly():
    """At the optimum every coefficient's gradient balances its prior, and a plain proximal descent comes to the same objective."""
    import numpy as np
    X, y, prior, laplace = _design()
    G, b = X.T @ X, X.T @ y
    beta, sigma2 = FC.map_estimate(G, b, float(y @ y), len(y), prior, laplace)
    assert abs(sigma2 - np.mean((y - X @ beta) ** 2)) < 1e-9
    gradient = G @ beta - b
    gaussian = gradient + sigma2 * beta / prior ** 2
    lam = sigma2 / FC.PRIOR_CHANGEPOINT
    assert np.abs(gaussian[~laplace]).max() < 1e-5
    on = laplace & (beta != 0)
    assert 0 < on.sum() < FC.N_CHANGEPOINTS / 2 and np.abs(gradient[on] + lam * np.sign(beta[on])).max() < 1e-5
    assert np.abs(gradient[laplace & (beta == 0)]).max() <= lam + 1e-5

    ridge = np.where(laplace, 0, sigma2 / prior ** 2)

    def objective(x):
        return ((y - X @ x) ** 2).sum() / 2 + (ridge * x ** 2).sum() / 2 + lam * np.abs(x[laplace]).sum()
    x, z, step = np.zeros(len(b)), np.zeros(len(b)), 1 / np.linalg.eigvalsh(G).max()
    for i in range(20_000):  # accelerated proximal descent over the whole design
        new = z - step * (G @ z - b + ridge * z)
        new[laplace] = np.sign(new[laplace]) * np.maximum(np.abs(new[laplace]) - step * lam, 0)
        x, z = new, new + i / (i + 3) * (new - x)
    assert abs(objective(beta) - objective(x)) < 1e-6 * objective(x) and objective(beta) <= objective(x) + 1e-9


def test_both_designs_equal_separate_fits(spark):
    s = FE.split_train_test(_series(spark, [("a", d, 100 + 30 * (d % 7) + d // 5) for d in range(800)]))
    obs = s.withColumn("_train", F.col("conjunto") == "train")
    both = FC.fit_models(obs, horizon=0, train_col="_train")
    for model, hol in ((FC.WITHOUT_HOLIDAYS, False), (FC.WITH_HOLIDAYS, True)):
        alone = {r.fecha: r.prediccion for r in FC.fit_predict(obs, horizon=0, use_holidays=hol, train_col="_train").collect()}
        got = {r.fecha: r.prediccion for r in both.where(F.col("modelo") == model).collect()}
        assert got.keys() == alone.keys() and max(abs(got[d] - alone[d]) for d in got) < 1e-6
    m = {r.modelo: r for r in FC.compare_models(s).collect()}
    assert set(m) == {FC.WITHOUT_HOLIDAYS, FC.WITH_HOLIDAYS} and all(0 <= r.mae <= r.rmse and r.n == 90 for r in m.values())


def test_interval_widens_and_covers(spark):
    """Trends that turn at random: about 95 % of the held-out days lie inside, and later days have wider intervals."""
    import numpy as np
    rows = []
    for k in range(24):
        rng = np.random.default_rng(k)
        turns = np.zeros(900)
        turns[rng.integers(0, 900, 28)] = rng.laplace(0, 0.05, 28) * 1000 / 900
        level = 2000 + np.cumsum(np.cumsum(turns)) + 40 * np.sin(np.arange(900) * 2 * np.pi / 7) + rng.normal(0, 15, 900)
        rows += [(f"s{k:02d}", d, int(v)) for d, v in enumerate(level)]
    split = FE.split_train_test(_series(spark, rows)).withColumn("_train", F.col("conjunto") == "train")
    fitted = FC.fit_predict(split, horizon=0, train_col="_train", yearly=False).join(
        split.select("tipo_vehiculo", "fecha", "conjunto", "corte"), ["tipo_vehiculo", "fecha"]).where("conjunto = 'test'")
    inside = F.col("y").between(F.col("prediccion_min"), F.col("prediccion_max")).cast("double")
    share = fitted.agg(F.avg(inside)).first()[0]
    width = {r.h: r.w for r in fitted.groupBy(F.ceil(F.date_diff("fecha", "corte") / 30).alias("h")).agg(
        F.avg(F.col("prediccion_max") - F.col("prediccion_min")).alias("w")).collect()}
    assert 0.88 <= share <= 0.995, share
    assert width[1] < width[2] < width[3]
