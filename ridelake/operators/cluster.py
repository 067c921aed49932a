"""Zone segmentation by k-means (ML1, ML1b, ML2, A13).

The input is the zone feature table: one row per pickup zone, so its size
is bounded by the zone catalogue (a few hundred rows) whatever the trip
volume. MLlib scales the features. The fits are Lloyd rounds over all runs (every k
and restart) at once: one pass over the points, one grouped sum. Points are whole
numbers, so sums are exact, and starts and ties are settled by value and zone:
any layout, and any other engine, comes to the same clusters.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..session import checkpoint_root
from ..functions.numeric import round_half_up
from .features import ZONE_FEATURES

MAX_ITER = 300

# Zone profile names.
PROFILE_AIRPORT = "Aeropuertos"
PROFILE_HUB = "Hubs Alta Demanda"
PROFILE_COMMUTE = "Tránsito Diario"
PROFILE_OUTER = "Viajes Periféricos"


def scale(features: DataFrame, cols=ZONE_FEATURES) -> DataFrame:
    """ML1: assemble and standardise (mean 0, sample sd 1) the zone features.

    MLlib divides by the sample standard deviation; scikit-learn by the
    population one. Both scale every feature by the same factor
    sqrt(n/(n-1)), so cluster assignments agree and inertia differs by
    (n-1)/n (``kmeans_elbow`` reports both).
    """
    v = VectorAssembler(inputCols=list(cols), outputCol="raw").transform(features)
    model = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(v)
    return model.transform(v).drop("raw")


def zone_scaled(features: DataFrame) -> DataFrame:
    """ML1 output as columns: location id and the scaled feature values.

    The feature table is checkpointed first, so fitting the scaler and
    applying it read the checkpoint instead of aggregating silver twice.
    """
    checkpoint_root(features.sparkSession)
    s = scale(features.checkpoint(eager=True)).select("location_id", vector_to_array("features").alias("z"))
    return s.select("location_id", *[F.col("z")[i].alias(f"z_{c}") for i, c in enumerate(ZONE_FEATURES)])


# Orders along which starts are picked, over the scaled features 0 to 5 in whole units: every feature,
# their sum, their squared length and two contrasts. A restart takes one order each.
STARTS: tuple[Callable[[Callable[[int], Column]], Column], ...] = (
    *(lambda z, i=i: z(i) for i in range(len(ZONE_FEATURES))),
    lambda z: sum((z(i) for i in range(1, len(ZONE_FEATURES))), z(0)),
    lambda z: sum((z(i) * z(i) for i in range(1, len(ZONE_FEATURES))), z(0) * z(0)),
    lambda z: z(0) - z(1),
    lambda z: z(2) - z(5),
)
# Scaled values are rounded to whole units of this: sums over points are then exact, whatever their order.
UNIT = 1e-6


ROWS_PER_PARTITION = 50_000


def points(features: DataFrame) -> DataFrame:
    """``location_id`` and the scaled features ``z`` in whole units, checkpointed once, a partition per ``ROWS_PER_PARTITION`` rows."""
    checkpoint_root(features.sparkSession)
    features = features.checkpoint(eager=True)
    z = F.transform(vector_to_array("features"), lambda v: F.round(v / UNIT).cast("long"))
    parts = max(1, math.ceil(features.count() / ROWS_PER_PARTITION))
    return scale(features).select("location_id", z.alias("z")).coalesce(parts).checkpoint(eager=True)


def start_points(data: DataFrame, ks, restarts: int) -> dict[tuple[int, int], np.ndarray]:
    """Per (k, restart) ``k`` points: along the restart's order, the middle one of each of ``k`` equal shares, ties by zone.

    The ranks are windows over the whole table, which holds a row per zone of the catalogue.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy())
    ranks = [F.row_number().over(Window.orderBy(order(lambda i: F.col("z")[i]), "location_id")) - 1 for order in STARTS[:restarts]]
    ranked = data.select("z", n.alias("n"), F.array(*ranks).alias("ranks")).select("z", "n", F.posexplode("ranks").alias("restart", "rank"))
    middle = F.floor((2 * F.col("j") + 1) * F.col("n") / (2 * F.col("k")))
    wanted = ranked.withColumn("k", F.explode(F.array(*map(F.lit, ks)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = wanted.filter(F.col("rank") == middle).select("k", "restart", "j", "z").collect()  # k starts of every run
    out: dict[tuple[int, int], list] = {}
    for r in sorted(rows, key=lambda r: (r.k, r.restart, r.j)):
        out.setdefault((r.k, r.restart), []).append(r.z)
    return {run: np.array(z, float) for run, z in out.items()}


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each point's nearest centre, the first of equals; summed feature by feature."""
    d = (x[:, None, 0] - centres[None, :, 0]) ** 2
    for i in range(1, x.shape[1]):
        d = d + (x[:, None, i] - centres[None, :, i]) ** 2
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def _sums(x: np.ndarray, runs: dict) -> list[tuple]:
    """Per run and centre of these points: how many, their squared distances and their exact sums."""
    out = []
    for (k, restart), centres in runs.items():
        at, d = _nearest(x, centres)
        for c in np.unique(at):
            some = at == c
            out.append((k, restart, int(c), int(some.sum()), float(d[some].sum()), x[some].sum(0).astype(np.int64).tolist()))
    return out


def _points_of(batches) -> np.ndarray:
    some = [np.stack(pdf["z"].to_numpy()).astype(float) for pdf in batches if len(pdf)]
    return np.concatenate(some) if some else np.zeros((0, len(ZONE_FEATURES)))


def _round(data: DataFrame, runs: dict) -> list[tuple]:
    """One assignment of all points in every run: the centres travel with the task, a grouped sum adds what partitions send."""
    def work(batches):
        yield pd.DataFrame(_sums(_points_of(batches), runs), columns=["k", "restart", "c", "n", "d", "s"])

    sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(len(ZONE_FEATURES))]
    rows = data.select("z").mapInPandas(work, "k int, restart int, c int, n long, d double, s array<long>").groupBy(
        "k", "restart", "c").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), *sums).collect()  # a row per run and centre
    return [(*r[:5], list(r[5:])) for r in rows]


def lloyd(step: Callable[[dict], list[tuple]], runs: dict, most_rounds: int = MAX_ITER) -> dict:
    """Per run its centres and inertia (in squared units) once no centre moves; all runs advance in the same round.

    A centre is the exact sum of its points by their number; one without points stays where it is.
    """
    done, moving, cost = {}, dict(runs), {}
    for _ in range(most_rounds):
        if not moving:
            break
        cost, after = dict.fromkeys(moving, 0.0), {run: c.copy() for run, c in moving.items()}
        for k, restart, c, n, d, s in step(moving):
            after[k, restart][c] = [v / n for v in s]
            cost[k, restart] += d
        for run in [run for run, c in after.items() if (c == moving[run]).all()]:
            done[run] = after.pop(run), cost[run]
        moving = after
    return done | {run: (c, cost[run]) for run, c in moving.items()}


def fit(data: DataFrame, runs: dict) -> dict:
    """Every run's centres and inertia. Points of a single partition advance inside its task, others by a job a round: the same sums."""
    if data.rdd.getNumPartitions() > 1:
        return lloyd(lambda moving: _round(data, moving), runs)

    def work(batches):
        x = _points_of(batches)
        found = lloyd(lambda moving: _sums(x, moving), runs)
        yield pd.DataFrame([(*run, c.ravel().tolist(), d) for run, (c, d) in found.items()], columns=["k", "restart", "centres", "d"])

    rows = data.select("z").mapInPandas(work, "k int, restart int, centres array<double>, d double").collect()  # a row per run
    return {(r.k, r.restart): (np.array(r.centres).reshape(r.k, -1), r.d) for r in rows}


def _best(found: dict) -> dict[int, tuple[int, np.ndarray, float]]:
    """Per k the restart of least inertia (to 4 decimals; the first of equals), its centres and that inertia."""
    out: dict[int, tuple[int, np.ndarray, float]] = {}
    for (k, restart), (centres, cost) in sorted(found.items()):
        cost = round(cost * UNIT ** 2, 4)
        if k not in out or cost < out[k][2]:
            out[k] = restart, centres, cost
    return out


def kmeans_elbow(features: DataFrame, ks=C.ELBOW_K, restarts: int = C.ELBOW_RESTARTS) -> DataFrame:
    """ML1b: best inertia per k over ``restarts`` fits, all of which advance together, a grouped sum per round.

    ``inercia_pob`` is the inertia under scaling by the population's deviation.
    """
    data = points(features)
    n = data.count()
    best = _best(fit(data, start_points(data, ks, restarts)))
    rows = [(k, cost, round(cost * n / (n - 1), 4) if n > 1 else cost) for k, (_, _, cost) in sorted(best.items())]
    return features.sparkSession.createDataFrame(rows, "k int, inercia double, inercia_pob double")


def assign_clusters(features: DataFrame, k: int = C.N_CLUSTERS, restarts: int = C.ELBOW_RESTARTS) -> DataFrame:
    """ML2 (first half): the features with the cluster of the best fit, column ``prediction``.

    Starts, sums and ties are settled by the data alone, so the result is the same for every layout.
    """
    data = points(features)
    best = _best(fit(data, start_points(data, (k,), restarts)))
    centres = best[k][1] if best else np.zeros((1, len(ZONE_FEATURES)))

    def work(batches):
        for pdf in batches:
            if len(pdf):
                at, _ = _nearest(np.stack(pdf["z"].to_numpy()).astype(float), centres)
                yield pd.DataFrame({"_zone": pdf["location_id"], "prediction": at})

    kind = dict(data.dtypes)["location_id"]
    found = data.mapInPandas(work, f"_zone {kind}, prediction int")
    return features.join(found, F.col("location_id") == F.col("_zone")).drop("_zone").checkpoint(eager=True)


def cluster_profile(assigned: DataFrame, cluster_col: str = "prediction") -> DataFrame:
    """Mean of each feature (2 decimals) and zone count per cluster."""
    return assigned.groupBy(cluster_col).agg(
        *[round_half_up(F.avg(c)).alias(c) for c in ZONE_FEATURES], F.count(F.lit(1)).alias("n_zonas"))


def name_clusters(assigned: DataFrame) -> DataFrame:
    """ML2 (second half): stable ids and names from centroid traits.

    Raw k-means ids are arbitrary, so clusters are renumbered by mean trip
    volume (0 = busiest) and named by traits: the longest mean distance is
    the airport profile, the busiest of the rest the high-demand hubs, the
    highest peak-hour share of the rest the commuter zones, and any other
    cluster the outer-area profile. The profile table has k rows.
    """
    prof = assigned.groupBy("prediction").agg(
        F.avg("total_viajes").alias("m_viajes"), F.avg("distancia_promedio").alias("m_dist"),
        F.avg("pct_hora_pico").alias("m_pico"))
    w_all = Window.orderBy(F.col("m_viajes").desc(), "prediction")
    w_dist = Window.orderBy(F.col("m_dist").desc(), "prediction")
    prof = prof.withColumn("cluster", F.row_number().over(w_all) - 1) \
               .withColumn("_airport", F.row_number().over(w_dist) == 1)
    rest = Window.partitionBy("_airport").orderBy(F.col("m_viajes").desc(), "prediction")
    peak = Window.partitionBy("_airport", "_hub").orderBy(F.col("m_pico").desc(), "prediction")
    prof = prof.withColumn("_hub", ~F.col("_airport") & (F.row_number().over(rest) == 1))
    prof = prof.withColumn("_commute", ~F.col("_airport") & ~F.col("_hub") & (F.row_number().over(peak) == 1))
    name = (F.when(F.col("_airport"), PROFILE_AIRPORT).when(F.col("_hub"), PROFILE_HUB)
             .when(F.col("_commute"), PROFILE_COMMUTE).otherwise(PROFILE_OUTER))
    labels = prof.select("prediction", "cluster", name.alias("perfil_zona"))
    return (assigned.join(F.broadcast(labels), "prediction")
                    .select("location_id", F.col("cluster").cast("int"), "perfil_zona"))


def zone_clusters(features: DataFrame, **kw) -> DataFrame:
    """ML2: ``dim_cluster_zonas`` — location id, cluster id, profile name."""
    return name_clusters(assign_clusters(features, **kw))
