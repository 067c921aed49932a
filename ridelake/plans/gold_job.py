"""Silver → gold job: every gold table of the reference in one run.

Silver is scanned once for all aggregate tables: it is aggregated to the
zone-hour base (type × side × zone × day × hour, bounded by the calendar and
the zone catalogue, not by trips), which is checkpointed to the shared
checkpoint folder; every aggregate table is a roll-up of that base. Only the
trip-level classification sample reads silver again. Each table is one
overwriting write of the whole table, so a re-run leaves nothing of an
earlier one, such as a year that silver no longer has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import dims, facts, features
from ..session import checkpoint_root
from ..sources import writers as WR

# Tables rolled up from the hourly base (itself a roll-up of the zone-hour base).
HOURLY_TABLES = (
    ("descriptivo/viajes_por_hora", facts.trips_by_hour_from, ("anio",)),
    ("descriptivo/tendencia_mensual", facts.monthly_trend_from, ()),
    ("diagnostico/comparacion_vehiculos", facts.vehicle_comparison_from, ("anio",)),
    ("diagnostico/duracion_distancia", facts.duration_distance_from, ("anio",)),
)
# Tables rolled up from the zone-hour base — partitioning as the reference writes it.
ZONE_TABLES = (
    ("descriptivo/viajes_por_zona", facts.trips_by_zone_from, ("anio",)),
    ("diagnostico/tarifas_por_zona", facts.fares_by_zone_from, ("anio",)),
    ("predictivo/features_serie_tiempo", facts.daily_series_from, ("tipo_vehiculo", "anio")),
    ("predictivo/features_clustering", facts.zone_features_from, ()),
)
# Trip-level tables: read silver itself.
TRIP_TABLES = (
    ("predictivo/features_clasificacion", features.airport_features, ("anio",)),
)


def run(spark: SparkSession, silver_path: str, gold_path: str, zones: DataFrame | None = None,
        sample_one_in: int = features.SAMPLE_ONE_IN) -> dict[str, str]:
    """``sample_one_in``: share of trips in the classification features (1: all of them)."""
    checkpoint_root(spark)  # the base is checkpointed into the shared folder
    silver = WR.read_silver(spark, silver_path)
    out = {}

    def write(name, df, parts):
        path = f"{gold_path}/{name}"
        WR.write_partitioned(df, path, parts, whole=True)
        out[name] = path

    # Reliable checkpoint: the base is computed by one silver scan and survives
    # executor loss without recomputing it; all roll-ups read the checkpoint.
    base = facts.zone_hour_base(silver).checkpoint(eager=True)
    hourly = facts.hourly_from_zone_base(base)
    for name, build, parts in HOURLY_TABLES:
        write(name, build(hourly), parts)
    for name, build, parts in ZONE_TABLES:
        write(name, build(base), parts)
    for name, build, parts in TRIP_TABLES:
        write(name, build(silver, one_in=sample_one_in), parts)
    write("dims/dim_tiempo", dims.calendar_years(facts.year_bounds_from(base)), ())
    if zones is not None:
        write("dims/dim_ubicacion", dims.dim_location(zones), ())
    return out
