"""Independent DuckDB SQL for every query with an oracle.

The DuckDB side sees only the driver's tables, so each statement inlines the
trip fixture as a derived table (FIXTURES.md §3). Rounding goes through a
6-place decimal, as on the Spark side; day of week is shifted to 1 = Sunday.
"""

from __future__ import annotations


def r2(x: str) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(38,6)) AS DECIMAL(38,2)) AS DOUBLE)"


def rn(x: str, n: int) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(38,6)) AS DECIMAL(38,{n})) AS DOUBLE)"


def _bronze_sql(multi: bool) -> str:
    pickup = "ts + to_days(CAST((event_id % 36) * 30 AS INTEGER))" if multi else "ts"
    if multi:
        fa = "CAST(year(pickup_datetime) AS INTEGER)"
        fm = ("CAST(CASE WHEN trip_id % 50 = 0 THEN month(pickup_datetime) % 12 + 1 "
              "ELSE month(pickup_datetime) END AS INTEGER)")
    else:
        fa = "CAST(2024 AS INTEGER)"
        fm = "CAST(CASE WHEN trip_id % 50 = 0 THEN 2 ELSE 1 END AS INTEGER)"
    return f"""(
  SELECT trip_id, tipo_vehiculo, {fa} AS file_anio, {fm} AS file_mes,
    pickup_datetime,
    pickup_datetime + to_seconds(secs) AS dropoff_datetime,
    CASE WHEN trip_id % 13 = 0 THEN NULL ELSE user_id % 265 + 1 END AS pu_location_id,
    CASE WHEN trip_id % 17 = 0 THEN NULL ELSE (user_id * 7 + trip_id) % 265 + 1 END AS do_location_id,
    fare AS fare_amount,
    fare / 10 AS tip_amount,
    CASE WHEN tipo_vehiculo IN ('yellow', 'green') THEN fare * 1.2 END AS total_amount,
    CASE WHEN tipo_vehiculo = 'fhvhv' THEN (trip_id * 11) % 3000 / 100 - 1 END AS driver_pay,
    fare / 10 AS tolls_amount,
    CASE WHEN tipo_vehiculo <> 'fhv' THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN tipo_vehiculo IN ('yellow', 'fhvhv') THEN CAST(0 AS DOUBLE) END AS airport_fee,
    CASE WHEN tipo_vehiculo = 'fhv' THEN NULL WHEN trip_id % 23 = 0 THEN CAST(160 AS DOUBLE)
         ELSE (trip_id * 53) % 9000 / 100 - 1 END AS trip_distance,
    CASE WHEN tipo_vehiculo = 'fhvhv' THEN secs END AS trip_time_sec,
    CASE WHEN tipo_vehiculo IN ('yellow', 'green') THEN CAST(trip_id % 6 AS DOUBLE) END AS passenger_count,
    CASE WHEN tipo_vehiculo IN ('yellow', 'green') AND trip_id % 19 <> 0
         THEN CAST(trip_id % 7 AS INTEGER) END AS payment_type
  FROM (SELECT *, CASE WHEN tipo_vehiculo <> 'fhv' THEN any_fare END AS fare FROM (
    SELECT event_id AS trip_id, user_id,
      CASE event_type WHEN 'click' THEN 'yellow' WHEN 'view' THEN 'green'
                      WHEN 'signup' THEN 'fhv' WHEN 'purchase' THEN 'fhvhv'
        ELSE CASE event_id % 4 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' WHEN 2 THEN 'fhv' ELSE 'fhvhv' END END AS tipo_vehiculo,
      {pickup} AS pickup_datetime,
      CAST(round(value * 60) AS BIGINT) AS secs,
      (event_id * 37) % 40000 / 100 - 20 AS any_fare
    FROM events
  ) e0) e
)"""


DUR = "((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60)"
YG = (f"((fare_amount >= 0 OR (fare_amount < 0 AND payment_type IN (3, 4))) AND fare_amount <= 300 "
      f"AND NOT (trip_distance <= 0 AND {DUR} > 3) AND trip_distance <= 80 AND {DUR} >= 1 AND {DUR} <= 200)")
GREEN = f"({YG} AND fare_amount >= 2.5)"
FHV = f"(pu_location_id IS NOT NULL AND do_location_id IS NOT NULL AND {DUR} >= 1 AND {DUR} <= 200)"
FHVHV = (f"(fare_amount >= 2.5 AND driver_pay > 0 AND NOT (trip_distance <= 0 AND {DUR} > 3) "
         f"AND trip_distance <= 150 AND {DUR} >= 1 AND {DUR} <= 200)")
TYPE_RULE = (f"(CASE tipo_vehiculo WHEN 'yellow' THEN {YG} WHEN 'green' THEN {GREEN} "
             f"WHEN 'fhv' THEN {FHV} WHEN 'fhvhv' THEN {FHVHV} END)")
MONTH_RULE = "(year(pickup_datetime) = file_anio AND month(pickup_datetime) = file_mes)"
VERDICT = f"COALESCE({TYPE_RULE} AND {MONTH_RULE}, false)"

CONFORMED = ("tipo_vehiculo, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id, "
             "fare_amount, tip_amount, total_amount, driver_pay, tolls_amount, congestion_surcharge, "
             "airport_fee, trip_distance, trip_time_sec, passenger_count, payment_type")
DERIVED = (f"{DUR} AS duracion_min, CAST(hour(pickup_datetime) AS INTEGER) AS hora, "
           "CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS dia_semana, file_mes AS mes, file_anio AS anio")


def with_trips(body: str, multi: bool = False, where: str | None = None, ctes: str = "") -> str:
    """``WITH trips_bronze, silver[, more CTEs]`` prefix + body.

    ``ctes`` continues the WITH list and must start with a comma.
    """
    w = f" AND ({where})" if where else ""
    return (f"WITH trips_bronze AS {_bronze_sql(multi)},\n"
            f"silver AS (SELECT {CONFORMED}, {DERIVED} FROM trips_bronze WHERE {VERDICT}{w})"
            f"{ctes}\n{body}")


DAY_KEYS = ("CAST(year(pickup_datetime) AS INTEGER) AS anio, CAST(month(pickup_datetime) AS INTEGER) AS mes, "
            "CAST(day(pickup_datetime) AS INTEGER) AS dia")
MONTH_KEYS = "CAST(year(pickup_datetime) AS INTEGER) AS anio, CAST(month(pickup_datetime) AS INTEGER) AS mes"
