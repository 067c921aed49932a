"""Trip-shaped inputs derived from the driver tables.

The driver ships TPC-H-like tables, not trip files; these functions derive
deterministic trip records from them (``events`` → bronze trips, ``orders`` →
long daily series, ``nation``/``region`` → zone catalogue). Each is a lazy
DataFrame over the table scan, so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CONFORMED_COLUMNS

# Fixed mapping of event types to vehicle types; any other event goes by its id (FIXTURES.md §3).
EVENT_TO_TYPE = (("click", "yellow"), ("view", "green"), ("signup", "fhv"), ("purchase", "fhvhv"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _vehicle_type(ev: Column) -> Column:
    expr = None
    for e, t in EVENT_TO_TYPE:
        expr = F.when(ev == e, t) if expr is None else expr.when(ev == e, t)
    for i, (_, t) in enumerate(EVENT_TO_TYPE[:-1]):
        expr = expr.when(F.pmod(F.col("event_id"), F.lit(4)) == i, t)
    return expr.otherwise(EVENT_TO_TYPE[-1][1])


def trips_bronze(spark: SparkSession, sf_dir: str, multi: bool = False) -> DataFrame:
    """Unified-schema bronze trips plus ``trip_id``, ``file_ym``, ``file_anio``, ``file_mes``.

    ``multi=False``: all pickups in 2024-01 (§3); every 50th event claims file
    month 2 (corrupt-month rows). ``multi=True``: pickups spread over 36
    months by ``event_id % 36`` × 30 days (§3.1).
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    tipo = _vehicle_type(F.col("event_type"))
    if multi:
        pickup = F.timestamp_add("DAY", ((eid % 36) * 30).cast("int"), F.col("ts"))
    else:
        pickup = F.col("ts")
    secs = F.round(F.col("value") * 60).cast("long")
    df = ev.select(
        eid.alias("trip_id"),
        tipo.alias("tipo_vehiculo"),
        pickup.alias("pickup_datetime"),
        secs.alias("_secs"),
        F.col("user_id"),
    )
    eid = F.col("trip_id")
    t = F.col("tipo_vehiculo")
    is_fhv = t == "fhv"
    fare = F.when(~is_fhv, (eid * 37) % 40000 / 100 - 20)
    p = F.col("pickup_datetime")
    if multi:
        file_anio = F.year(p)
        file_mes = F.when(eid % 50 == 0, F.month(p) % 12 + 1).otherwise(F.month(p))
    else:
        file_anio = F.lit(2024)
        file_mes = F.when(eid % 50 == 0, F.lit(2)).otherwise(F.lit(1))
    return df.select(
        "trip_id",
        "tipo_vehiculo",
        (file_anio * 100 + file_mes).cast("int").alias("file_ym"),
        file_anio.cast("int").alias("file_anio"),
        file_mes.cast("int").alias("file_mes"),
        "pickup_datetime",
        F.timestamp_add("SECOND", F.col("_secs"), p).alias("dropoff_datetime"),
        F.when(eid % 13 != 0, F.col("user_id") % 265 + 1).alias("pu_location_id"),
        F.when(eid % 17 != 0, (F.col("user_id") * 7 + eid) % 265 + 1).alias("do_location_id"),
        fare.alias("fare_amount"),
        (fare / 10).alias("tip_amount"),
        F.when(t.isin("yellow", "green"), fare * 1.2).alias("total_amount"),
        F.when(t == "fhvhv", (eid * 11) % 3000 / 100 - 1).alias("driver_pay"),
        (fare / 10).alias("tolls_amount"),
        F.when(~is_fhv, F.lit(2.5)).alias("congestion_surcharge"),
        F.when(t.isin("yellow", "fhvhv"), F.lit(0.0)).alias("airport_fee"),
        F.when(~is_fhv, F.when(eid % 23 == 0, F.lit(160.0))
               .otherwise((eid * 53) % 9000 / 100 - 1)).alias("trip_distance"),
        F.when(t == "fhvhv", F.col("_secs")).alias("trip_time_sec"),
        F.when(t.isin("yellow", "green"), (eid % 6).cast("double")).alias("passenger_count"),
        F.when(t.isin("yellow", "green") & (eid % 19 != 0), (eid % 7).cast("int")).alias("payment_type"),
    )


# Raw column names per type: unified name -> raw name (None: not in the raw layout).
RAW_NAMES = {
    "yellow": {
        "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime",
        "pu_location_id": "PULocationID", "do_location_id": "DOLocationID",
        "fare_amount": "fare_amount", "tip_amount": "tip_amount", "total_amount": "total_amount",
        "tolls_amount": "tolls_amount", "congestion_surcharge": "congestion_surcharge",
        "airport_fee": "airport_fee", "trip_distance": "trip_distance",
        "passenger_count": "passenger_count", "payment_type": "payment_type",
    },
    "green": {
        "pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime",
        "pu_location_id": "PULocationID", "do_location_id": "DOLocationID",
        "fare_amount": "fare_amount", "tip_amount": "tip_amount", "total_amount": "total_amount",
        "tolls_amount": "tolls_amount", "congestion_surcharge": "congestion_surcharge",
        "trip_distance": "trip_distance", "passenger_count": "passenger_count",
        "payment_type": "payment_type",
    },
    "fhv": {
        "pickup_datetime": "pickup_datetime", "dropoff_datetime": "dropOff_datetime",
        "pu_location_id": "PUlocationID", "do_location_id": "DOlocationID",
    },
    "fhvhv": {
        "pickup_datetime": "pickup_datetime", "dropoff_datetime": "dropoff_datetime",
        "pu_location_id": "PULocationID", "do_location_id": "DOLocationID",
        "fare_amount": "base_passenger_fare", "tip_amount": "tips", "driver_pay": "driver_pay",
        "tolls_amount": "tolls", "congestion_surcharge": "congestion_surcharge",
        "airport_fee": "airport_fee", "trip_distance": "trip_miles", "trip_time_sec": "trip_time",
    },
}

# Physical types the raw layouts carry (they differ from the unified ones).
RAW_TYPES = {
    "yellow": {"pu_location_id": "int", "do_location_id": "int", "payment_type": "long"},
    "green": {"pu_location_id": "int", "do_location_id": "int", "payment_type": "double",
              "passenger_count": "double"},
    "fhv": {"pu_location_id": "double", "do_location_id": "double"},
    "fhvhv": {"pu_location_id": "int", "do_location_id": "int"},
}


# Physical types that monthly files of a layout have had: one variant per month, in turn.
DRIFT_TYPES = (
    {"pu_location_id": "int", "do_location_id": "int", "passenger_count": "double", "payment_type": "long"},
    {"pu_location_id": "long", "do_location_id": "long", "passenger_count": "long", "payment_type": "double"},
    {"pu_location_id": "double", "do_location_id": "long", "passenger_count": "double", "payment_type": "int"},
)


def raw_frame(bronze: DataFrame, tipo: str, extra: tuple[str, ...] = ("trip_id", "file_anio", "file_mes"),
              types: dict[str, str] | None = None) -> DataFrame:
    """One type's rows in that type's raw layout (names and physical types)."""
    names = RAW_NAMES[tipo]
    types = RAW_TYPES[tipo] if types is None else types
    cols = [F.col(c) for c in extra]
    for unified in CONFORMED_COLUMNS:
        raw = names.get(unified)
        if raw is None:
            continue
        c = F.col(unified)
        if unified in types:
            c = c.cast(types[unified])
        cols.append(c.alias(raw))
    return bronze.where(F.col("tipo_vehiculo") == tipo).select(*cols)


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order counts per priority as a long daily series (FIXTURES.md §4)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("tipo_vehiculo"),
                      F.to_date("o_orderdate").alias("fecha"))
             .agg(F.count(F.lit(1)).alias("total_viajes")))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone catalogue in the raw CSV layout: nation ⋈ region (25 zones)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(n.n_nationkey.alias("LocationID"), r.r_name.alias("Borough"),
                     n.n_name.alias("Zone"),
                     F.when(r.r_regionkey == 1, "Airports").otherwise("Boro Zone").alias("service_zone")))


def orders_as_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as trips: type = order priority, pickup = order date (series_long input)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("tipo_vehiculo"), F.col("o_orderdate").alias("pickup_datetime"))


def zone_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips between nations: origin = customer nation, destination =
    supplier nation, day = order date, type = order priority (``trips_zone_small``).

    lineitem ⋈ orders is a large-large equi-join (shuffled on the order key);
    customer and supplier joins are left to the optimizer's size check.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, F.col("o_custkey") == c.c_custkey, "left")
           .join(s, F.col("l_suppkey") == s.s_suppkey, "left"))
    return j.select(F.col("o_orderpriority").alias("tipo_vehiculo"), F.col("o_orderdate").alias("pickup_datetime"),
                    F.col("c_nationkey").cast("long").alias("pu_location_id"),
                    F.col("s_nationkey").cast("long").alias("do_location_id"))


# Fixed for the order series: the days of one series, and of no other, that are left out of its training.
SERIES_EXCLUDED = {"1-URGENT": ("1998-09-22", "1998-09-23", "1998-09-24")}
