"""Zone catalogue CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ZONE_CSV_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered zone CSV with a declared schema (no inference pass over the file).

    The text ``N/A`` stays an ordinary string, as in the published catalogue.
    """
    return spark.read.option("header", "true").option("nullValue", "").schema(ZONE_CSV_SCHEMA).csv(path)


def write_zone_csv(zones: DataFrame, path: str) -> None:
    zones.write.mode("overwrite").option("header", "true").csv(path)
