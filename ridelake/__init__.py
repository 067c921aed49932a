"""ridelake: a Spark-native medallion engine for trip records.

Bronze trip files of four layouts are conformed to one schema, cleaned by
per-type quality rules and written as a partitioned silver table; gold facts,
dimensions, features, zone clusters and demand forecasts are derived from it.
Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL / MLlib API.
"""

__version__ = "0.1.0"


def facts_entry(spark, sf_dir: str):
    """Flagship plan: bronze trips → clean silver → trips by type × day × hour."""
    from .queries import q_trips_by_hour
    return q_trips_by_hour(spark, sf_dir)
