"""Zone segmentation job (ML1 + ML2 + K2): the gold zone profile → ``dim_cluster_zonas``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import cluster as CL
from ..operators import features as FE
from ..sources import writers as WR


def run(zone_features: DataFrame, path: str) -> DataFrame:
    """Cluster the geographic zones with complete features and write the dimension.

    ``zone_features`` is the gold zone profile (``features_clustering``); the
    write is a single overwrite of the whole dimension, which is bounded by the
    zone catalogue. Returns the dimension read back.
    """
    dim = CL.zone_clusters(FE.cluster_input(zone_features))
    WR.write_partitioned(dim, path, whole=True)
    return zone_features.sparkSession.read.parquet(path)
