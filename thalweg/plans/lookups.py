"""Questions asked of the snapped observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.functions import path_order
from thalweg.operators.routes import elevation_at


def species_on_route(observations: DataFrame, route: int, below: float) -> DataFrame:
    """The species seen on one route downstream of a measure."""
    seen = observations.where((F.col("blue_line_key") == route) & (F.col("downstream_route_measure") < below))
    return seen.select("species_code").distinct().orderBy(F.col("species_code").asc_nulls_last())


def observations_with_stream(
    observations: DataFrame, streams: DataFrame, species: str, group: str, *columns: str
) -> DataFrame:
    """Observations of a species in a watershed group with stream attributes."""
    seen = observations.where((F.col("species_code") == species) & (F.col("watershed_group_code") == group))
    return seen.join(streams.select("linear_feature_id", *columns), "linear_feature_id")


def gradient_at_species(
    observations: DataFrame, streams: DataFrame, species: str, group: str, edge_type: int = 1000
) -> DataFrame:
    """Stream name and gradient at a species' observations on one kind of line."""
    found = observations_with_stream(
        observations, streams.where(F.col("edge_type") == edge_type), species, group, "gnis_name", "gradient"
    )
    return _in_network_order(found).select("observation_key", "gnis_name", "gradient")


def elevation_at_species(observations: DataFrame, streams: DataFrame, species: str, group: str) -> DataFrame:
    """Gradient, order and elevation of the stream at a species' observations."""
    found = observations_with_stream(
        observations, streams, species, group, "gradient", "stream_order", "vertices"
    )
    return _in_network_order(elevation_at(found)).select(
        "observation_key", "gradient", "stream_order", "elevation"
    )


def _in_network_order(df: DataFrame) -> DataFrame:
    return df.orderBy(
        path_order("wscode").asc_nulls_last(),
        path_order("localcode").asc_nulls_last(),
        F.col("downstream_route_measure").asc_nulls_last(),
    )
