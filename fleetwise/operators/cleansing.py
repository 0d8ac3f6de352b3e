"""Ride cleansing: keep rides whose start and end both lie in NYC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetwise.functions.geo import in_nyc


def cleanse_rides(rides: DataFrame) -> DataFrame:
    """Narrow filter, no shuffle; works on batch and streaming frames alike."""
    return rides.where(in_nyc("start_lon", "start_lat") & in_nyc("end_lon", "end_lat"))
