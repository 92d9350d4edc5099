"""The city dimension and its boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed


def city_dimension(spark: SparkSession) -> DataFrame:
    """55 cities with centre, region and county: a literal table of fixed size."""
    rows = ", ".join(f"('{name}', {lat}D, {lon}D, '{region}', '{county}')"
                     for name, lat, lon, region, county in fixed.rows(fixed.CITIES))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS cities(name, latitude, longitude, region, county)")


def with_box(cities: DataFrame, half_edge: float = fixed.CITY_BOX_DEG) -> DataFrame:
    """Cities with the corners of the box around their centre."""
    return cities.withColumns({
        "min_lon": F.col("longitude") - half_edge, "min_lat": F.col("latitude") - half_edge,
        "max_lon": F.col("longitude") + half_edge, "max_lat": F.col("latitude") + half_edge,
    })
