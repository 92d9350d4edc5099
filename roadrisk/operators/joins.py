"""Left joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.cities import with_box

GRID = 0.1


def _salt(spread_by: str, salts: int) -> Column:
    # From the row's own key, so that a repeated task spreads its rows the same way.
    return F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")


def spread_left_join(detail: DataFrame, lookup: DataFrame, on: list[str], spread_by: str, salts: int = 1) -> DataFrame:
    """Left join that is planned without a look at the data.

    With one salt it is the plain left join: Spark broadcasts a side by its size, or else splits the large partitions
    of ``detail`` as it runs.  More salts spread every key of ``detail``, NULL included, by a hash of the row's own id
    and repeat the lookup rows as often, whatever the sizes; that is for engines without adaptive execution.
    """
    if salts < 2:
        return detail.join(lookup, on, "left")
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return detail.withColumn("_salt", _salt(spread_by, salts)).join(repeated, [*on, "_salt"], "left").drop("_salt")


def inside_city_boxes(points: DataFrame, cities: DataFrame, latitude: str = "latitude",
                      longitude: str = "longitude") -> DataFrame:
    """Pairs of a point and every city whose box holds it.

    Points and boxes meet on the cells of a grid, so this is an equi-join; the
    exact range test follows.  The 55 literal cities cover a handful of cells
    each, which Spark broadcasts by their known size; a large table of places
    would be shuffled by cell.
    """
    def cell(value: Column) -> Column:
        return F.floor(value / GRID).cast("int")

    boxes = with_box(cities).select(
        F.col("name").alias("box_city"), "min_lon", "min_lat", "max_lon", "max_lat")
    cells = (boxes
             .withColumn("_cx", F.explode(F.sequence(cell(F.col("min_lon")), cell(F.col("max_lon")))))
             .withColumn("_cy", F.explode(F.sequence(cell(F.col("min_lat")), cell(F.col("max_lat"))))))
    placed = points.withColumns({"_cx": cell(F.col(longitude)), "_cy": cell(F.col(latitude))})
    held = (F.col(longitude).between(F.col("min_lon"), F.col("max_lon"))
            & F.col(latitude).between(F.col("min_lat"), F.col("max_lat")))
    return placed.join(cells, ["_cx", "_cy"]).where(held).drop("_cx", "_cy")
