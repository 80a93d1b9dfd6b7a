"""Distances and radius searches over latitude/longitude columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from sparkweave.functions.scalars import haversine_km

KM_PER_DEGREE = 111.0


def within_radius(points: DataFrame, lat: float, lon: float, radius_km: float) -> DataFrame:
    """Points within a radius of one place; a latitude band is cut off first and can reach the scan."""
    band = radius_km / KM_PER_DEGREE
    near = points.filter(F.col("lat").between(lat - band, lat + band))
    d = haversine_km(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon))
    return near.withColumn("km", d).filter(F.col("km") <= radius_km)


def count_near(centers: DataFrame, points: DataFrame, radius_km: float, max_abs_lat: float) -> DataFrame:
    """Per center, the number of points within the radius.

    Places fall into grid cells at least a radius wide, so only the 3 x 3 cells around a center
    can hold a hit. Points on one spot collapse to a count first. Latitudes beyond
    ``max_abs_lat`` raise, because the cell width in longitude depends on it.
    """
    step = radius_km / KM_PER_DEGREE
    columns = max(int(360.0 / (step / math.cos(math.radians(max_abs_lat)))), 3)

    def cells(df):
        lat = F.when(F.abs("lat") <= max_abs_lat, F.col("lat")).otherwise(
            F.raise_error(F.concat(F.lit("latitude out of bounds: "), F.col("lat"))).cast("double")
        )
        return df.withColumn("_y", F.floor(lat / step)).withColumn(
            "_x", F.pmod(F.floor((F.col("lon") + 180.0) / (360.0 / columns)), F.lit(columns))
        )

    spots = cells(points.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("_n")))
    around = F.sequence(F.lit(-1), F.lit(1))
    c = (
        cells(centers.withColumnsRenamed({"lat": "clat", "lon": "clon"}).withColumns({"lat": F.col("clat"), "lon": F.col("clon")}))
        .drop("lat", "lon")
        .withColumn("_dy", F.explode(around))
        .withColumn("_dx", F.explode(around))
        .withColumn("_y", F.col("_y") + F.col("_dy"))
        .withColumn("_x", F.pmod(F.col("_x") + F.col("_dx"), F.lit(columns)))
        .drop("_dx", "_dy")
    )
    km = haversine_km(F.col("clat"), F.col("clon"), F.col("lat"), F.col("lon"))
    hits = c.join(spots, ["_y", "_x"]).filter(km <= radius_km)
    keys = [x for x in centers.columns if x not in ("lat", "lon")]
    counts = hits.groupBy(*keys).agg(F.sum("_n").alias("near"))
    return centers.join(counts, keys, "left").fillna(0, ["near"])
