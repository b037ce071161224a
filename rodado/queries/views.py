"""Views of the tables that the registered queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import table


def event_tracks(spark: SparkSession, d: str) -> DataFrame:
    """(track, ord, lng, lat): a walk for each user of the events table."""
    e = F.col("event_id")
    far = F.when(e % 41 == 0, 20).otherwise(1)
    w = Window.partitionBy("track").orderBy("ts", "event_id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    df = table(spark, d, "events").where("user_id is not null").select(
        F.col("user_id").alias("track"), "event_id", "ts", (((e * 7919) % 401 - 200) * far).alias("_dx"), (((e * 104729) % 401 - 200) * far).alias("_dy")
    )
    return df.select(
        "track", F.row_number().over(w).cast("long").alias("ord"),
        (F.lit(-75.7) + F.sum("_dx").over(run) / F.lit(1e5)).alias("lng"), (F.lit(45.4) + F.sum("_dy").over(run) / F.lit(1e5)).alias("lat"),
    )


def way_points(spark: SparkSession, d: str) -> DataFrame:
    """(track, ord, lng, lat): the vertices of the ways, each way once."""
    w = table(spark, d, "ways").where("way_id is not null").dropDuplicates(["way_id"])
    p = w.select(F.col("way_id").alias("track"), F.posexplode("geometry").alias("ord", "_p"))
    return p.select("track", F.col("ord").cast("long").alias("ord"), F.col("_p.lon").alias("lng"), F.col("_p.lat").alias("lat")).where(geo.on_earth("lng", "lat"))


def places(spark: SparkSession, d: str) -> DataFrame:
    """The places, each once, repeated deliveries dropped."""
    return table(spark, d, "places").drop("loaded_at").dropDuplicates(["place_id"])


def routes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "routes").drop("loaded_at").dropDuplicates(["route_id"])


def located(df: DataFrame) -> DataFrame:
    """Rows with coordinates on earth."""
    return df.where(geo.on_earth("lng", "lat"))
