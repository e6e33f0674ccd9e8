"""Region map source (S2): ``{region: [{도시, IATA, 공항명}, ...]}`` JSON, optionally starting with a BOM.

The map is a small configuration document (one entry per served airport), read whole as text and
parsed with ``from_json`` into a map, then exploded into one row per (region, airport).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names of an airport entry in the map document (fixed values).
CITY, IATA, AIRPORT_NAME = "도시", "IATA", "공항명"

AIRPORT_ENTRY = T.StructType([T.StructField(CITY, T.StringType()), T.StructField(IATA, T.StringType()),
                              T.StructField(AIRPORT_NAME, T.StringType())])
REGION_MAP = T.MapType(T.StringType(), T.ArrayType(AIRPORT_ENTRY))


def parse_region_map(text_col) -> "F.Column":
    """Text column -> ``map<region, array<entry>>``; a leading BOM is stripped first (with it,
    ``from_json`` returns null)."""
    cleaned = F.regexp_replace(text_col, "^\ufeff", "")
    return F.from_json(cleaned, REGION_MAP)


def read_region_map(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(region, city, iata, airport_name, position)``, ``position`` = order inside the region."""
    doc = spark.read.text(path, wholetext=True).select(parse_region_map(F.col("value")).alias("m"))
    regions = doc.select(F.explode("m").alias("region", "airports"))
    return regions.select("region", F.posexplode("airports").alias("position", "a")).select(
        "region", F.col(f"a.{CITY}").alias("city"), F.col(f"a.{IATA}").alias("iata"),
        F.col(f"a.{AIRPORT_NAME}").alias("airport_name"), "position")


def write_region_map(airports: DataFrame, path: str, region_col: str = "country",
                     code_col: str = "airport_code", name_col: str = "name", city_col: str = "name",
                     bom: bool = True) -> None:
    """Write an airport dimension as a region map document (one text file, UTF-8, optional BOM).

    The document holds one entry per airport, so it is bounded by the airport dimension; it is built
    by a grouped aggregate per region and a single global aggregate over the regions.
    """
    per_region = (airports.groupBy(F.col(region_col).alias("region"))
                  .agg(F.array_sort(F.collect_list(F.struct(
                      F.col(city_col).alias(CITY), F.col(code_col).alias(IATA),
                      F.col(name_col).alias(AIRPORT_NAME)))).alias("airports")))
    doc = per_region.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("region", "airports"))))).alias("value"))
    if bom:
        doc = doc.select(F.concat(F.lit("\ufeff"), F.col("value")).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
