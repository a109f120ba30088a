"""GeoJSON features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators import rejects

# Geometry stays JSON text: its nesting differs between geometry types.
_FEATURE = "type string, id string, properties string, geometry string"
# A collection, or a single feature.
_DOCUMENT = f"{_FEATURE}, features array<struct<{_FEATURE}>>"
_POINT = "type string, coordinates array<string>"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of files that each hold one FeatureCollection.

    One task reads such a file; put large sets into text files with one collection (or
    one feature each) per line and use :func:`collections_to_features`.
    """
    return collections_to_features(spark.read.text(path, wholetext=True))


def collections_to_features(df: DataFrame, value: str = "value") -> DataFrame:
    """Features of text rows that each hold one FeatureCollection or one Feature.

    Text that is neither stays as one row tagged ``corrupt``, with the text in ``raw``.
    """
    documents = df.select(
        F.col(value).alias("raw"), F.from_json(F.col(value), _DOCUMENT).alias("c")
    ).select("raw", "c.*")
    # A feature has a geometry or properties; without either it says nothing.
    says = F.coalesce("geometry", "properties").isNotNull()
    single = F.when(
        (F.col("type") == "Feature") & says,
        F.array(F.struct("type", "id", "properties", "geometry")),
    )
    # An unreadable document counts as one missing feature.
    missing = F.array(F.lit(None).cast(f"struct<{_FEATURE}>"))
    features = documents.select("raw", F.explode(F.coalesce("features", single, missing)).alias("f"))
    features = rejects.tag(features, [(rejects.CORRUPT, F.col("f").isNull())])
    kept = F.when(F.col(rejects.REASON).isNotNull(), F.col("raw")).alias("raw")
    features = features.select("f.*", kept, rejects.REASON)
    point = F.from_json("geometry", _POINT)
    is_point = F.col("_point.type") == "Point"
    located = features.withColumn("_point", point)

    def ordinate(position: int):
        return F.when(is_point, F.get("_point.coordinates", position).try_cast("double"))

    return located.select(
        "id",
        "properties",
        F.col("_point.type").alias("geometry_type"),
        "geometry",
        ordinate(0).alias("lon"),
        ordinate(1).alias("lat"),
        "raw",
        rejects.REASON,
    )
