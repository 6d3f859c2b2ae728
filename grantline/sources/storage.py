"""Buckets, their first-level folders and registered locations."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantline.schemas import BUCKET_MAP


def buckets(listing: DataFrame) -> DataFrame:
    return listing.select("bucket_name").filter(F.col("bucket_name").isNotNull()).distinct()


def first_level_folders(object_keys: DataFrame) -> DataFrame:
    """First-level folders (with their trailing ``/``) out of an object inventory.

    One row per bucket and folder: objects at the root of a bucket have no folder.
    """
    key = F.col("object_key")
    return (
        object_keys.filter(key.contains("/"))
        .select("bucket_name", F.concat(F.substring_index(key, "/", 1), F.lit("/")).alias("folder"))
        .distinct()
    )


def external_locations(inventory: DataFrame) -> DataFrame:
    """Registered locations: name, credential_name, credential_id, url."""
    return inventory.select(
        F.col("name").alias("ext_loc_name"),
        "credential_name",
        "credential_id",
        "url",
        F.lit(True).alias("created"),
    )


def bucket_map(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """A hand-written map from bucket URL to catalog and schema."""
    return spark.createDataFrame(rows, BUCKET_MAP)
