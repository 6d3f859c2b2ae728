"""Volumes: one per first-level folder of a location's bucket."""

from pyspark.sql import DataFrame, functions as F

from grantline.functions.paths import bucket_name, bucket_url
from grantline.functions.text import label


def location_buckets(locations: DataFrame) -> DataFrame:
    """Bucket URL and bucket name of each location."""
    url = F.col("url")
    return locations.withColumns({"s3_bucket_url": bucket_url(url), "s3_bucket_name": bucket_name(url)})


def volumes(
    locations: DataFrame,
    folders: DataFrame,
    bucket_map: DataFrame,
    default_catalog: str,
    default_schema: str,
) -> DataFrame:
    """Volumes with the catalog and schema they belong to.

    ``folders``: bucket_name, folder (with a trailing ``/``); ``bucket_map`` sends a bucket URL to a
    catalog and schema, other buckets go to the defaults.
    """
    folder = F.col("folder")
    folder_label = label(folder)
    named = folders.filter(folder.isNotNull()).select(
        F.col("bucket_name").alias("s3_bucket_name"),
        folder.alias("volume"),
        F.left(folder_label, F.length(folder_label) - 1).alias("volume_label"),
    )
    return (
        location_buckets(locations)
        .select("s3_bucket_name", "s3_bucket_url", "ext_loc_name")
        .distinct()
        .join(named.distinct(), "s3_bucket_name")
        .join(bucket_map.distinct(), "s3_bucket_url", "left")
        .select(
            "ext_loc_name",
            label(F.col("ext_loc_name")).alias("ext_loc_label"),
            "volume",
            "volume_label",
            F.coalesce("catalog_name", F.lit(default_catalog)).alias("catalog_name"),
            F.coalesce("schema_name", F.lit(default_schema)).alias("schema_name"),
            "s3_bucket_url",
        )
    )


def bucket_map_duplicates(bucket_map: DataFrame) -> DataFrame:
    """Audit: bucket URLs that the map sends to several places, which multiplies their volumes."""
    return (
        bucket_map.groupBy("s3_bucket_url")
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )
