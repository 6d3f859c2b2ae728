"""Pipeline 3: volumes."""

from pyspark.sql import DataFrame

from grantline.operators import documents, volumes
from grantline.sinks.shared import stage


def volume_document(
    locations: DataFrame,
    folders: DataFrame,
    bucket_map: DataFrame,
    default_catalog: str,
    default_schema: str,
) -> DataFrame:
    rows = stage(volumes.volumes(locations, folders, bucket_map, default_catalog, default_schema))
    return documents.assemble(documents.volume_blocks(documents.volume_addresses(rows)))
