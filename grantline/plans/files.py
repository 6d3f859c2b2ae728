"""From the names of saved tables to written documents, one function per pipeline.

Each returns the path of the document with the numbers of its pieces and blocks, counted while it is written.
"""

from pyspark.sql import DataFrame, SparkSession

from grantline.operators import allowlist
from grantline.plans.arguments import volume_path
from grantline.plans.governance import load_governance
from grantline.plans.locations import location_document
from grantline.plans.privileges import acl_document
from grantline.plans.volumes import volume_document
from grantline.sinks.text import N_FILES, Written, document_path, write_allowlist, write_document
from grantline.sources.tables import read_table


def _written(document: DataFrame, kind: str, folder: str, n_files: int) -> Written:
    return write_document(document, document_path(folder, kind), n_files=n_files)


def write_locations(
    spark: SparkSession, access: str, path_lists: str, locations: str, volume: str, buckets: str | None = None,
    credential_name: str | None = None, n_files: int = N_FILES,
) -> Written:
    """Location grants; with a bucket table and a credential, new locations as well."""
    document = location_document(
        load_governance(spark, access, path_lists), read_table(spark, locations),
        read_table(spark, buckets) if buckets else None, bool(buckets), credential_name,
    )
    return _written(document, "locations", volume_path(volume), n_files)


def write_volumes(
    spark: SparkSession, locations: str, folders: str, bucket_map: str, default_catalog: str, default_schema: str,
    volume: str, n_files: int = N_FILES,
) -> Written:
    tables = [read_table(spark, name) for name in (locations, folders, bucket_map)]
    return _written(volume_document(*tables, default_catalog, default_schema), "volumes", volume_path(volume), n_files)


def write_grants(spark: SparkSession, grants: str, volume: str, n_files: int = N_FILES) -> Written:
    return _written(acl_document(read_table(spark, grants)), "privileges", volume_path(volume), n_files)


def write_allowlists(spark: SparkSession, libraries: str, current: str, volume: str, library_type: str = "jar") -> str:
    """One JSON document per artifact type, below the returned path."""
    artifacts = allowlist.classify_libraries(read_table(spark, libraries))
    desired = allowlist.allowlist_desired(artifacts, read_table(spark, current), library_type)
    path = f"{volume_path(volume)}/allowlist"
    write_allowlist(allowlist.allowlist_payload(desired), path)
    return path
