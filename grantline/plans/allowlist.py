"""Pipeline 5: the artifact allowlist."""

from pyspark.sql import DataFrame

from grantline.operators import allowlist


def allowlist_update(libraries: DataFrame, current: DataFrame, library_type: str = "jar") -> DataFrame:
    """The whole list that should be in force, as the pieces of one document per type."""
    artifacts = allowlist.classify_libraries(libraries)
    return allowlist.allowlist_payload(
        allowlist.allowlist_desired(artifacts, current, library_type)
    )
