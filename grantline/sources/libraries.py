"""Libraries installed on clusters and the current allowlist."""

from pyspark.sql import DataFrame, functions as F

from grantline.schemas import ALLOWLIST
from grantline.sources.tables import Landed, parse_landed


def library_inventory(interactive: DataFrame, job: DataFrame) -> DataFrame:
    """One row per installed library of interactive and job clusters.

    Both inputs have ``libraries``, the list of a cluster.
    """
    kinds = [interactive.withColumn("cluster_kind", F.lit("interactive")),
             job.withColumn("cluster_kind", F.lit("job"))]
    clusters = kinds[0].select("cluster_kind", "libraries").unionByName(
        kinds[1].select("cluster_kind", "libraries")
    )
    return clusters.select("cluster_kind", F.explode("libraries").alias("library")).select(
        "cluster_kind",
        F.col("library.jar").alias("jar"),
        F.col("library.maven.coordinates").alias("maven_coordinates"),
    )


def landed_allowlist(snapshots: DataFrame) -> Landed:
    """``artifact_type, document`` rows: documents, rejected ones and unknown fields."""
    return parse_landed(snapshots.select("artifact_type", "document"), "document", ALLOWLIST, ("artifact_matchers",))


def current_allowlist(snapshots: DataFrame) -> DataFrame:
    """Matchers out of ``artifact_type, document`` rows."""
    return landed_allowlist(snapshots).records.select("artifact_type", F.inline("artifact_matchers"))
