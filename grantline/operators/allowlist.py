"""Libraries in use that the artifact allowlist lacks."""

from pyspark.sql import DataFrame, functions as F

from grantline.fixed import ALLOWLIST_MATCH_TYPE, JAR_LOCATIONS, LIBRARY_TYPES

EVERY_TYPE = "jar/maven"


def classify_libraries(libraries: DataFrame) -> DataFrame:
    """Distinct artifacts: a jar if there is one, else maven coordinates; others are dropped."""
    jar, maven = F.col("jar"), F.col("maven_coordinates")
    return (
        libraries.select(
            F.when(jar.isNotNull(), "jar").when(maven.isNotNull(), "maven").alias("artifact_type"),
            F.coalesce(jar, maven).alias("artifact"),
        )
        .filter(F.col("artifact").isNotNull())
        .distinct()
    )


def allowlist_delta(artifacts: DataFrame, current: DataFrame, library_type: str = "jar") -> DataFrame:
    """Entries to add: artifacts that may be listed and are not listed yet."""
    if library_type not in LIBRARY_TYPES:
        raise ValueError(f"library type {library_type!r} is none of {list(LIBRARY_TYPES)}")
    artifact = F.col("artifact")
    installable = F.lit(False)
    for place in JAR_LOCATIONS:
        installable = installable | artifact.startswith(place)
    wanted = artifacts.filter(
        F.col("artifact_type").isin(LIBRARY_TYPES[library_type])
        & ((F.col("artifact_type") != "jar") | installable)
    ).select("artifact_type", "artifact", F.lit(ALLOWLIST_MATCH_TYPE).alias("match_type"))
    return wanted.join(current, ["artifact_type", "artifact", "match_type"], "left_anti")


def allowlist_desired(
    artifacts: DataFrame, current: DataFrame, library_type: str = "jar"
) -> DataFrame:
    """The current entries of the selected types and the new ones."""
    kept = current.filter(F.col("artifact_type").isin(LIBRARY_TYPES[library_type]))
    delta = allowlist_delta(artifacts, current, library_type)
    return kept.select(*delta.columns).unionByName(delta)


def allowlist_payload(desired: DataFrame) -> DataFrame:
    """The whole list of each type as the text pieces of one JSON document.

    Piece 0 opens the document, piece 2 closes it, the entries stand in between by artifact and match
    type; only the first entry has no comma.  The document is never held in one row.
    """
    entry = F.struct("artifact", "match_type")
    known = F.col("artifact_type").isin(LIBRARY_TYPES[EVERY_TYPE])
    # The text that orders the entries also says which one is the first.
    item = F.concat_ws("\n", "artifact", "match_type")
    entries = desired.filter(known).select("artifact_type", entry.alias("entry"), item.alias("item")).distinct()
    firsts = entries.groupBy("artifact_type").agg(F.min("item").alias("first"))
    separator = F.when(F.col("item") == F.col("first"), "").otherwise(",")
    # One row per known type, so never more than two: the entries need not be moved for them.
    body = entries.join(F.broadcast(firsts), "artifact_type").select(
        "artifact_type",
        F.lit(1).alias("part"),
        "item",
        F.concat(separator, F.to_json("entry")).alias("output"),
    )
    edges = firsts.select("artifact_type").withColumn(
        "edge",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), F.lit('{"artifact_matchers":[').alias("output")),
                F.struct(F.lit(2).alias("part"), F.lit("]}").alias("output")),
            )
        ),
    )
    return body.unionByName(
        edges.select("artifact_type", "edge.part", F.lit("").alias("item"), "edge.output")
    )
