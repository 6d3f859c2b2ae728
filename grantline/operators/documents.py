"""Rendering of result relations as text documents.

A document is a relation of text pieces: ``section, label, block, part, item`` give the order and
``output`` the text.  ``label`` and ``block`` keep the pieces of one block together, ``part`` and
``item`` order them inside the block.  A block with unbounded content (all grants of an object) is
thus many small rows and never one large one.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantline import fixed
from grantline.functions.text import escape, label, render
from grantline.operators.addresses import unique_labels

HEADER_SECTION = 0
OBJECT = ["object_type", "object_name"]
VOLUME = ["ext_loc_label", "volume_label", "volume", "catalog_name", "schema_name", "s3_bucket_url"]


def _piece(
    rows: DataFrame,
    section: Column | int,
    block_label: Column,
    block: Column,
    output: Column,
    part: int = 0,
    item: Column | None = None,
) -> DataFrame:
    return rows.select(
        (section if isinstance(section, Column) else F.lit(section)).alias("section"),
        block_label.alias("label"),
        block.alias("block"),
        F.lit(part).alias("part"),
        (F.lit("") if item is None else item).alias("item"),
        output.alias("output"),
    )


def header(spark: SparkSession) -> DataFrame:
    columns = "section int, label string, block string, part int, item string, output string"
    return spark.createDataFrame([(HEADER_SECTION, "", "", 0, "", fixed.DOCUMENT_HEADER)], columns)


def assemble(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The header followed by the given sections."""
    document = header(first.sparkSession)
    for pieces in (first, *others):
        document = document.unionByName(pieces)
    return document


#: The fields without which a row gives no block; a missing one would blank the whole text.
NEEDED = {
    "location": ["ext_loc_name", "url", "credential_name"],
    "registered_location": ["ext_loc_name"],
    "location_grant": ["principal_display_name", "grantee", "ext_loc_name"],
    "volume": VOLUME,
}


def _complete(rows: DataFrame, kind: str) -> DataFrame:
    return rows.na.drop(subset=NEEDED[kind])


def incomplete(rows: DataFrame, kind: str) -> DataFrame:
    """The rows that give no block: ``kind``, ``subject`` (what is there of the needed fields) and ``missing``.

    Rows and blocks are split by the same list of fields, so each row is on one side.
    """
    needed = NEEDED[kind]
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), c) for c in needed])
    there = F.concat_ws("/", *needed)
    return rows.select(F.lit(kind).alias("kind"), there.alias("subject"), missing.alias("missing")).filter(F.col("missing") != "")


def location_resources(locations: DataFrame, labels: DataFrame, section: int = 1) -> DataFrame:
    """Blocks that create the locations that do not exist yet; ``labels`` are those of the grants."""
    rows = _complete(locations.filter(~F.col("created")), "location").select(
        "ext_loc_name", "created", "url", "credential_name"
    ).distinct().join(labels, ["ext_loc_name", "created"])
    name = F.col("ext_loc_name")
    output = render(
        fixed.LOCATION_RESOURCE,
        label=F.col("ext_loc_label"),
        name=escape(name),
        url=escape(F.col("url")),
        credential=escape(F.col("credential_name")),
    )
    return _piece(rows, section, F.col("ext_loc_label"), F.concat_ws("\n", name, "url"), output)


def location_data_sources(locations: DataFrame, labels: DataFrame, section: int = 2) -> DataFrame:
    """Blocks that refer to the locations that exist."""
    rows = _complete(locations.filter("created"), "registered_location").select("ext_loc_name", "created").distinct()
    rows = rows.join(labels, ["ext_loc_name", "created"])
    name = F.col("ext_loc_name")
    output = render(fixed.LOCATION_DATA_SOURCE, label=F.col("ext_loc_label"), name=escape(name))
    return _piece(rows, section, F.col("ext_loc_label"), name, output)


def location_grant_blocks(grants: DataFrame, section: int = 3) -> DataFrame:
    """One grant block per grantee and location; ``grants`` has no duplicates."""
    rows = _complete(grants, "location_grant")
    grantee_label, location_label = F.col("principal_label"), F.col("ext_loc_label")
    output = render(
        fixed.LOCATION_GRANT,
        principal_label=grantee_label,
        label=location_label,
        reference=F.when(F.col("created"), "data.").otherwise(""),
        principal=F.col("grantee_text"),
    )
    block = F.concat_ws("\n", "principal_display_name", "grantee", "ext_loc_name")
    return _piece(rows, section, F.concat_ws("_", grantee_label, location_label), block, output)


def volume_addresses(volumes: DataFrame) -> DataFrame:
    """Distinct volumes with an ``address`` each."""
    # Spread over all columns first: the rows of one bucket may share a partition after its joins.
    rows = _complete(volumes, "volume").select(*VOLUME).repartition(*VOLUME).distinct()
    return unique_labels(rows, VOLUME, F.concat_ws("_", "ext_loc_label", "volume_label"), "address")


def volume_blocks(addressed: DataFrame, section: int = 1) -> DataFrame:
    """Blocks of volumes with their addresses."""
    output = render(
        fixed.VOLUME_RESOURCE,
        address=F.col("address"),
        volume_label=F.col("volume_label"),
        catalog=escape(F.col("catalog_name")),
        schema=escape(F.col("schema_name")),
        bucket_url=escape(F.col("s3_bucket_url")),
        folder=escape(F.col("volume")),
    )
    block = F.concat_ws("\n", "s3_bucket_url", "volume", "catalog_name", "schema_name")
    return _piece(addressed, section, F.col("address"), block, output)


def object_addresses(grants: DataFrame) -> DataFrame:
    """The objects of grants with an ``address`` each."""
    plain = F.concat_ws("_", F.lower("object_type"), label(F.col("object_name")))
    return unique_labels(grants.select(*OBJECT).distinct(), OBJECT, plain, "address")


def object_grant_blocks(grants: DataFrame, addressed: DataFrame, first_section: int = 1) -> DataFrame:
    """Grant blocks of catalogs, schemas and tables, in this order.

    ``grants`` has one row per principal and object (see ``grantable``), ``addressed`` one per object.  Each
    object gives one opening and one closing piece, each grant a piece in between.  Only the opening has the
    address; pieces are in the order of the plain label and the name, so grants need no join.
    """
    name, kind = F.col("object_name"), F.col("object_type")
    section = F.array_position(F.array(*map(F.lit, ["CATALOG", "SCHEMA", "TABLE"])), kind)
    section = (section + (first_section - 1)).cast("int")
    object_label = label(name)
    opening = render(
        fixed.OBJECT_GRANTS_OPENING, kind=F.lower(kind), address=F.col("address"), name=escape(name)
    )
    grant = render(
        fixed.OBJECT_GRANT,
        principal=escape(F.col("principal")),
        privileges=F.col("privilege_list"),
    )
    edges = addressed.withColumn(
        "edge",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), opening.alias("output")),
                F.struct(F.lit(2).alias("part"), render(fixed.OBJECT_GRANTS_CLOSING).alias("output")),
            )
        ),
    ).select(
        section.alias("section"),
        object_label.alias("label"),
        name.alias("block"),
        "edge.part",
        F.lit("").alias("item"),
        "edge.output",
    )
    pieces = _piece(grants, section, object_label, name, grant, 1, F.col("principal"))
    return edges.unionByName(pieces)
