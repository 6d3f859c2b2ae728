"""Audit outputs that belong to no single operator."""

from pyspark.sql import DataFrame, functions as F

from grantline.functions.paths import profile_name
from grantline.functions.text import label
from grantline.operators import documents


def label_collisions(names: DataFrame) -> DataFrame:
    """Names that get the same label, hence the same block address.

    Different names of one ``kind`` count, and so do equal ones of different ``owner``s, such as the
    principals behind one display name.
    """
    return (
        names.select("kind", "name", "owner")
        .distinct()
        .withColumn("label", label(F.col("name")))
        .groupBy("kind", "label")
        .agg(
            F.count("*").alias("n_names"),
            F.min("name").alias("first_name"),
            F.max("name").alias("last_name"),
        )
        .filter(F.col("n_names") > 1)
    )


def block_counts(rows: DataFrame, kind: str) -> DataFrame:
    """Of the rows of one kind of block, how many give a block and how many do not."""
    whole = F.lit(True)
    for column in documents.NEEDED[kind]:
        whole = whole & F.col(column).isNotNull()
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_if(whole).alias("n_blocks"), F.count_if(~whole).alias("n_rejected")
    ).select(F.lit(kind).alias("kind"), "n_rows", "n_blocks", "n_rejected")


def profile_arns(profiles: DataFrame) -> DataFrame:
    """Profile ARNs in use with the name read from them; NULL where the ARN is not valid."""
    return (
        profiles.groupBy("instance_profile_arn")
        .agg(F.count("*").alias("n_holders"))
        .withColumn("profile_name", profile_name(F.col("instance_profile_arn")))
    )
