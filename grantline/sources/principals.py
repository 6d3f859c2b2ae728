"""Identity exports: one JSON record per principal, pages that may overlap."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantline.fixed import PRINCIPAL_TYPES
from grantline.schemas import PRINCIPAL
from grantline.sources.tables import Landed, landed, parse_landed

#: A record without one of these names nobody.
NEEDED = ("id",)


def tag_principals(records: DataFrame, principal_type: str) -> DataFrame:
    """Mark the records of one kind of principal."""
    if principal_type not in PRINCIPAL_TYPES:
        raise ValueError(f"principal type {principal_type!r} is none of {PRINCIPAL_TYPES}")
    return records.withColumn("principal_type", F.lit(principal_type))


def landed_principals(spark: SparkSession, path: str, principal_type: str) -> Landed:
    """Landed page exports of one kind: records, rejected lines and unknown fields."""
    return _tagged(landed(spark, path, PRINCIPAL, NEEDED), principal_type)


def read_principals(spark: SparkSession, path: str, principal_type: str) -> DataFrame:
    """The records of landed page exports of one kind, read with the fixed schema."""
    return landed_principals(spark, path, principal_type).records


def parse_principals(lines: DataFrame, column: str, principal_type: str) -> DataFrame:
    """The same from a column of JSON records."""
    return _tagged(parse_landed(lines.select(column), column, PRINCIPAL, NEEDED), principal_type).records


def _tagged(found: Landed, principal_type: str) -> Landed:
    return Landed(*[tag_principals(rows, principal_type) for rows in (found.records, found.rejected, found.drift)])


def all_principals(*kinds: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, kinds)
