"""Principals and the profiles they hold."""

from pyspark.sql import Column, DataFrame, functions as F

from grantline.fixed import PRINCIPAL_TYPES


def with_roles(records: DataFrame) -> DataFrame:
    return records.filter(F.col("roles.value").isNotNull())


def dedupe_principals(records: DataFrame) -> DataFrame:
    """One record per kind, name and id.

    Overlapping pages repeat whole records.  Should two records of one principal differ, the one with
    the smallest hash is taken, so that reruns agree.
    """
    key = ["principal_type", "displayName", "id"]
    rest = [c for c in records.columns if c not in key]
    # One exchange: the smallest of (hash, record) is found as the pages are brought together.
    chosen = records.groupBy(*key).agg(F.min(F.struct(F.xxhash64(*rest).alias("hash"), *rest)).alias("chosen"))
    return chosen.select(*key, *[F.col(f"chosen.{c}").alias(c) for c in rest])


def project_principals(records: DataFrame) -> DataFrame:
    """The public form of principal records."""
    return records.select(
        "principal_type",
        F.col("displayName").alias("principal_display_name"),
        F.col("id").alias("principal_id"),
        F.col("applicationId").alias("application_id"),
        primary_email(F.col("emails")).alias("email_value"),
        F.col("roles.value").alias("instance_profile_arns"),
    )


def primary_email(emails: Column) -> Column:
    """The first address, NULL without any."""
    return F.get(emails, F.lit(0))["value"]


def filter_by_name(principals: DataFrame, text: str) -> DataFrame:
    """Principals whose name holds the text; an empty text keeps all."""
    return principals.filter(F.col("principal_display_name").contains(text)) if text else principals


def filter_by_type(principals: DataFrame, principal_type: str = "ALL") -> DataFrame:
    if principal_type == "ALL":
        return principals
    if principal_type not in PRINCIPAL_TYPES:
        raise ValueError(f"principal type {principal_type!r} is none of ALL, {PRINCIPAL_TYPES}")
    return principals.filter(F.col("principal_type") == principal_type)


def principal_profiles(principals: DataFrame) -> DataFrame:
    """One row per principal and profile; principals without a profile disappear."""
    others = [c for c in principals.columns if c != "instance_profile_arns"]
    return principals.select(
        *others, F.explode("instance_profile_arns").alias("instance_profile_arn")
    )


def grantee() -> Column:
    """How a principal is named in a grant: e-mail, application id, or display name."""
    kind = F.col("principal_type")
    return (
        F.when((kind == "USER") & F.col("email_value").isNotNull(), F.col("email_value"))
        .when(
            (kind == "SERVICE_PRINCIPAL") & F.col("application_id").isNotNull(),
            F.col("application_id"),
        )
        .otherwise(F.col("principal_display_name"))
    )
