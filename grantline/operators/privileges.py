"""From legacy grants to the new privileges per object and principal."""

from pyspark.sql import DataFrame, functions as F

from grantline.functions.privileges import PrivilegeSet, object_name, object_type

SUBJECT = ["catalog", "database", "table", "view"]
LISTS_PER_OBJECT = 16
GROUP = ["principal", "object_type", "object_name"]


def describe_objects(grants: DataFrame) -> DataFrame:
    """Add the type and the dotted name of the object each grant is on."""
    parts = [F.col(name) for name in SUBJECT]
    return grants.withColumns(
        {"object_type": object_type(*parts), "object_name": object_name(*parts)}
    )


def translate_grants(grants: DataFrame, privileges: PrivilegeSet | None = None) -> DataFrame:
    """Legacy grants with their object and the (masked) new privileges of the single row."""
    privileges = privileges or PrivilegeSet()
    described = describe_objects(grants)
    mapped = described.select("*", *privileges.of_action("action_type"))
    others = [c for c in mapped.columns if c not in privileges.columns]
    return mapped.select(*others, *privileges.allowed_on("object_type"))


def principal_object_privileges(
    grants: DataFrame, privileges: PrivilegeSet | None = None
) -> DataFrame:
    """One row per principal and object: distinct new and legacy privileges.

    ``privileges`` is an array, ``privilege_list`` the same as ``["A","B"]``.
    Grants without a principal cannot be given to anybody and are left out (the audit counts them).
    """
    privileges = privileges or PrivilegeSet()
    return (
        translate_grants(grants, privileges)
        .filter(F.col("principal").isNotNull())
        .groupBy(*GROUP)
        .agg(
            *privileges.union(),
            F.sort_array(F.collect_set("action_type")).alias("legacy_privileges"),
        )
        .select(
            *GROUP,
            privileges.names().alias("privileges"),
            privileges.quoted().alias("privilege_list"),
            "legacy_privileges",
            privileges.not_empty().alias("has_privileges"),
        )
    )


def grantable(grants: DataFrame, privileges: PrivilegeSet | None = None) -> DataFrame:
    """Principal-object rows that lead to a grant: known object type, at least one privilege."""
    return principal_object_privileges(grants, privileges).filter(
        (F.col("object_type") != "UNKNOWN") & F.col("has_privileges")
    )


def object_grants(
    grants: DataFrame, privileges: PrivilegeSet | None = None, n_lists: int = LISTS_PER_OBJECT
) -> DataFrame:
    """Parallel lists of principals, privileges and legacy privileges per object.

    An object may have any number of principals, so its lists are always split by a hash of the
    principal into ``n_lists`` parts: give as many as keep a part of the largest object small.  Parts
    without an entry have no row.  No row or task holds all principals of one object: the parts are
    spread before they are collected.
    """
    key = ["object_type", "object_name"]
    digest = F.conv(F.substring(F.md5(F.col("principal")), 1, 8), 16, 10).cast("bigint")
    entry = F.struct("principal", "privileges", "legacy_privileges")
    return (
        grantable(grants, privileges)
        .withColumn("list_no", F.pmod(digest, F.lit(n_lists)))
        .repartition(*key, "list_no")
        .groupBy(*key, "list_no")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(
            *key,
            "list_no",
            F.col("entries.principal").alias("principals"),
            F.col("entries.privileges").alias("privileges"),
            F.col("entries.legacy_privileges").alias("legacy_privileges"),
        )
    )


def dominant_object_type(grants: DataFrame) -> DataFrame:
    """Most frequent type among the principals' entries of a name; ties go to the first in order."""
    entries = (
        describe_objects(grants)
        .filter(F.col("principal").isNotNull())
        .select("principal", "object_type", "object_name")
        .distinct()
    )
    return entries.groupBy("object_name").agg(F.mode("object_type", True).alias("object_type"))


def unmapped_privileges(grants: DataFrame, privileges: PrivilegeSet | None = None) -> DataFrame:
    """Audit: legacy privileges that lead to no grant, why, and in how many rows."""
    privileges = privileges or PrivilegeSet()
    reason = (
        F.when(F.col("principal").isNull(), "no_principal")
        .when(F.col("object_type") == "UNKNOWN", "unknown_object")
        .when(~privileges.is_mapped("action_type"), "unmapped")
        .when(~privileges.not_empty(), "not_allowed_on_type")
    )
    return (
        translate_grants(grants, privileges)
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .groupBy("action_type", "object_type", "reason")
        .agg(F.count("*").alias("n_rows"))
    )
