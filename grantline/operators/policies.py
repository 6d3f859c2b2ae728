"""Storage paths that roles reach through their policies."""

from pyspark.sql import Column, DataFrame, functions as F

from grantline.fixed import BUCKET_ARN_PREFIX, MIN_PATHS_PER_ROLE
from grantline.functions.paths import names_bucket, path_of_resource, path_pattern


def statement_resources(statements: DataFrame) -> DataFrame:
    """One row per resource of each statement of parsed documents; a NULL for a statement without."""
    others = [c for c in statements.columns if c not in ("readable", "statements")]
    fields = statements.schema["statements"].dataType.elementType.names
    return (
        statements.select(*others, F.explode("statements").alias("statement"))
        .select(
            *others, *[f"statement.{field}" for field in fields if field != "resources"],
            F.explode_outer("statement.resources").alias("resource"),
        )
    )


def policy_resources(statements: DataFrame) -> DataFrame:
    """One row per resource of each statement of parsed documents."""
    return statement_resources(statements).filter(F.col("resource").isNotNull())


def allowed(resources: DataFrame) -> DataFrame:
    return resources.filter(F.col("effect") == "Allow")


def bucket_paths(statements: DataFrame) -> DataFrame:
    """Per document the allowed bucket paths, in document order, with their patterns.

    Works inside the row of the document, so no path has to be shuffled to be listed.  The list is made by
    a generator: a filter on it would otherwise move down to the texts and parse each of them once more.
    """

    def paths_of(statement: Column) -> Column:
        return F.transform(F.filter(statement["resources"], names_bucket), path_of_resource)

    allow = F.filter(F.col("statements"), lambda s: s["effect"] == "Allow")
    others = [c for c in statements.columns if c not in ("readable", "statements")]
    listed = F.flatten(F.transform(allow, paths_of)).alias("s3_paths")
    paths = statements.select(*others, F.inline(F.array(F.struct(listed))))
    return paths.withColumn("s3_paths_regex", F.transform("s3_paths", path_pattern))


def filter_roles(attachments: DataFrame, role_names=None) -> DataFrame:
    """Only the given roles (a list, or a DataFrame with ``role_name``); nothing given keeps all."""
    if role_names is None or (not isinstance(role_names, DataFrame) and not role_names):
        return attachments
    if isinstance(role_names, DataFrame):
        return attachments.join(role_names, "role_name", "left_semi")
    return attachments.filter(F.col("role_name").isin(list(role_names)))


def role_path_lists(attached: DataFrame, statements: DataFrame) -> DataFrame:
    """Ordered path lists per role and attached policy."""
    return attached.join(bucket_paths(statements), "policy_arn").filter(F.size("s3_paths") > 0)


def role_path_counts(path_lists: DataFrame, min_paths: int = MIN_PATHS_PER_ROLE) -> DataFrame:
    """Roles with enough paths, and how many (repeats count)."""
    counts = path_lists.groupBy("role_name").agg(F.sum(F.size("s3_paths")).alias("n_paths"))
    return counts.filter(F.col("n_paths") >= min_paths)


def distinct_paths(path_lists: DataFrame) -> DataFrame:
    """One row per role and path.

    Made distinct before any join on the role: behind one, all paths of a role would already sit in
    one partition and be compared there.
    """
    return (
        path_lists.select("role_name", F.explode("s3_paths").alias("s3_path"))
        .distinct()
        .withColumn("s3_path_regex", path_pattern(F.col("s3_path")))
    )


def role_paths(path_lists: DataFrame, min_paths: int = MIN_PATHS_PER_ROLE) -> DataFrame:
    """Distinct paths of the roles with enough of them."""
    kept = role_path_counts(path_lists, min_paths).select("role_name")
    return distinct_paths(path_lists).join(kept, "role_name")


def dropped_resources(
    attached: DataFrame, statements: DataFrame, min_paths: int = MIN_PATHS_PER_ROLE
) -> DataFrame:
    """Audit: resources, documents and roles that lead to no path, and why.

    Two reasons are of resources that do lead to a path, though the statement gives less than full access:
    ``conditional`` (it has a condition) and ``action_limited`` (it names actions, but neither all of them nor
    all of storage); they need statements that were parsed as ``audited``.  ``no_document``: an attached policy without a default version's document; ``no_resource``: a
    statement that names no resource, for instance by ``NotResource``; its subject is the statement.
    """
    resource = F.col("resource")
    reason = (
        F.when(F.coalesce(F.col("effect") != "Allow", F.lit(True)), "not_allowed")
        .when(resource.isNull(), "no_resource")
        .when(~resource.startswith(BUCKET_ARN_PREFIX), "not_storage")
        .when(~names_bucket(resource), "inside_bucket")
    )
    subject = F.coalesce(resource, "sid", F.lit(""))
    less = F.filter(
        F.array(F.when(F.col("conditional"), "conditional"), F.when(F.col("limited"), "action_limited")), F.isnotnull
    )
    reasons = F.when(reason.isNull(), less).otherwise(F.array(reason))
    resources = attached.join(statement_resources(statements), "policy_arn").select(
        "role_name", "policy_arn", subject.alias("subject"), F.explode(reasons).alias("reason")
    )
    without = attached.join(statements, "policy_arn", "left_anti").select(
        "role_name", "policy_arn", F.lit("").alias("subject"), F.lit("no_document").alias("reason")
    )
    unreadable = attached.join(statements.filter(~F.col("readable")), "policy_arn").select(
        "role_name", "policy_arn", F.lit("").alias("subject"), F.lit("unreadable_document").alias("reason")
    )
    counted = role_path_counts(role_path_lists(attached, statements), 1)
    n_paths = F.coalesce("n_paths", F.lit(0))
    few = (
        attached.select("role_name").distinct().join(counted, "role_name", "left")
        .filter(n_paths < min_paths)
        .select(
            "role_name",
            F.lit("").alias("policy_arn"),
            n_paths.cast("string").alias("subject"),
            F.lit("too_few_paths").alias("reason"),
        )
    )
    return (
        resources.unionByName(without).unionByName(unreadable).unionByName(few)
    )
