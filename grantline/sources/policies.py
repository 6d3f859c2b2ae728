"""Instance profiles, roles and policy documents."""

from pyspark.sql import DataFrame, functions as F

from grantline.schemas import INSTANCE_PROFILE
from grantline.sources.tables import Landed, parse_landed


def landed_profiles(profiles: DataFrame) -> Landed:
    """``profile_name, document`` rows: documents, rejected ones and unknown fields."""
    return parse_landed(profiles.select("profile_name", "document"), "document", INSTANCE_PROFILE, ("InstanceProfile",))


def profile_roles(profiles: DataFrame) -> DataFrame:
    """Roles per profile from ``profile_name, document`` rows."""
    return (
        landed_profiles(profiles).records
        .select("profile_name", F.explode("InstanceProfile.Roles").alias("role"))
        .select("profile_name", F.col("role.RoleName").alias("role_name"))
        .filter(F.col("role_name").isNotNull())
        .distinct()
    )


def default_documents(policies: DataFrame, versions: DataFrame) -> DataFrame:
    """The default version's document of each policy.

    ``policies``: policy_arn, default_version_id; ``versions``: policy_arn, version_id, document.
    """
    default = policies.withColumnRenamed("default_version_id", "version_id")
    return default.join(versions, ["policy_arn", "version_id"])


# A field that is one text or a list of texts, as a list.
_LIST = """coalesce(try_variant_get(s, '$.{0}', 'array<string>'),
                     array_compact(array(try_variant_get(s, '$.{0}', 'string'))))"""

# The statements of a parsed document, which are one object or a list, as a list.
_OBJECTS = """
    array_compact(coalesce(
      try_variant_get(parsed, '$.Statement', 'array<variant>'),
      array(try_variant_get(parsed, '$.Statement', 'variant'))))"""

_FIELDS = f"""
        'sid', try_variant_get(s, '$.Sid', 'string'),
        'effect', try_variant_get(s, '$.Effect', 'string'),
        'resources', {_LIST.format('Resource')}"""

# What an audit reads as well.  ``limited``: the statement names actions, of which none is all of them or
# all of storage.
_AUDITED = f"""
        'conditional', coalesce(try_variant_get(s, '$.Condition', 'variant'), parse_json('{{}}'))::string <> '{{}}',
        'limited', try_variant_get(s, '$.NotAction', 'variant') IS NOT NULL
                   OR (try_variant_get(s, '$.Action', 'variant') IS NOT NULL
                       AND NOT exists({_LIST.format('Action')}, a -> a IN ('*', 's3:*')))"""


def landed_profiles(profiles: DataFrame) -> Landed:
    """``profile_name, document`` rows: documents, rejected ones and unknown fields."""
    return parse_landed(profiles.select("profile_name", "document"), "document", INSTANCE_PROFILE, ("InstanceProfile",))


def profile_roles(profiles: DataFrame) -> DataFrame:
    """Roles per profile from ``profile_name, document`` rows."""
    return (
        landed_profiles(profiles).records
        .select("profile_name", F.explode("InstanceProfile.Roles").alias("role"))
        .select("profile_name", F.col("role.RoleName").alias("role_name"))
        .filter(F.col("role_name").isNotNull())
        .distinct()
    )


def default_documents(policies: DataFrame, versions: DataFrame) -> DataFrame:
    """The default version's document of each policy.

    ``policies``: policy_arn, default_version_id; ``versions``: policy_arn, version_id, document.
    """
    default = policies.withColumnRenamed("default_version_id", "version_id")
    return default.join(versions, ["policy_arn", "version_id"])


# A field that is one text or a list of texts, as a list.
_LIST = """coalesce(try_variant_get(s, '$.{0}', 'array<string>'),
                     array_compact(array(try_variant_get(s, '$.{0}', 'string'))))"""

# The statements of a parsed document, which are one object or a list, as a list.
_OBJECTS = """
    array_compact(coalesce(
      try_variant_get(parsed, '$.Statement', 'array<variant>'),
      array(try_variant_get(parsed, '$.Statement', 'variant'))))"""

# ``limited``: the statement names actions, of which none is all of them or all of storage.
_STATEMENTS = f"""
    transform({_OBJECTS},
      s -> named_struct(
        'sid', try_variant_get(s, '$.Sid', 'string'),
        'effect', try_variant_get(s, '$.Effect', 'string'),
        'resources', {_LIST.format('Resource')},
        'conditional', coalesce(try_variant_get(s, '$.Condition', 'variant'), parse_json('{{}}'))::string <> '{{}}',
        'limited', try_variant_get(s, '$.NotAction', 'variant') IS NOT NULL
                   OR (try_variant_get(s, '$.Action', 'variant') IS NOT NULL
                       AND NOT exists({_LIST.format('Action')}, a -> a IN ('*', 's3:*')))))"""


def parse_documents(documents: DataFrame, audited: bool = False) -> DataFrame:
    """Replace the JSON text of policy documents by ``readable`` and ``statements``.

    A text that is no JSON has no statements; the audit reports it.  ``audited`` statements also say whether
    they are ``conditional`` and ``limited`` to some actions.
    """
    others = [c for c in documents.columns if c != "document"]
    parsed = documents.select(*others, F.try_parse_json("document").alias("parsed"))
    fields = f"{_FIELDS},{_AUDITED}" if audited else _FIELDS
    return parsed.select(
        *others,
        F.col("parsed").isNotNull().alias("readable"),
        F.expr(f"transform({_OBJECTS}, s -> named_struct({fields}))").alias("statements"),
    )


def statement_conditions(documents: DataFrame) -> DataFrame:
    """One row per condition of each statement: operator, key and the values that it is compared with.

    The names of operators and keys are open, so they are read off the statement itself; a condition
    that has another form than operator, key and values is one row with its text.  Statements keep their
    place in the document as ``statement_no``.
    """
    spark = documents.sparkSession
    others = [c for c in documents.columns if c != "document"]
    parsed = documents.select(*others, F.try_parse_json("document").alias("parsed"))
    statements = parsed.select(*others, F.posexplode(F.expr(_OBJECTS)).alias("statement_no", "s")).select(
        *others, "statement_no",
        F.expr("try_variant_get(s, '$.Sid', 'string')").alias("sid"),
        F.expr("try_variant_get(s, '$.Effect', 'string')").alias("effect"),
        F.expr("try_variant_get(s, '$.Condition', 'variant')").alias("condition"),
    )
    given = statements.filter("condition IS NOT NULL AND condition::string <> '{}'")
    # A list gives a row per element, without a key: one of them stands for it.
    one = "key IS NOT NULL OR coalesce(pos, 0) = 0"
    operators = given.lateralJoin(spark.tvf.variant_explode_outer(F.col("condition").outer())).filter(one).select(
        *statements.columns, F.col("key").alias("operator"), F.col("value").alias("compared")
    )
    keys = operators.lateralJoin(spark.tvf.variant_explode_outer(F.col("compared").outer())).filter(one)
    values = F.expr(
        "coalesce(try_variant_get(value, '$', 'array<string>'), array(try_variant_get(value, '$', 'string')))"
    )
    operator, key = F.col("operator"), F.col("key")
    text = F.when(operator.isNull(), F.array(F.col("condition").cast("string"))).otherwise(F.array(F.col("compared").cast("string")))
    return keys.select(
        *others, "statement_no", "sid", "effect", "operator",
        F.when(operator.isNotNull(), key).alias("condition_key"),
        F.when(operator.isNotNull() & key.isNotNull(), values).otherwise(text).alias("condition_values"),
    )
