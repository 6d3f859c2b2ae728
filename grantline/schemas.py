"""Schemas of the landed exports and of the relations the library hands out."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# The reference cell of an identity record: e-mails and roles share it.
MEMBER = _strings("$ref", "value", "display", "primary", "type")

PRINCIPAL = T.StructType(
    [
        T.StructField("displayName", T.StringType(), True, {"comment": "Display name"}),
        T.StructField("emails", T.ArrayType(MEMBER), True, {"comment": "E-mail addresses"}),
        T.StructField("id", T.StringType(), True, {"comment": "Identity id"}),
        T.StructField("roles", T.ArrayType(MEMBER), True, {"comment": "Instance profiles"}),
        T.StructField("applicationId", T.StringType(), True, {"comment": "Application id"}),
    ]
)

INSTANCE_PROFILE = T.StructType(
    [
        T.StructField(
            "InstanceProfile",
            T.StructType([T.StructField("Roles", T.ArrayType(_strings("RoleName")))]),
        )
    ]
)

EXTERNAL_LOCATION = T.StructType(
    [
        T.StructField(name, T.StringType(), False)
        for name in ("name", "credential_name", "credential_id", "url")
    ]
)

BUCKET_MAP = _strings("s3_bucket_url", "catalog_name", "schema_name")

LEGACY_GRANT = _strings("principal", "action_type", "catalog", "database", "table", "view")

LIBRARY = T.StructType(
    [
        T.StructField("jar", T.StringType()),
        T.StructField("maven", _strings("coordinates")),
    ]
)

CLUSTER_LIBRARIES = T.StructType(
    [
        T.StructField("cluster_id", T.StringType()),
        T.StructField("libraries", T.ArrayType(LIBRARY)),
    ]
)

ALLOWLIST = T.StructType(
    [T.StructField("artifact_matchers", T.ArrayType(_strings("artifact", "match_type")))]
)

# Every document is a relation of text pieces with an explicit order.
DOCUMENT_ORDER = ["section", "label", "block", "part", "item"]
