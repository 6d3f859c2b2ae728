"""Pipeline 4: object grants out of legacy privileges."""

from pyspark.sql import DataFrame

from grantline.functions.privileges import PrivilegeSet
from grantline.operators import documents, privileges
from grantline.sinks.shared import stage


def acl_document(grants: DataFrame, mapping: dict[str, list[str]] | None = None) -> DataFrame:
    rows = stage(privileges.grantable(grants, PrivilegeSet(mapping)))
    return documents.assemble(documents.object_grant_blocks(rows, object_addresses(rows)))


def object_addresses(grantable: DataFrame) -> DataFrame:
    """Addresses of the objects of staged grants."""
    return documents.object_addresses(stage(grantable.select(*documents.OBJECT).distinct()))
