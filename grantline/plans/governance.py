"""Pipeline 1: which principal reaches which storage path."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from grantline.fixed import MIN_PATHS_PER_ROLE
from grantline.operators import access, policies as policy, principals as principal
from grantline.sinks.shared import stage
from grantline.sinks.tables import mark_run, run_of, save_table
from grantline.sources.policies import default_documents, parse_documents, statement_conditions
from grantline.sources.tables import read_table


@dataclass(frozen=True)
class PolicyExports:
    """Landed exports of the access-management side.

    profile_roles: profile_name, role_name; attached: role_name, policy_arn;
    policies: policy_arn, default_version_id; versions: policy_arn, version_id, document.
    """

    profile_roles: DataFrame
    attached: DataFrame
    policies: DataFrame
    versions: DataFrame

    def statements(self, audited: bool = False) -> DataFrame:
        return parse_documents(default_documents(self.policies, self.versions), audited)

    def conditions(self) -> DataFrame:
        return statement_conditions(default_documents(self.policies, self.versions))

    def path_lists(self, role_filter=None) -> DataFrame:
        attached = policy.filter_roles(self.attached, role_filter)
        return policy.role_path_lists(attached, self.statements())


@dataclass(frozen=True)
class Governance:
    """``access``: principal x profile x role; ``path_lists``: path lists per role and policy.

    The lists stand once per role.  On the rows of the principals they would be repeated for each
    principal of the role.
    """

    access: DataFrame
    path_lists: DataFrame


def public_principals(
    records: DataFrame, principal_type: str = "ALL", name_filter: str = ""
) -> DataFrame:
    """Principal records as the public relation, without repeats."""
    selected = principal.filter_by_type(records, principal_type)
    public = principal.project_principals(
        principal.dedupe_principals(principal.with_roles(selected))
    )
    return principal.filter_by_name(public, name_filter)


def save_governance(governance: Governance, access_table: str, lists_table: str, folder: str | None = None) -> None:
    """Save both relations as tables, in ``folder`` if one is given.

    Both are computed before a table is touched.  When both are written, they are marked with the run, the
    access table last: a pair that was left half written lacks the mark and is not loaded.
    """
    spark = governance.access.sparkSession
    staged = Governance(stage(governance.access), stage(governance.path_lists))
    save_table(staged.access, access_table, f"{folder}/access" if folder else None)
    save_table(staged.path_lists, lists_table, f"{folder}/path_lists" if folder else None)
    mark_run(spark, [lists_table, access_table], uuid.uuid4().hex)


def load_governance(spark: SparkSession, access_table: str, lists_table: str) -> Governance:
    """The pair that one run of ``save_governance`` wrote to the end."""
    runs = [run_of(spark, name) for name in (access_table, lists_table)]
    if runs[0] is None or runs[0] != runs[1]:
        raise ValueError(f"{access_table} and {lists_table} are not of one finished run")
    return Governance(read_table(spark, access_table), read_table(spark, lists_table))


def governance_export(
    records: DataFrame,
    exports: PolicyExports,
    principal_type: str = "ALL",
    name_filter: str = "",
    role_filter=None,
    min_paths: int = MIN_PATHS_PER_ROLE,
    staged: bool = False,
    lists_staged: bool = False,
) -> Governance:
    """``staged``: both relations, which later steps read repeatedly, are written once now.

    ``lists_staged`` does so with the path lists alone, for steps that read the access relation once.
    """
    profiles = principal.principal_profiles(public_principals(records, principal_type, name_filter))
    lists = exports.path_lists(role_filter)
    if staged or lists_staged:
        lists = stage(lists)
    counts = policy.role_path_counts(lists, min_paths)
    rows = access.governance(profiles, exports.profile_roles, counts)
    return Governance(stage(rows) if staged else rows, lists)
