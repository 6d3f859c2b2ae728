"""The registered queries: every operator and pipeline on the relations of ``fixtures``.

Each entry takes a session and the folder of the test tables and returns a DataFrame of plain
columns; arrays are joined to texts, so that results can be compared by value.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantline.fixtures import Fixtures
from grantline.functions.paths import bucket_pattern
from grantline.functions.privileges import PrivilegeSet
from grantline.functions.text import label
from grantline.operators import (
    access,
    allowlist,
    audit,
    documents,
    policies,
    principals,
    privileges,
    volumes,
)
from grantline.plans.allowlist import allowlist_update
from grantline.plans.governance import (
    Governance,
    governance_export,
    load_governance,
    public_principals,
    save_governance,
)
from grantline.plans.locations import (
    LocationLabels,
    LocationPlan,
    grant_labels,
    location_document,
    plan_locations,
)
from grantline.plans.privileges import acl_document, object_addresses
from grantline.plans.volumes import volume_document
from grantline.sinks.shared import shared_folder, stage
from grantline.sinks.tables import merge_table, row_counts
from grantline.sinks.text import numbered_lines, write_document
from grantline.sources.policies import landed_profiles
from grantline.sources.principals import all_principals, landed_principals, read_principals
from grantline.sources.storage import first_level_folders
from grantline.sources.tables import Landed, query_table

Query = Callable[[SparkSession, str], DataFrame]

CREDENTIAL = "new_credential"
DEFAULT_CATALOG, DEFAULT_SCHEMA = "main", "landing"
ANY_LIBRARY = "jar/maven"

_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register a query under the function's name; a trailing ``_`` avoids a clash with a module."""
    name = build.__name__.rstrip("_")
    _QUERIES[name] = lambda spark, sf_dir: build(Fixtures(spark, sf_dir))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _joined(values: Column | str, name: str, separator: str = ",") -> Column:
    return F.array_join(values, separator).alias(name)


# --- principals ----------------------------------------------------------------------------------
def _public(rows: DataFrame) -> DataFrame:
    return rows.select(
        "principal_type",
        "principal_display_name",
        "principal_id",
        "application_id",
        "email_value",
        _joined("instance_profile_arns", "profiles"),
    )


@_query
def principals_ingest(fx: Fixtures) -> DataFrame:
    folder = shared_folder(fx.spark)
    kinds = []
    for kind in ("USER", "SERVICE_PRINCIPAL", "GROUP"):
        fx.principal_records(kind).write.json(f"{folder}/{kind}")
        kinds.append(read_principals(fx.spark, f"{folder}/{kind}", kind))
    rows = principals.project_principals(principals.with_roles(all_principals(*kinds)))
    n_profiles = F.size(F.split("profiles", ",")).cast("bigint")
    return _public(rows).withColumn("n_profiles", n_profiles)


def _landed(fx: Fixtures) -> list[Landed]:
    folder = shared_folder(fx.spark)
    kinds = ("USER", "SERVICE_PRINCIPAL", "GROUP")
    for kind in kinds:
        fx.principal_lines(kind).write.text(f"{folder}/{kind}")
    return [landed_principals(fx.spark, f"{folder}/{kind}", kind) for kind in kinds]


@_query
def rejected_records(fx: Fixtures) -> DataFrame:
    people = all_principals(*[found.rejected for found in _landed(fx)])
    profiles = landed_profiles(fx.profile_lines()).rejected.withColumn("principal_type", F.lit("PROFILE"))
    return people.unionByName(profiles.drop("profile_name")).select(F.col("principal_type").alias("kind"), "reason", "line")


@_query
def landed_counts(fx: Fixtures) -> DataFrame:
    found = _landed(fx)
    kept = all_principals(*[kind.records.select("principal_type", F.lit(1).alias("kept")) for kind in found])
    rejected = all_principals(*[kind.rejected.select("principal_type", F.lit(0).alias("kept")) for kind in found])
    return kept.unionByName(rejected).groupBy("principal_type").agg(
        F.count("*").alias("n_lines"), F.sum("kept").alias("n_kept"), F.sum(1 - F.col("kept")).alias("n_rejected")
    )


@_query
def schema_drift(fx: Fixtures) -> DataFrame:
    return all_principals(*[found.drift for found in _landed(fx)])


@_query
def principals_dedupe(fx: Fixtures) -> DataFrame:
    return principals.dedupe_principals(principals.with_roles(fx.principals())).select(
        "principal_type",
        F.col("displayName").alias("principal_display_name"),
        F.col("id").alias("principal_id"),
        F.size("roles").cast("bigint").alias("n_profiles"),
    )


@_query
def principals_all(fx: Fixtures) -> DataFrame:
    return _public(public_principals(fx.principals()))


@_query
def principals_by_type(fx: Fixtures) -> DataFrame:
    return _public(public_principals(fx.principals(), principal_type="SERVICE_PRINCIPAL"))


@_query
def principals_name_filter(fx: Fixtures) -> DataFrame:
    return _public(public_principals(fx.principals(), name_filter="er#0000"))


@_query
def principal_primary_email(fx: Fixtures) -> DataFrame:
    return public_principals(fx.principals()).select("principal_type", "principal_id", "email_value")


def _profiles(fx: Fixtures) -> DataFrame:
    return principals.principal_profiles(public_principals(fx.principals()))


@_query
def principal_profiles(fx: Fixtures) -> DataFrame:
    return _profiles(fx).select(
        "principal_type", "principal_display_name", "principal_id", "instance_profile_arn"
    )


@_query
def profile_arn_parse(fx: Fixtures) -> DataFrame:
    return audit.profile_arns(_profiles(fx))


# --- policies ------------------------------------------------------------------------------------
@_query
def profile_roles(fx: Fixtures) -> DataFrame:
    return fx.profile_roles()


@_query
def policy_default_version(fx: Fixtures) -> DataFrame:
    exports = fx.policy_exports()
    return exports.attached.join(exports.statements(), "policy_arn").select(
        "role_name", "policy_arn", "readable", F.size("statements").cast("bigint").alias("n_statements")
    )


@_query
def policy_resources(fx: Fixtures) -> DataFrame:
    exports = fx.policy_exports()
    rows = policies.allowed(policies.policy_resources(exports.statements()))
    return exports.attached.join(rows, "policy_arn").select(
        "role_name", "policy_arn", "sid", "effect", "resource"
    )


@_query
def s3_path_patterns(fx: Fixtures) -> DataFrame:
    paths = policies.bucket_paths(fx.policy_exports().statements())
    return (
        paths.select(F.explode(F.arrays_zip("s3_paths", "s3_paths_regex")).alias("path"))
        .groupBy(F.col("path.s3_paths").alias("s3_path"), F.col("path.s3_paths_regex").alias("s3_path_regex"))
        .agg(F.count("*").alias("n_entries"))
    )


@_query
def role_filter(fx: Fixtures) -> DataFrame:
    wanted = ["role-1", "role-4", "role-9", "role-16", "role-21"]
    return policies.role_path_counts(fx.policy_exports().path_lists(wanted))


@_query
def role_path_lists(fx: Fixtures) -> DataFrame:
    return _lists(fx.policy_exports().path_lists())


def _lists(path_lists: DataFrame) -> DataFrame:
    return path_lists.select(
        "role_name",
        "policy_arn",
        _joined("s3_paths", "s3_paths", "|"),
        _joined("s3_paths_regex", "s3_paths_regex", "|"),
    )


@_query
def role_path_counts(fx: Fixtures) -> DataFrame:
    return policies.role_path_counts(fx.policy_exports().path_lists())


@_query
def role_paths(fx: Fixtures) -> DataFrame:
    return policies.role_paths(fx.policy_exports().path_lists())


@_query
def dropped_resources(fx: Fixtures) -> DataFrame:
    exports = fx.policy_exports()
    return policies.dropped_resources(exports.attached, stage(exports.statements(audited=True)))


@_query
def statement_conditions(fx: Fixtures) -> DataFrame:
    return fx.policy_exports().conditions().select(
        "policy_arn", F.col("statement_no").cast("bigint").alias("statement_no"), "sid", "effect", "operator", "condition_key",
        _joined("condition_values", "condition_values"),
    )


# --- access --------------------------------------------------------------------------------------
def _governance(fx: Fixtures, staged: bool = False) -> Governance:
    return governance_export(fx.principals(), fx.policy_exports(), staged=staged)


def _saved(fx: Fixtures) -> Governance:
    """For queries that read the access relation more than once."""
    return _governance(fx, staged=True)


def _patterns(fx: Fixtures) -> DataFrame:
    governance = governance_export(fx.principals(), fx.policy_exports(), lists_staged=True)
    return access.governance_patterns(governance.access, governance.path_lists)


def _plan(fx: Fixtures, governance: Governance, **options) -> LocationPlan:
    return plan_locations(governance, fx.locations(), **options)


def _plan_with_new(fx: Fixtures, governance: Governance) -> LocationPlan:
    return _plan(fx, governance, buckets=fx.buckets(), create_new=True, credential_name=CREDENTIAL)


@_query
def governance_export_(fx: Fixtures) -> DataFrame:
    return _governance(fx).access


@_query
def governance_roundtrip(fx: Fixtures) -> DataFrame:
    return query_table(fx.spark, _saved_tables(fx)[0])


def _saved_tables(fx: Fixtures) -> tuple[str, str]:
    folder = shared_folder(fx.spark)
    run = folder.rsplit("/", 1)[-1]
    names = f"spark_catalog.default.access_{run}", f"spark_catalog.default.path_lists_{run}"
    save_governance(_governance(fx), *names, folder)
    return names


@_query
def governance_schema_merge(fx: Fixtures) -> DataFrame:
    """A table of an earlier run, with a column of its own, and a later run for one kind of principal."""
    folder = shared_folder(fx.spark)
    name = f"spark_catalog.default.merged_{folder.rsplit('/', 1)[-1]}"
    rows = _governance(fx).access
    merge_table(rows.withColumn("reviewed", F.lit("yes")), name, "principal_type", folder)
    later = rows.filter("principal_type = 'USER'").withColumn("batch", F.lit(2))
    merge_table(later, name, "principal_type")
    return query_table(fx.spark, name)


@_query
def governance_lists_roundtrip(fx: Fixtures) -> DataFrame:
    return _lists(load_governance(fx.spark, *_saved_tables(fx)).path_lists)


@_query
def saved_location_document(fx: Fixtures) -> DataFrame:
    return location_document(
        load_governance(fx.spark, *_saved_tables(fx)), fx.locations(), fx.buckets(), create_new=True,
        credential_name=CREDENTIAL,
    )


@_query
def governance_patterns(fx: Fixtures) -> DataFrame:
    return _patterns(fx)


@_query
def unsearchable_paths(fx: Fixtures) -> DataFrame:
    return access.unsearchable_paths(_patterns(fx))


@_query
def bucket_regex(fx: Fixtures) -> DataFrame:
    pattern = F.col("s3_path_regex")
    return _patterns(fx).select(pattern, bucket_pattern(pattern).alias("bucket_regex")).distinct()


def _access(fx: Fixtures, anchored: bool, governance: Governance | None = None) -> DataFrame:
    governance = governance or _saved(fx)
    role_locations = stage(_plan(fx, governance, anchored=anchored).role_locations)
    return access.location_access(governance.access, role_locations).select(
        "principal_type", "principal_id", "principal_display_name", "ext_loc_name", "url"
    )


@_query
def location_access(fx: Fixtures) -> DataFrame:
    return _access(fx, anchored=False)


@_query
def location_access_anchored(fx: Fixtures) -> DataFrame:
    return _access(fx, anchored=True)


def _by_supplier(fx: Fixtures) -> Governance:
    return governance_export(fx.supplier_principals(), fx.supplier_exports(), staged=True)


@_query
def location_access_diverse(fx: Fixtures) -> DataFrame:
    """Roles grow with the suppliers, and nearly every principal has a role set of its own."""
    return _access(fx, anchored=False, governance=_by_supplier(fx))


@_query
def location_grants_diverse(fx: Fixtures) -> DataFrame:
    governance = _by_supplier(fx)
    role_locations = stage(_plan(fx, governance).role_locations)
    labels = grant_labels(governance, role_locations)
    grants = access.location_grants(governance.access, role_locations, labels.grantees, labels.locations)
    return grants.select("principal_display_name", "grantee", "ext_loc_name", "created")


def _uncovered(fx: Fixtures) -> DataFrame:
    # Patterns are read for their keys, for the keys in question and for the search.
    return access.unregistered_patterns(stage(_patterns(fx)), fx.locations())


@_query
def uncovered_patterns(fx: Fixtures) -> DataFrame:
    return _uncovered(fx)


@_query
def new_location_proposals(fx: Fixtures) -> DataFrame:
    return access.new_locations(access.proposed_locations(stage(_uncovered(fx)), fx.buckets(), CREDENTIAL))


@_query
def all_locations(fx: Fixtures) -> DataFrame:
    return _plan_with_new(fx, _governance(fx)).locations


def _labelled_locations(fx: Fixtures) -> tuple[Governance, DataFrame, LocationLabels]:
    governance = _saved(fx)
    role_locations = stage(_plan_with_new(fx, governance).role_locations)
    return governance, role_locations, grant_labels(governance, role_locations)


def _grants(fx: Fixtures) -> DataFrame:
    governance, role_locations, labels = _labelled_locations(fx)
    return access.location_grants(governance.access, role_locations, labels.grantees, labels.locations)


@_query
def location_grants(fx: Fixtures) -> DataFrame:
    return _grants(fx).select("principal_display_name", "grantee", "ext_loc_name", "created")


@_query
def hcl_location_resources(fx: Fixtures) -> DataFrame:
    _, role_locations, labels = _labelled_locations(fx)
    return documents.location_resources(role_locations, labels.locations)


@_query
def hcl_location_datasources(fx: Fixtures) -> DataFrame:
    _, role_locations, labels = _labelled_locations(fx)
    return documents.location_data_sources(role_locations, labels.locations)


@_query
def hcl_location_grants(fx: Fixtures) -> DataFrame:
    return documents.location_grant_blocks(_grants(fx))


@_query
def hcl_location_document(fx: Fixtures) -> DataFrame:
    return location_document(
        _saved(fx), fx.locations(), fx.buckets(), create_new=True, credential_name=CREDENTIAL
    )


# --- storage and volumes -------------------------------------------------------------------------
@_query
def bucket_inventory(fx: Fixtures) -> DataFrame:
    return fx.buckets()


@_query
def bucket_folders(fx: Fixtures) -> DataFrame:
    return first_level_folders(fx.object_keys())


@_query
def external_locations(fx: Fixtures) -> DataFrame:
    return fx.locations()


@_query
def location_bucket_parse(fx: Fixtures) -> DataFrame:
    return volumes.location_buckets(fx.locations()).select(
        "ext_loc_name", "url", "s3_bucket_url", "s3_bucket_name"
    )


def _volumes(fx: Fixtures) -> DataFrame:
    return volumes.volumes(
        fx.locations(), fx.folders(), fx.bucket_map(), DEFAULT_CATALOG, DEFAULT_SCHEMA
    )


@_query
def volumes_(fx: Fixtures) -> DataFrame:
    return _volumes(fx)


@_query
def hcl_volumes(fx: Fixtures) -> DataFrame:
    return documents.volume_blocks(documents.volume_addresses(stage(_volumes(fx))))


@_query
def hcl_volume_document(fx: Fixtures) -> DataFrame:
    return volume_document(
        fx.locations(), fx.folders(), fx.bucket_map(), DEFAULT_CATALOG, DEFAULT_SCHEMA
    )


@_query
def bucket_map_duplicates(fx: Fixtures) -> DataFrame:
    return volumes.bucket_map_duplicates(fx.bucket_map())


# --- privileges ----------------------------------------------------------------------------------
@_query
def privilege_map(fx: Fixtures) -> DataFrame:
    privileges_of = PrivilegeSet()
    return (
        fx.grants()
        .groupBy("action_type")
        .agg(F.count("*").alias("n_rows"))
        .select("*", *privileges_of.of_action("action_type"))
        .select("action_type", _joined(privileges_of.names(), "privileges"), "n_rows")
    )


@_query
def grant_object_type(fx: Fixtures) -> DataFrame:
    described = privileges.describe_objects(fx.grants())
    return described.groupBy("object_type").agg(F.count("*").alias("n_rows"))


@_query
def grant_object_name(fx: Fixtures) -> DataFrame:
    return (
        privileges.describe_objects(fx.grants())
        .groupBy("catalog", "database", "table", "view", "object_type", "object_name")
        .agg(F.count("*").alias("n_rows"))
    )


@_query
def privileges_by_object_type(fx: Fixtures) -> DataFrame:
    privileges_of = PrivilegeSet()
    return (
        privileges.translate_grants(fx.grants(), privileges_of)
        .groupBy("object_type", "action_type", *privileges_of.columns)
        .agg(F.count("*").alias("n_rows"))
        .select("object_type", "action_type", _joined(privileges_of.names(), "privileges"), "n_rows")
    )


def _entries(fx: Fixtures) -> DataFrame:
    return privileges.principal_object_privileges(fx.grants()).select(
        "principal",
        "object_type",
        "object_name",
        _joined("privileges", "privileges"),
        _joined("legacy_privileges", "legacy_privileges"),
    )


@_query
def principal_object_privileges(fx: Fixtures) -> DataFrame:
    return _entries(fx)


@_query
def object_grants(fx: Fixtures) -> DataFrame:
    def lists(name: str) -> Column:
        return _joined(F.transform(name, lambda v: F.array_join(v, ",")), name, ";")

    return privileges.object_grants(fx.grants()).select(
        "object_type",
        "object_name",
        "list_no",
        _joined("principals", "principals", ";"),
        lists("privileges"),
        lists("legacy_privileges"),
    )


@_query
def dominant_object_type(fx: Fixtures) -> DataFrame:
    return privileges.dominant_object_type(fx.grants())


@_query
def hcl_object_grants(fx: Fixtures) -> DataFrame:
    rows = stage(privileges.grantable(fx.grants()))
    return documents.object_grant_blocks(rows, object_addresses(rows))


@_query
def hcl_acl_document(fx: Fixtures) -> DataFrame:
    return acl_document(fx.grants())


@_query
def hcl_text_roundtrip(fx: Fixtures) -> DataFrame:
    path = shared_folder(fx.spark)
    write_document(acl_document(fx.grants()), path)
    return numbered_lines(fx.spark, path)


@_query
def document_counts(fx: Fixtures) -> DataFrame:
    """What the writer counts, next to the blocks that the lines of the written documents have."""
    counted = []
    for n_files in (1, 4, 16):
        path = shared_folder(fx.spark)
        written = write_document(acl_document(fx.grants()), path, n_files=n_files)
        lines = fx.spark.read.text(path).agg(
            F.count_if(F.col("value").rlike('^(resource|data|terraform) ')).alias("n_blocks"),
            F.count_if(F.col("value").startswith("\tgrant {")).alias("n_grants"),
        )
        counted.append(lines.select(
            F.lit(n_files).alias("n_files"), F.lit(written.n_pieces).alias("n_pieces"),
            F.lit(sum(written.n_blocks.values())).alias("counted_blocks"), "n_blocks", "n_grants",
        ))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@_query
def unmapped_privileges(fx: Fixtures) -> DataFrame:
    return privileges.unmapped_privileges(fx.grants())


# --- addresses ------------------------------------------------------------------------------------
def _addresses(rows: DataFrame, kind: str, keys: list[str], address: str) -> DataFrame:
    key = F.concat_ws("\n", *keys)
    return rows.select(F.lit(kind).alias("kind"), key.alias("name"), F.col(address).alias("address"))


@_query
def address_map(fx: Fixtures) -> DataFrame:
    grantees = stage(access.grantee_labels(stage(fx.clashing_grantees())))
    found = access.location_labels(stage(fx.clashing_locations()), grantees)
    volume = documents.volume_addresses(stage(fx.clashing_volumes()))
    objects = documents.object_addresses(stage(fx.clashing_objects()))
    return (
        _addresses(grantees, "principal", access.GRANTEE, "principal_label")
        .unionByName(_addresses(found, "location", access.LOCATION_NAME, "ext_loc_label"))
        .unionByName(_addresses(volume, "volume", documents.VOLUME, "address"))
        .unionByName(_addresses(objects, "object", documents.OBJECT, "address"))
    )


# --- libraries -----------------------------------------------------------------------------------
@_query
def library_inventory(fx: Fixtures) -> DataFrame:
    return fx.libraries()


@_query
def library_classify(fx: Fixtures) -> DataFrame:
    return allowlist.classify_libraries(fx.libraries())


@_query
def allowlist_current(fx: Fixtures) -> DataFrame:
    return fx.allowlist()


def _delta(fx: Fixtures) -> DataFrame:
    artifacts = allowlist.classify_libraries(fx.libraries())
    return allowlist.allowlist_delta(artifacts, fx.allowlist(), ANY_LIBRARY)


@_query
def allowlist_delta(fx: Fixtures) -> DataFrame:
    return _delta(fx)


@_query
def allowlist_delta_jar(fx: Fixtures) -> DataFrame:
    return allowlist.allowlist_delta(allowlist.classify_libraries(fx.libraries()), fx.allowlist(), "jar")


@_query
def allowlist_delta_maven(fx: Fixtures) -> DataFrame:
    return allowlist.allowlist_delta(allowlist.classify_libraries(fx.libraries()), fx.allowlist(), "maven")


@_query
def allowlist_desired(fx: Fixtures) -> DataFrame:
    artifacts = allowlist.classify_libraries(fx.libraries())
    return allowlist.allowlist_desired(artifacts, fx.allowlist(), ANY_LIBRARY)


@_query
def allowlist_payload(fx: Fixtures) -> DataFrame:
    return allowlist_update(fx.libraries(), fx.allowlist(), ANY_LIBRARY)


# --- counts and audits ---------------------------------------------------------------------------
@_query
def pipeline_counts(fx: Fixtures) -> DataFrame:
    return row_counts(
        {
            "principals": public_principals(fx.principals()),
            "governance": _governance(fx).access,
            "external_locations": fx.locations(),
            "volumes": _volumes(fx),
            "principal_object_privileges": privileges.principal_object_privileges(fx.grants()),
            "allowlist_delta": _delta(fx),
        }
    )


def _names(rows: DataFrame, kind: str, name: str) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), F.col(name).alias("name")).distinct()


def _labelled(fx: Fixtures) -> DataFrame:
    described = privileges.describe_objects(fx.grants()).filter(F.col("principal").isNotNull())
    return (
        _names(fx.locations(), "location", "ext_loc_name")
        .unionByName(_names(public_principals(fx.principals()), "principal", "principal_display_name"))
        .unionByName(_names(described, "object", "object_name"))
    )


@_query
def sanitize_labels(fx: Fixtures) -> DataFrame:
    return _labelled(fx).withColumn("label", label(F.col("name")))


@_query
def label_collisions(fx: Fixtures) -> DataFrame:
    artifacts = _names(allowlist.classify_libraries(fx.libraries()), "artifact", "artifact")
    others = _labelled(fx).filter("kind <> 'principal'").unionByName(artifacts).withColumn("owner", F.lit(""))
    holders = public_principals(fx.principals()).select(
        F.lit("principal").alias("kind"), F.col("principal_display_name").alias("name"),
        principals.grantee().alias("owner"),
    )
    named = _volumes(fx).select(
        F.lit("volume").alias("kind"), F.concat_ws("_", "ext_loc_label", "volume_label").alias("name"),
        F.concat_ws("\n", "s3_bucket_url", "volume", "catalog_name", "schema_name").alias("owner"),
    )
    return audit.label_collisions(others.unionByName(holders).unionByName(named))


@_query
def incomplete_blocks(fx: Fixtures) -> DataFrame:
    return all_principals(*[documents.incomplete(rows, kind) for kind, rows in fx.unfinished().items()])


@_query
def block_counts(fx: Fixtures) -> DataFrame:
    return all_principals(*[audit.block_counts(rows, kind) for kind, rows in fx.unfinished().items()])
