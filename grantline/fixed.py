"""Fixed values.

Everything in this module is a fixed value: vocabularies, formats and patterns that the results
have to reproduce exactly.  No logic lives here.
"""

# --- privileges ----------------------------------------------------------------------------------
PRIVILEGE_MAP = {
    "ALL PRIVILEGES": ["ALL_PRIVILEGES"],
    "READ_METADATA": ["APPLY_TAG", "BROWSE"],
    "USAGE": ["USE_CATALOG", "USE_SCHEMA"],
    "SELECT": ["SELECT"],
    "CREATE": ["CREATE_TABLE", "CREATE_SCHEMA"],
    "MODIFY": ["MODIFY"],
    "CREATE_NAMED_FUNCTION": ["CREATE_FUNCTION"],
}

PRIVILEGES_NOT_ALLOWED_ON = {
    "TABLE": ["BROWSE", "CREATE_CATALOG", "CREATE_SCHEMA", "CREATE_TABLE"],
    "SCHEMA": ["BROWSE", "CREATE_SCHEMA", "CREATE_CATALOG", "USE_CATALOG"],
    "CATALOG": ["CREATE_TABLE", "CREATE_CATALOG", "USE_SCHEMA"],
}

# --- principals ----------------------------------------------------------------------------------
PRINCIPAL_TYPES = ["GROUP", "USER", "SERVICE_PRINCIPAL"]
PROFILE_ARN_PATTERN = "^arn:aws:iam::[0-9]+:instance-profile/(.+)"

# --- storage paths -------------------------------------------------------------------------------
BUCKET_ARN_PREFIX = "arn:aws:s3:::"
BUCKET_ARN_PATTERN = r"^arn:aws:s3:::([^/]+)(/\*)?$"
URL_SCHEME = "s3://"
BUCKET_URL_PATTERN = "^(s3a?://[^/]+)"
BUCKET_NAME_PATTERN = "^s3a?://([^/]+)"
MIN_PATHS_PER_ROLE = 6

# --- allowlist -----------------------------------------------------------------------------------
ALLOWLIST_MATCH_TYPE = "PREFIX_MATCH"
JAR_LOCATIONS = ["s3://", "/Volumes/"]
LIBRARY_TYPES = {"jar": ["jar"], "maven": ["maven"], "jar/maven": ["jar", "maven"]}

# --- labels --------------------------------------------------------------------------------------
LABEL_FORBIDDEN_PATTERN = "[^a-zA-Z0-9_]"

# --- document formats ----------------------------------------------------------------------------
DOCUMENT_HEADER = """\
terraform {
  required_providers {
    databricks = {
      source = "databricks/databricks"
    }
  }
}
"""

LOCATION_RESOURCE = """\
resource "databricks_external_location" "ext_loc_{label}" {{
\tname = "{name}"
\turl = "{url}"
\tcredential_name = "{credential}"
\tcomment = "External location created by terraform"
}}
"""

LOCATION_DATA_SOURCE = """\
data "databricks_external_location" "ext_loc_{label}" {{
\tname = "{name}"
}}
"""

LOCATION_GRANT = """\
resource "databricks_grant" "principal_{principal_label}_{label}" {{
\texternal_location = {reference}databricks_external_location.ext_loc_{label}.id

\tprincipal = "{principal}"
\tprivileges = ["ALL_PRIVILEGES"]
}}
"""

VOLUME_RESOURCE = """\
resource "databricks_volume" "volume_{address}" {{
\tname = "{volume_label}"
\tcatalog_name = "{catalog}"
\tschema_name = "{schema}"
\tvolume_type = "EXTERNAL"
\tstorage_location = "{bucket_url}/{folder}"
\tcomment = "Volume created by terraform"
}}
"""

# An object's grants block is written as an opening, one piece per principal, and a closing.
OBJECT_GRANTS_OPENING = """\
resource "databricks_grants" "{address}" {{
\t{kind} = "{name}\""""

OBJECT_GRANT = """
\tgrant {{
\t\tprincipal  = "{principal}"
\t\tprivileges  = {privileges}
\t}}"""

OBJECT_GRANTS_CLOSING = "}}\n"

DOCUMENT_PREFIXES = {
    "locations": "tf_exported_extloc_grants",
    "volumes": "tf_exported_volumes",
    "privileges": "tf_exported_acl_grants_",
}
