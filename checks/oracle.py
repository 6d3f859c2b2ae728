"""Expected results as SQL over the test tables.

``RELATIONS`` are common table expressions in dependency order; ``QUERIES`` select from them.  Each
query gets the relations it needs, so every text runs on its own.
"""

import re

from grantline import fixed

BUCKET = "concat(lower(p_type), '-', lower(replace(p_brand, '#', '-')))"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _fill(template: str, **values: str) -> str:
    """A format text of the fixed values as an SQL concatenation."""
    pieces = re.split(r"\{(\w+)\}", template.replace("{{", "\x01").replace("}}", "\x02"))
    parts = []
    for n, piece in enumerate(pieces):
        if n % 2:
            parts.append(f"({values[piece]})")
        elif piece:
            parts.append(_quote(piece.replace("\x01", "{").replace("\x02", "}")))
    return " || ".join(parts)


def _label(name: str) -> str:
    return f"lower(regexp_replace({name}, '[^a-zA-Z0-9_]', '_', 'g'))"


def _unique(relation: str, keys: list[str], stem: str, more: str = "false") -> str:
    """The rows with an address of their own: the stem, with a mark where another one could have it."""
    return f"""
        SELECT * EXCLUDE (stem, digest, marked, long),
               stem || CASE WHEN NOT marked THEN '' WHEN long THEN '_' || digest ELSE '_' || left(digest, 8) END AS address
        FROM (SELECT b.*, ({more}) OR count(*) OVER (PARTITION BY stem) > 1
                     OR stem IN (SELECT {stem} || '_' || left(md5(concat_ws(chr(10), {', '.join(keys)})), n.n)
                                 FROM {relation} CROSS JOIN (VALUES (8), (32)) AS n(n)) AS marked,
                     count(*) OVER (PARTITION BY left(digest, 8)) > 1 AS long
              FROM (SELECT *, {stem} AS stem, md5(concat_ws(chr(10), {', '.join(keys)})) AS digest FROM {relation}) b)"""


def _in(names) -> str:
    return "(" + ", ".join(map(_quote, names)) + ")"


_RESOURCE = f"""CASE p_size % 5
                 WHEN 0 THEN concat('arn:aws:s3:::', {BUCKET})
                 WHEN 1 THEN concat('arn:aws:s3:::', {BUCKET}, '/*')
                 WHEN 2 THEN concat('arn:aws:s3:::', lower(p_type),
                                    CASE WHEN p_partkey % 3 = 0 THEN '-brand-???' ELSE '-*/*' END)
                 WHEN 3 THEN concat('arn:aws:s3:::', {BUCKET}, '/prefix/*')
                 ELSE concat('arn:aws:sqs:us-east-1:1:', {BUCKET}) END"""
_ROLE = "(CASE WHEN p_partkey % 25 < 20 OR p_partkey < 100 THEN p_partkey % 25 ELSE p_partkey % 20 END)"
_ACTION_ROWS = ", ".join(
    f"({_quote(old)}, {_quote(new)})" for old, news in fixed.PRIVILEGE_MAP.items() for new in news
)
_REMOVED_ROWS = ", ".join(
    f"({_quote(kind)}, {_quote(p)})"
    for kind, names in fixed.PRIVILEGES_NOT_ALLOWED_ON.items()
    for p in names
)

_VOLUME = ["ext_loc_label", "volume_label", "volume", "catalog_name", "schema_name", "s3_bucket_url"]
_OBJECT_STEM = f"lower(object_type) || '_' || {_label('object_name')}"
_CLASHING = "concat('Loc ', lower(p_type), ['.', '_', '-'][p_partkey % 3 + 1], CAST(p_size % 10 AS VARCHAR))"

RELATIONS = {
    "principals": """
        SELECT 'USER' AS principal_type,
               CASE WHEN c_custkey % 400 = 399 THEN concat('Twin ', CAST(c_custkey // 800 AS VARCHAR)) ELSE c_name END
                 AS display_name, CAST(c_custkey AS VARCHAR) AS principal_id,
               CAST(NULL AS VARCHAR) AS application_id,
               CASE WHEN c_custkey % 10 <> 0 THEN concat('u', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
               CAST(c_custkey AS BIGINT) AS k
        FROM customer
        UNION ALL
        SELECT 'SERVICE_PRINCIPAL', s_name, CAST(s_suppkey AS VARCHAR), concat('app-', CAST(s_suppkey AS VARCHAR)),
               NULL, CAST(s_suppkey AS BIGINT)
        FROM supplier
        UNION ALL
        SELECT 'GROUP', n_name, CAST(n_nationkey AS VARCHAR), NULL, NULL, CAST(n_nationkey AS BIGINT) FROM nation""",
    "principal_roles": """
        SELECT p.*, j.n,
               concat('arn:aws:iam::123456789012:instance-profile/ip-', CAST((p.k * 7 + j.n * (13 + p.k // 25)) % 25 AS VARCHAR))
                 AS instance_profile_arn
        FROM principals p CROSS JOIN (SELECT n_nationkey AS n FROM nation WHERE n_nationkey < 3) j
        WHERE j.n < p.k % 4""",
    "landed_lines": """
        SELECT principal_type, principal_id AS id, k, unnest(range(CASE WHEN k % 499 = 0 THEN 2 ELSE 1 END)) AS copy FROM principals""",
    "rejects": """
        SELECT principal_type AS kind, r.reason, replace(r.line, '?', l.id) AS line
        FROM landed_lines l
        JOIN (VALUES (3, 'malformed', '{"displayName":"x","id":"?'), (4, 'not_an_object', '["?"]'),
                     (5, 'wrong_type', '{"id":"?","emails":"none"}'), (6, 'missing_field', '{"displayName":"?"}'))
          AS r(remainder, reason, line) ON l.k % 20 = r.remainder
        UNION ALL
        SELECT 'PROFILE', CASE n_nationkey % 10 WHEN 8 THEN 'malformed' ELSE 'missing_field' END,
               CASE n_nationkey % 10 WHEN 8 THEN '{"InstanceProfile":{"Roles":[' ELSE '{"Message":"no"}' END
        FROM nation WHERE n_nationkey % 10 >= 8""",
    "public_principals": """
        SELECT principal_type, display_name AS principal_display_name, principal_id, application_id,
               email AS email_value, string_agg(instance_profile_arn, ',' ORDER BY n) AS profiles,
               count(*) AS n_profiles, min(k) AS k
        FROM principal_roles
        GROUP BY principal_type, display_name, principal_id, application_id, email""",
    "profile_roles": """
        SELECT concat('ip-', CAST(n_nationkey AS VARCHAR)) AS profile_name,
               concat('role-', CAST(n_nationkey AS VARCHAR)) AS role_name
        FROM nation""",
    "policy_resources": f"""
        SELECT concat('role-', CAST({_ROLE} AS VARCHAR)) AS role_name,
               concat('pol-', CAST(p_partkey % 50 AS VARCHAR), '-', CAST({_ROLE} AS VARCHAR), '/',
                      CAST(p_partkey // 2000 AS VARCHAR)) AS policy_arn,
               p_partkey AS ord,
               CASE WHEN p_partkey % 11 = 0 THEN 'Deny' ELSE 'Allow' END AS effect,
               {_RESOURCE} AS resource
        FROM part""",
    "broken_policies": """
        SELECT concat('role-', CAST(p_partkey % 25 AS VARCHAR)) AS role_name,
               concat('broken-', CAST(p_partkey AS VARCHAR)) AS policy_arn
        FROM part WHERE p_partkey % 100 = 0""",
    "missing_policies": """
        SELECT concat('role-', CAST(p_partkey % 25 AS VARCHAR)) AS role_name,
               concat('missing-', CAST(p_partkey AS VARCHAR)) AS policy_arn
        FROM part WHERE p_partkey % 100 = 1""",
    "except_policies": """
        SELECT concat('lone-', CAST(p_partkey AS VARCHAR)) AS role_name,
               concat('except-', CAST(p_partkey AS VARCHAR)) AS policy_arn, concat('e', CAST(p_partkey AS VARCHAR)) AS sid
        FROM part WHERE p_partkey % 100 = 2""",
    "paths": """
        SELECT role_name, policy_arn, ord, replace(resource, 'arn:aws:s3:::', 's3://') AS s3_path,
               replace(replace(resource, 'arn:aws:s3:::', 's3://'), '*', '.*') AS s3_path_regex
        FROM policy_resources
        WHERE effect = 'Allow' AND regexp_matches(resource, '^arn:aws:s3:::([^/]+)(/[*])?$')""",
    "role_counts": """
        SELECT role_name, count(*) AS n_paths FROM paths GROUP BY role_name HAVING count(*) > 5""",
    "role_paths": """
        SELECT DISTINCT p.role_name, p.s3_path, p.s3_path_regex
        FROM paths p JOIN role_counts c ON p.role_name = c.role_name""",
    "governance": """
        SELECT p.principal_type, p.principal_id, p.display_name AS principal_display_name, p.email AS email_value,
               p.application_id, p.instance_profile_arn, r.role_name, r.n_paths
        FROM principal_roles p
        LEFT JOIN (SELECT pr.profile_name, pr.role_name, c.n_paths
                   FROM profile_roles pr JOIN role_counts c ON pr.role_name = c.role_name) r
          ON split_part(p.instance_profile_arn, '/', 2) = r.profile_name""",
    "held_paths": """
        SELECT * FROM role_paths
        WHERE role_name IN (SELECT role_name FROM governance
                            WHERE role_name IS NOT NULL AND principal_display_name IS NOT NULL)""",
    "bucket_keys": f"SELECT {BUCKET} AS bucket_name, min(p_partkey) AS k FROM part GROUP BY 1",
    "ext_locations": """
        SELECT concat('Loc ', bucket_name) AS ext_loc_name, concat('cred_', CAST(k % 3 AS VARCHAR)) AS credential_name,
               '' AS credential_id,
               concat('s3://', bucket_name, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '/data/' END) AS url,
               true AS created
        FROM bucket_keys WHERE k % 2 = 0""",
    "supplier_paths": f"""
        SELECT role_name, replace(resource, 'arn:aws:s3:::', 's3://') AS s3_path,
               replace(replace(resource, 'arn:aws:s3:::', 's3://'), '*', '.*') AS s3_path_regex
        FROM (SELECT concat('sup-', CAST(l_suppkey AS VARCHAR)) AS role_name, p_partkey, {_RESOURCE} AS resource
              FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey)
        WHERE p_partkey % 11 <> 0 AND regexp_matches(resource, '^arn:aws:s3:::([^/]+)(/[*])?$')""",
    "supplier_access": """
        SELECT DISTINCT 'USER' AS principal_type, CAST(c_custkey AS VARCHAR) AS principal_id,
               c_name AS principal_display_name,
               CASE WHEN c_custkey % 10 <> 0 THEN concat('u', CAST(c_custkey AS VARCHAR), '@example.com') ELSE c_name END
                 AS grantee, r.role_name
        FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 1
        JOIN (SELECT role_name FROM supplier_paths GROUP BY role_name HAVING count(*) > 5) r
          ON r.role_name = concat('sup-', CAST(l_suppkey AS VARCHAR))
        WHERE l_suppkey IN (SELECT s_suppkey FROM supplier)""",
    "supplier_reach": """
        SELECT DISTINCT a.*, l.ext_loc_name, l.url, l.created
        FROM supplier_access a
        JOIN (SELECT DISTINCT role_name, s3_path FROM supplier_paths) p ON a.role_name = p.role_name
        JOIN (SELECT q.s3_path, e.ext_loc_name, e.url, e.created
              FROM (SELECT DISTINCT s3_path, s3_path_regex FROM supplier_paths WHERE NOT contains(s3_path, '???')) q, ext_locations e
              WHERE regexp_matches(e.url, q.s3_path_regex)) l ON l.s3_path = p.s3_path""",
    "matches": """
        SELECT p.s3_path, l.*
        FROM (SELECT DISTINCT s3_path, s3_path_regex FROM held_paths WHERE NOT contains(s3_path, '???')) p, ext_locations l
        WHERE regexp_matches(l.url, p.s3_path_regex)""",
    "anchored_matches": """
        SELECT p.s3_path, l.*
        FROM (SELECT DISTINCT s3_path FROM held_paths) p, ext_locations l
        WHERE regexp_matches(regexp_extract(l.url, '^s3a?://([^/]+)', 1),
          concat('^', replace(replace(regexp_extract(p.s3_path, '^s3://([^/]+)', 1), '*', '.*'), '?', '.'), '$'))""",
    "uncovered": """
        SELECT DISTINCT s3_path, s3_path_regex FROM held_paths
        WHERE s3_path NOT IN (SELECT s3_path FROM matches)""",
    "proposals": """
        SELECT u.s3_path, b.bucket_name AS ext_loc_name, 'new_credential' AS credential_name, '' AS credential_id,
               concat('s3://', b.bucket_name) AS url, false AS created
        FROM uncovered u, bucket_keys b
        WHERE regexp_matches(b.bucket_name,
          concat('^', replace(replace(regexp_extract(u.s3_path, '^s3://([^/]+)', 1), '*', '.*'), '?', '.'), '$'))""",
    "new_locations": """
        SELECT DISTINCT ext_loc_name, credential_name, credential_id, url, created FROM proposals""",
    "all_locations": "SELECT * FROM ext_locations UNION ALL SELECT * FROM new_locations",
    "role_locations": """
        SELECT DISTINCT h.role_name, m.ext_loc_name, m.credential_name, m.credential_id, m.url, m.created
        FROM held_paths h JOIN matches m ON h.s3_path = m.s3_path""",
    "all_role_locations": """
        SELECT role_name, ext_loc_name, credential_name, credential_id, url, created FROM role_locations
        UNION
        SELECT h.role_name, l.ext_loc_name, l.credential_name, l.credential_id, l.url, l.created
        FROM held_paths h, new_locations l
        WHERE CASE WHEN contains(h.s3_path, '???') THEN false ELSE regexp_matches(concat(l.url, '/'), h.s3_path_regex) END
           OR EXISTS (SELECT 1 FROM proposals p WHERE p.s3_path = h.s3_path AND p.ext_loc_name = l.ext_loc_name)""",
    "grantees": """
        SELECT DISTINCT principal_display_name,
               CASE WHEN principal_type = 'USER' AND email_value IS NOT NULL THEN email_value
                    WHEN principal_type = 'SERVICE_PRINCIPAL' AND application_id IS NOT NULL THEN application_id
                    ELSE principal_display_name END AS grantee,
               role_name
        FROM governance WHERE role_name IS NOT NULL AND principal_display_name IS NOT NULL""",
    "location_grants": """
        SELECT DISTINCT g.principal_display_name, g.grantee, r.ext_loc_name, r.created
        FROM grantees g JOIN all_role_locations r ON g.role_name = r.role_name""",
    "location_resources": f"""
        SELECT 1 AS section, {_label('ext_loc_name')} AS label, concat(ext_loc_name, chr(10), url) AS block,
               0 AS part, '' AS item,
               {_fill(fixed.LOCATION_RESOURCE, label=_label('ext_loc_name'), name='ext_loc_name', url='url',
                      credential='credential_name')} AS output
        FROM (SELECT DISTINCT ext_loc_name, url, credential_name FROM all_role_locations WHERE NOT created)""",
    "location_data_sources": f"""
        SELECT 2 AS section, {_label('ext_loc_name')} AS label, ext_loc_name AS block, 0 AS part, '' AS item,
               {_fill(fixed.LOCATION_DATA_SOURCE, label=_label('ext_loc_name'), name='ext_loc_name')} AS output
        FROM (SELECT DISTINCT ext_loc_name FROM all_role_locations WHERE created)""",
    "location_grant_blocks": f"""
        SELECT 3 AS section, principal_label || '_' || {_label('ext_loc_name')} AS label,
               concat(principal_display_name, chr(10), grantee, chr(10), ext_loc_name) AS block, 0 AS part, '' AS item,
               {_fill(fixed.LOCATION_GRANT, principal_label='principal_label',
                      label=_label('ext_loc_name'), reference="CASE WHEN created THEN 'data.' ELSE '' END",
                      principal='grantee')} AS output
        FROM (SELECT l.*, {_label('l.principal_display_name')}
                     || CASE WHEN c.n > 1 THEN '_' || substr(md5(concat(l.principal_display_name, chr(10), l.grantee)), 1, 8)
                             ELSE '' END AS principal_label
              FROM location_grants l
              JOIN (SELECT {_label('principal_display_name')} AS plain, count(*) AS n
                    FROM (SELECT DISTINCT principal_display_name, grantee FROM grantees) GROUP BY 1) c
                ON c.plain = {_label('l.principal_display_name')})""",
    "header": f"""
        SELECT 0 AS section, '' AS label, '' AS block, 0 AS part, '' AS item,
               {_quote(fixed.DOCUMENT_HEADER)} AS output""",
    "folders": """
        SELECT b.bucket_name, concat(lower(r.r_name), '.v', CAST(b.k % 4 AS VARCHAR), '/') AS folder
        FROM bucket_keys b CROSS JOIN region r WHERE r.r_regionkey < b.k % 4""",
    "bucket_map": """
        SELECT concat('s3://', bucket_name) AS s3_bucket_url, concat('catalog', CAST((k + copy) % 3 AS VARCHAR)) AS catalog_name,
               concat('schema', CAST(k % 5 AS VARCHAR)) AS schema_name
        FROM bucket_keys CROSS JOIN (VALUES (0), (1)) AS c(copy) WHERE k % 4 = 0 AND (copy = 0 OR k % 8 = 0)""",
    "volumes": f"""
        SELECT DISTINCT l.ext_loc_name, {_label('l.ext_loc_name')} AS ext_loc_label, f.folder AS volume,
               left({_label('f.folder')}, length(f.folder) - 1) AS volume_label,
               coalesce(m.catalog_name, 'main') AS catalog_name, coalesce(m.schema_name, 'landing') AS schema_name,
               regexp_extract(l.url, '^(s3a?://[^/]+)', 1) AS s3_bucket_url
        FROM ext_locations l
        JOIN folders f ON f.bucket_name = regexp_extract(l.url, '^s3a?://([^/]+)', 1)
        LEFT JOIN bucket_map m ON m.s3_bucket_url = regexp_extract(l.url, '^(s3a?://[^/]+)', 1)""",
    "volume_keys": """
        SELECT DISTINCT ext_loc_label, volume_label, volume, catalog_name, schema_name, s3_bucket_url FROM volumes""",
    "volume_addresses": _unique("volume_keys", _VOLUME, "ext_loc_label || '_' || volume_label"),
    "volume_blocks": f"""
        SELECT 1 AS section, address AS label,
               concat(s3_bucket_url, chr(10), volume, chr(10), catalog_name, chr(10), schema_name) AS block,
               0 AS part, '' AS item,
               {_fill(fixed.VOLUME_RESOURCE, address='address', volume_label='volume_label',
                      catalog='catalog_name', schema='schema_name', bucket_url='s3_bucket_url', folder='volume')}
                 AS output
        FROM volume_addresses""",
    "object_keys": f"""
        SELECT b.bucket_name,
               CASE WHEN o.o_orderkey % 13 = 0 THEN concat('file-', CAST(o.o_orderkey AS VARCHAR))
                    ELSE concat('f.', CAST(o.o_orderkey % 6 AS VARCHAR), '/y=', CAST(o.o_orderkey % 4 AS VARCHAR),
                                '/part-', CAST(o.o_orderkey AS VARCHAR)) END AS object_key
        FROM orders o JOIN lineitem i ON i.l_orderkey = o.o_orderkey
        JOIN (SELECT p_partkey, {BUCKET} AS bucket_name FROM part) b ON b.p_partkey = i.l_partkey""",
    "grants": """
        SELECT principal, action_type, cat, db, tab, vw,
               CASE WHEN tab IS NOT NULL OR vw IS NOT NULL THEN 'TABLE' WHEN db IS NOT NULL THEN 'SCHEMA'
                    WHEN cat IS NOT NULL THEN 'CATALOG' ELSE 'UNKNOWN' END AS object_type,
               concat_ws('.', cat, db, coalesce(tab, vw)) AS object_name
        FROM (
          SELECT CASE WHEN l_orderkey % 97 <> 0 THEN concat('u', CAST(l_suppkey AS VARCHAR)) END AS principal,
                 CASE CAST(l_quantity AS INT) % 9 WHEN 0 THEN 'ALL PRIVILEGES' WHEN 1 THEN 'READ_METADATA'
                   WHEN 2 THEN 'USAGE' WHEN 3 THEN 'select' WHEN 4 THEN 'SELECT' WHEN 5 THEN 'CREATE'
                   WHEN 6 THEN 'MODIFY' WHEN 7 THEN 'CREATE_NAMED_FUNCTION' ELSE 'OWN' END AS action_type,
                 CASE WHEN l_linenumber <> 7 THEN concat('cat_', lower(l_returnflag)) END AS cat,
                 CASE WHEN l_linenumber NOT IN (1, 7) THEN concat('db_', CAST(l_orderkey % 5 AS VARCHAR)) END AS db,
                 CASE WHEN l_linenumber IN (3, 4, 5) THEN concat('t_', CAST(l_partkey % 40 AS VARCHAR)) END AS tab,
                 CASE WHEN l_linenumber = 6 THEN concat('v_', CAST(l_partkey % 10 AS VARCHAR)) END AS vw
          FROM lineitem)""",
    "privilege_map": f"SELECT * FROM (VALUES {_ACTION_ROWS}) AS m(legacy, privilege)",
    "removed": f"SELECT * FROM (VALUES {_REMOVED_ROWS}) AS r(object_type, privilege)",
    "type_privileges": """
        SELECT t.object_type, m.legacy, m.privilege
        FROM (VALUES ('TABLE'), ('SCHEMA'), ('CATALOG'), ('UNKNOWN')) AS t(object_type) CROSS JOIN privilege_map m
        WHERE NOT EXISTS (SELECT 1 FROM removed r WHERE r.object_type = t.object_type AND r.privilege = m.privilege)""",
    "flat_privileges": """
        SELECT DISTINCT g.principal, g.object_type, g.object_name, t.privilege
        FROM grants g JOIN type_privileges t ON t.object_type = g.object_type AND t.legacy = upper(g.action_type)
        WHERE g.principal IS NOT NULL""",
    "entries": """
        SELECT l.principal, l.object_type, l.object_name, coalesce(n.privileges, '') AS privileges, l.legacy_privileges
        FROM (SELECT principal, object_type, object_name,
                     string_agg(action_type, ',' ORDER BY action_type) AS legacy_privileges
              FROM (SELECT DISTINCT principal, object_type, object_name, action_type FROM grants
                    WHERE principal IS NOT NULL)
              GROUP BY principal, object_type, object_name) l
        LEFT JOIN (SELECT principal, object_type, object_name,
                          string_agg(privilege, ',' ORDER BY privilege DESC) AS privileges
                   FROM flat_privileges GROUP BY principal, object_type, object_name) n
          ON n.principal = l.principal AND n.object_type = l.object_type AND n.object_name = l.object_name""",
    "grantable": "SELECT * FROM entries WHERE privileges <> '' AND object_type <> 'UNKNOWN'",
    "object_keys_of_grants": "SELECT DISTINCT object_type, object_name FROM grantable",
    "object_addresses": _unique("object_keys_of_grants", ["object_type", "object_name"], _OBJECT_STEM),
    "object_grant_blocks": f"""
        SELECT CASE object_type WHEN 'CATALOG' THEN 1 WHEN 'SCHEMA' THEN 2 ELSE 3 END AS section,
               {_label('object_name')} AS label, object_name AS block, part, item, output
        FROM (
          SELECT object_type, object_name, 0 AS part, '' AS item,
                 {_fill(fixed.OBJECT_GRANTS_OPENING, kind='lower(object_type)', address='address', name='object_name')} AS output
          FROM object_addresses
          UNION ALL
          SELECT DISTINCT object_type, object_name, 2, '', {_fill(fixed.OBJECT_GRANTS_CLOSING)} FROM grantable
          UNION ALL
          SELECT object_type, object_name, 1, principal,
                 {_fill(fixed.OBJECT_GRANT, principal='principal',
                        privileges="concat('[" + '"' + "', replace(privileges, ',', '" + '","' + "'), '" + '"' + "]')")}
          FROM grantable)""",
    "unfinished": f"""
        SELECT 'location' AS kind,
               concat_ws('/', CASE WHEN k % 13 <> 0 THEN concat('New ', bucket_name) END,
                         CASE WHEN k % 11 <> 0 THEN concat('s3://', bucket_name) END,
                         CASE WHEN k % 7 <> 0 THEN concat('cred_', CAST(k % 3 AS VARCHAR)) END) AS subject,
               concat_ws(',', CASE WHEN k % 13 = 0 THEN 'ext_loc_name' END, CASE WHEN k % 11 = 0 THEN 'url' END,
                         CASE WHEN k % 7 = 0 THEN 'credential_name' END) AS missing
        FROM bucket_keys
        UNION ALL
        SELECT 'registered_location', CASE WHEN k % 13 <> 0 THEN concat('New ', bucket_name) ELSE '' END,
               CASE WHEN k % 13 = 0 THEN 'ext_loc_name' ELSE '' END
        FROM bucket_keys
        UNION ALL
        SELECT 'location_grant',
               concat_ws('/', CASE WHEN c_custkey % 17 <> 0 THEN c_name END,
                         CASE WHEN c_custkey % 19 <> 0 THEN concat('u', CAST(c_custkey AS VARCHAR)) END,
                         CASE WHEN c_custkey % 5 <> 0 THEN concat('Loc ', CAST(c_custkey % 7 AS VARCHAR)) END),
               concat_ws(',', CASE WHEN c_custkey % 17 = 0 THEN 'principal_display_name' END,
                         CASE WHEN c_custkey % 19 = 0 THEN 'grantee' END, CASE WHEN c_custkey % 5 = 0 THEN 'ext_loc_name' END)
        FROM customer
        UNION ALL
        SELECT 'volume',
               concat_ws('/', concat('loc_', lower(p_type)), concat('v_', CAST(p_size AS VARCHAR)),
                         concat('v.', CAST(p_size AS VARCHAR), '/'), CASE WHEN p_partkey % 9 <> 0 THEN 'main' END,
                         CASE WHEN p_partkey % 6 <> 0 THEN 'landing' END, concat('s3://', {BUCKET})),
               concat_ws(',', CASE WHEN p_partkey % 9 = 0 THEN 'catalog_name' END, CASE WHEN p_partkey % 6 = 0 THEN 'schema_name' END)
        FROM part""",
    "clashing_grantees": """
        SELECT DISTINCT
               CASE c_custkey % 4 WHEN 0 THEN concat('Team ', CAST(c_custkey % 30 AS VARCHAR))
                 WHEN 1 THEN concat('Team.', CAST(c_custkey % 30 AS VARCHAR))
                 WHEN 2 THEN concat('Team ', CAST(c_custkey % 30 AS VARCHAR), ' Loc') ELSE c_name END AS principal_display_name,
               concat('u', CAST(c_custkey % 40 AS VARCHAR), '@example.com') AS grantee
        FROM customer""",
    "clashing_grantee_labels": _unique("clashing_grantees", ["principal_display_name", "grantee"], _label("principal_display_name")),
    "clashing_locations": f"""
        SELECT DISTINCT
               CASE p_partkey % 7 WHEN 0 THEN {_label(_CLASHING)} || '_' || left(md5(concat({_CLASHING}, chr(10), 'true')), 8)
                 WHEN 1 THEN concat(p_type, ' ', CAST(p_size % 10 AS VARCHAR)) ELSE {_CLASHING} END AS ext_loc_name,
               p_partkey % 5 <> 4 AS created
        FROM part""",
    "between_labels": """
        SELECT DISTINCT substr(a.address, length(b.address) + 2) AS x
        FROM clashing_grantee_labels a JOIN clashing_grantee_labels b
          ON starts_with(a.address, b.address || '_') AND length(a.address) > length(b.address) + 1""",
    "possible_labels": f"""
        SELECT ext_loc_name, created, n.n = 0 AS plain,
               {_label('ext_loc_name')} || CASE WHEN n.n = 0 THEN ''
                 ELSE '_' || left(md5(concat_ws(chr(10), ext_loc_name, created)), n.n) END AS possible
        FROM clashing_locations CROSS JOIN (VALUES (0), (8), (32)) AS n(n)""",
    "confused_locations": """
        SELECT CASE WHEN s.plain THEN s.ext_loc_name ELSE l.ext_loc_name END AS name,
               CASE WHEN s.plain THEN s.created ELSE l.created END AS made
        FROM possible_labels s JOIN between_labels b ON true JOIN possible_labels l ON l.possible = b.x || '_' || s.possible
        WHERE (s.plain OR l.plain) AND (s.ext_loc_name <> l.ext_loc_name OR s.created <> l.created)""",
    "clashing_location_labels": _unique(
        "clashing_locations", ["ext_loc_name", "created"], _label("ext_loc_name"),
        "EXISTS (SELECT 1 FROM confused_locations c WHERE c.name = b.ext_loc_name AND c.made = b.created)",
    ),
    "clashing_volumes": f"""
        SELECT DISTINCT concat('loc_', lower(p_type)) AS ext_loc_label, concat('v_', CAST(p_size % 10 AS VARCHAR)) AS volume_label,
               concat('v', ['.', '_'][p_partkey % 2 + 1], CAST(p_size % 10 AS VARCHAR), '/') AS volume, 'main' AS catalog_name,
               concat('schema', CAST(p_size % 2 AS VARCHAR)) AS schema_name, concat('s3://', {BUCKET}) AS s3_bucket_url
        FROM part""",
    "clashing_volume_addresses": _unique("clashing_volumes", _VOLUME, "ext_loc_label || '_' || volume_label"),
    "clashing_objects": """
        SELECT DISTINCT ['TABLE', 'SCHEMA'][p_partkey % 2 + 1] AS object_type,
               concat('cat', ['.', '_'][p_size % 2 + 1], lower(p_type), ['.', '_'][p_partkey % 3 % 2 + 1],
                      CAST(p_size % 12 AS VARCHAR)) AS object_name
        FROM part""",
    "clashing_object_addresses": _unique("clashing_objects", ["object_type", "object_name"], _OBJECT_STEM),
    "libraries": f"""
        SELECT CASE WHEN p_partkey % 2 = 0 THEN 'interactive' ELSE 'job' END AS cluster_kind,
               CASE p_size % 4 WHEN 0 THEN concat('s3://libs/', replace(p_name, ' ', '-'), '.jar')
                 WHEN 1 THEN concat('/Volumes/main/libs/', replace(p_name, ' ', '-'), '.jar')
                 WHEN 2 THEN concat('dbfs:/libs/', replace(p_name, ' ', '-'), '.jar') END AS jar,
               CASE WHEN p_size % 4 = 3 OR p_size % 8 = 0
                    THEN concat('org.', lower(p_type), ':', replace(p_name, ' ', '-'), ':1.', CAST(p_size AS VARCHAR))
                    END AS maven_coordinates
        FROM part""",
    "allowlist": """
        SELECT DISTINCT CASE WHEN p_size % 4 = 0 THEN 'jar' ELSE 'maven' END AS artifact_type,
               CASE WHEN p_size % 4 = 0 THEN concat('s3://libs/', replace(p_name, ' ', '-'), '.jar')
                    ELSE concat('org.', lower(p_type), ':', replace(p_name, ' ', '-'), ':1.', CAST(p_size AS VARCHAR))
                    END AS artifact,
               CASE WHEN p_partkey % 3 = 0 THEN 'EXACT_MATCH' ELSE 'PREFIX_MATCH' END AS match_type
        FROM part WHERE p_partkey % 7 = 0 AND p_size % 4 IN (0, 3)""",
    "artifacts": """
        SELECT DISTINCT CASE WHEN jar IS NOT NULL THEN 'jar' ELSE 'maven' END AS artifact_type,
               coalesce(jar, maven_coordinates) AS artifact
        FROM libraries WHERE coalesce(jar, maven_coordinates) IS NOT NULL""",
    "delta": """
        SELECT artifact_type, artifact, 'PREFIX_MATCH' AS match_type FROM artifacts a
        WHERE (artifact_type = 'maven' OR artifact LIKE 's3://%' OR artifact LIKE '/Volumes/%')
          AND NOT EXISTS (SELECT 1 FROM allowlist w WHERE w.artifact_type = a.artifact_type AND w.artifact = a.artifact
                          AND w.match_type = 'PREFIX_MATCH')""",
    "desired": "SELECT * FROM allowlist UNION ALL SELECT * FROM delta",
}

_DOCUMENT = "section, label, block, part, item, output"
_LOCATION = "ext_loc_name, credential_name, credential_id, url, created"

QUERIES = {
    # principals
    "principals_ingest": """
        SELECT principal_type, principal_display_name, principal_id, application_id, email_value, profiles, n_profiles
        FROM public_principals
        UNION ALL
        SELECT principal_type, principal_display_name, principal_id, application_id, email_value, profiles, n_profiles
        FROM public_principals WHERE k % 499 = 0""",
    "rejected_records": "SELECT kind, reason, line FROM rejects",
    "landed_counts": """
        SELECT l.principal_type, count(*) AS n_lines, count(*) FILTER (l.k % 20 NOT IN (3, 4, 5, 6)) AS n_kept,
               count(*) FILTER (l.k % 20 IN (3, 4, 5, 6)) AS n_rejected
        FROM landed_lines l GROUP BY l.principal_type""",
    "schema_drift": """
        SELECT l.principal_type, d.field, d.type, count(*) AS n_values
        FROM landed_lines l JOIN (VALUES ('nickName', 'STRING'), ('emails[].sent', 'BIGINT')) AS d(field, type) ON l.k % 20 = 7
        GROUP BY ALL""",
    "principals_dedupe": """
        SELECT principal_type, principal_display_name, principal_id, n_profiles FROM public_principals""",
    "principals_all": """
        SELECT principal_type, principal_display_name, principal_id, application_id, email_value, profiles
        FROM public_principals""",
    "principals_by_type": """
        SELECT principal_type, principal_display_name, principal_id, application_id, email_value, profiles
        FROM public_principals WHERE principal_type = 'SERVICE_PRINCIPAL'""",
    "principals_name_filter": """
        SELECT principal_type, principal_display_name, principal_id, application_id, email_value, profiles
        FROM public_principals WHERE strpos(principal_display_name, 'er#0000') > 0""",
    "principal_primary_email": """
        SELECT principal_type, principal_id, email_value FROM public_principals""",
    "principal_profiles": """
        SELECT principal_type, display_name AS principal_display_name, principal_id, instance_profile_arn
        FROM principal_roles""",
    "profile_arn_parse": """
        SELECT instance_profile_arn, count(*) AS n_holders, split_part(instance_profile_arn, '/', 2) AS profile_name
        FROM principal_roles GROUP BY instance_profile_arn""",
    # policies
    "profile_roles": "SELECT profile_name, role_name FROM profile_roles",
    "policy_default_version": """
        SELECT role_name, policy_arn, true AS readable, count(*) AS n_statements
        FROM policy_resources GROUP BY role_name, policy_arn
        UNION ALL SELECT role_name, policy_arn, true, 1 FROM except_policies
        UNION ALL SELECT role_name, policy_arn, false, 0 FROM broken_policies""",
    "policy_resources": """
        SELECT role_name, policy_arn, concat('s', CAST(ord AS VARCHAR)) AS sid, effect, resource
        FROM policy_resources WHERE effect = 'Allow'""",
    "s3_path_patterns": """
        SELECT s3_path, s3_path_regex, count(*) AS n_entries FROM paths GROUP BY s3_path, s3_path_regex""",
    "role_filter": """
        SELECT role_name, count(*) AS n_paths FROM paths
        WHERE role_name IN ('role-1', 'role-4', 'role-9', 'role-16', 'role-21') GROUP BY role_name HAVING count(*) > 5""",
    "role_path_lists": """
        SELECT role_name, policy_arn, string_agg(s3_path, '|' ORDER BY ord) AS s3_paths,
               string_agg(s3_path_regex, '|' ORDER BY ord) AS s3_paths_regex
        FROM paths GROUP BY role_name, policy_arn""",
    "role_path_counts": "SELECT role_name, n_paths FROM role_counts",
    "role_paths": "SELECT role_name, s3_path, s3_path_regex FROM role_paths",
    # access
    "governance_export": "SELECT * FROM governance",
    "governance_roundtrip": "SELECT * FROM governance",
    "governance_schema_merge": """
        SELECT g.*, CASE WHEN principal_type <> 'USER' THEN 'yes' END AS reviewed,
               CASE WHEN principal_type = 'USER' THEN 2 END AS batch
        FROM governance g""",
    "governance_patterns": "SELECT role_name, s3_path, s3_path_regex FROM held_paths",
    "bucket_regex": """
        SELECT DISTINCT s3_path_regex,
               replace(replace(replace(s3_path_regex, 's3://', ''), '/', ''), '.*.*', '.*') AS bucket_regex
        FROM held_paths""",
    "location_access": """
        SELECT DISTINCT g.principal_type, g.principal_id, g.principal_display_name, r.ext_loc_name, r.url
        FROM governance g JOIN role_locations r ON g.role_name = r.role_name""",
    "location_access_anchored": """
        SELECT DISTINCT g.principal_type, g.principal_id, g.principal_display_name, m.ext_loc_name, m.url
        FROM governance g JOIN held_paths h ON g.role_name = h.role_name
        JOIN anchored_matches m ON m.s3_path = h.s3_path""",
    "location_access_diverse": """
        SELECT DISTINCT principal_type, principal_id, principal_display_name, ext_loc_name, url FROM supplier_reach""",
    "location_grants_diverse": """
        SELECT DISTINCT principal_display_name, grantee, ext_loc_name, created FROM supplier_reach""",
    "uncovered_patterns": "SELECT s3_path, s3_path_regex FROM uncovered",
    "new_location_proposals": f"SELECT {_LOCATION} FROM new_locations",
    "all_locations": f"SELECT {_LOCATION} FROM all_locations",
    "location_grants": "SELECT principal_display_name, grantee, ext_loc_name, created FROM location_grants",
    "hcl_location_resources": f"SELECT {_DOCUMENT} FROM location_resources",
    "hcl_location_datasources": f"SELECT {_DOCUMENT} FROM location_data_sources",
    "hcl_location_grants": f"SELECT {_DOCUMENT} FROM location_grant_blocks",
    "governance_lists_roundtrip": """
        SELECT role_name, policy_arn, string_agg(s3_path, '|' ORDER BY ord) AS s3_paths,
               string_agg(s3_path_regex, '|' ORDER BY ord) AS s3_paths_regex
        FROM paths GROUP BY role_name, policy_arn""",
    "saved_location_document": f"""
        SELECT {_DOCUMENT} FROM header UNION ALL SELECT {_DOCUMENT} FROM location_resources
        UNION ALL SELECT {_DOCUMENT} FROM location_data_sources
        UNION ALL SELECT {_DOCUMENT} FROM location_grant_blocks""",
    "hcl_location_document": f"""
        SELECT {_DOCUMENT} FROM header UNION ALL SELECT {_DOCUMENT} FROM location_resources
        UNION ALL SELECT {_DOCUMENT} FROM location_data_sources
        UNION ALL SELECT {_DOCUMENT} FROM location_grant_blocks""",
    # storage and volumes
    "bucket_inventory": "SELECT bucket_name FROM bucket_keys",
    "bucket_folders": """
        SELECT DISTINCT bucket_name, concat(split_part(object_key, '/', 1), '/') AS folder
        FROM object_keys WHERE strpos(object_key, '/') > 0""",
    "external_locations": f"SELECT {_LOCATION} FROM ext_locations",
    "location_bucket_parse": """
        SELECT ext_loc_name, url, regexp_extract(url, '^(s3a?://[^/]+)', 1) AS s3_bucket_url,
               regexp_extract(url, '^s3a?://([^/]+)', 1) AS s3_bucket_name
        FROM ext_locations""",
    "volumes": "SELECT * FROM volumes",
    "hcl_volumes": f"SELECT {_DOCUMENT} FROM volume_blocks",
    "hcl_volume_document": f"SELECT {_DOCUMENT} FROM header UNION ALL SELECT {_DOCUMENT} FROM volume_blocks",
    "hcl_text_roundtrip": """
        SELECT row_number() OVER (ORDER BY section, label, block, part, item, line_at) AS line_no, line
        FROM (SELECT section, label, block, part, item, unnest(string_split(output, chr(10))) AS line,
                     unnest(range(len(string_split(output, chr(10))))) AS line_at
              FROM (SELECT * FROM header UNION ALL SELECT * FROM object_grant_blocks))""",
    "document_counts": """
        SELECT f.n_files, count(*) AS n_pieces, count(*) FILTER (part = 0) AS counted_blocks,
               count(*) FILTER (part = 0) AS n_blocks, count(*) FILTER (part = 1) AS n_grants
        FROM (SELECT * FROM header UNION ALL SELECT * FROM object_grant_blocks)
        CROSS JOIN (VALUES (1), (4), (16)) AS f(n_files)
        GROUP BY f.n_files""",
    # privileges
    "privilege_map": """
        SELECT g.action_type, coalesce(m.privileges, '') AS privileges, count(*) AS n_rows
        FROM grants g
        LEFT JOIN (SELECT legacy, string_agg(privilege, ',' ORDER BY privilege DESC) AS privileges
                   FROM privilege_map GROUP BY legacy) m ON m.legacy = upper(g.action_type)
        GROUP BY g.action_type, m.privileges""",
    "grant_object_type": "SELECT object_type, count(*) AS n_rows FROM grants GROUP BY object_type",
    "grant_object_name": """
        SELECT cat AS catalog, db AS "database", tab AS "table", vw AS "view", object_type, object_name, count(*) AS n_rows
        FROM grants GROUP BY ALL""",
    "privileges_by_object_type": """
        SELECT g.object_type, g.action_type, coalesce(t.privileges, '') AS privileges, count(*) AS n_rows
        FROM grants g
        LEFT JOIN (SELECT object_type, legacy, string_agg(privilege, ',' ORDER BY privilege DESC) AS privileges
                   FROM type_privileges GROUP BY object_type, legacy) t
          ON t.legacy = upper(g.action_type) AND t.object_type = g.object_type
        GROUP BY g.object_type, g.action_type, t.privileges""",
    "principal_object_privileges": "SELECT * FROM entries",
    "object_grants": """
        SELECT e.object_type, e.object_name,
               CAST('0x' || substr(md5(e.principal), 1, 8) AS BIGINT) % 16 AS list_no,
               string_agg(e.principal, ';' ORDER BY e.principal) AS principals,
               string_agg(e.privileges, ';' ORDER BY e.principal) AS privileges,
               string_agg(e.legacy_privileges, ';' ORDER BY e.principal) AS legacy_privileges
        FROM grantable e
        GROUP BY ALL""",
    "dominant_object_type": """
        SELECT object_name, object_type
        FROM (SELECT object_name, object_type,
                     row_number() OVER (PARTITION BY object_name ORDER BY count(*) DESC, object_type) AS rn
              FROM entries GROUP BY object_name, object_type)
        WHERE rn = 1""",
    "hcl_object_grants": f"SELECT {_DOCUMENT} FROM object_grant_blocks",
    "hcl_acl_document": f"SELECT {_DOCUMENT} FROM header UNION ALL SELECT {_DOCUMENT} FROM object_grant_blocks",
    # addresses
    "address_map": f"""
        SELECT 'principal' AS kind, concat_ws(chr(10), principal_display_name, grantee) AS name, address
        FROM clashing_grantee_labels
        UNION ALL SELECT 'location', concat_ws(chr(10), ext_loc_name, created), address FROM clashing_location_labels
        UNION ALL SELECT 'volume', concat_ws(chr(10), {', '.join(_VOLUME)}), address FROM clashing_volume_addresses
        UNION ALL SELECT 'object', concat_ws(chr(10), object_type, object_name), address FROM clashing_object_addresses""",
    # libraries
    "library_inventory": "SELECT cluster_kind, jar, maven_coordinates FROM libraries",
    "library_classify": "SELECT artifact_type, artifact FROM artifacts",
    "allowlist_current": "SELECT artifact_type, artifact, match_type FROM allowlist",
    "allowlist_delta": "SELECT artifact_type, artifact, match_type FROM delta",
    "allowlist_delta_jar": "SELECT artifact_type, artifact, match_type FROM delta WHERE artifact_type = 'jar'",
    "allowlist_delta_maven": "SELECT artifact_type, artifact, match_type FROM delta WHERE artifact_type = 'maven'",
    "allowlist_desired": "SELECT artifact_type, artifact, match_type FROM desired",
    "allowlist_payload": """
        SELECT artifact_type, 0 AS part, '' AS item, '{"artifact_matchers":[' AS output FROM desired GROUP BY artifact_type
        UNION ALL SELECT artifact_type, 2, '', ']}' FROM desired GROUP BY artifact_type
        UNION ALL
        SELECT artifact_type, 1, concat(artifact, chr(10), match_type),
               concat(CASE WHEN concat(artifact, chr(10), match_type)
                                = min(concat(artifact, chr(10), match_type)) OVER (PARTITION BY artifact_type)
                           THEN '' ELSE ',' END,
                      '{"artifact":"', artifact, '","match_type":"', match_type, '"}')
        FROM desired""",
    # counts and audits
    "pipeline_counts": """
        SELECT 'principals' AS relation, count(*) AS n_rows FROM public_principals
        UNION ALL SELECT 'governance', count(*) FROM governance
        UNION ALL SELECT 'external_locations', count(*) FROM ext_locations
        UNION ALL SELECT 'volumes', count(*) FROM volumes
        UNION ALL SELECT 'principal_object_privileges', count(*) FROM entries
        UNION ALL SELECT 'allowlist_delta', count(*) FROM delta""",
    "sanitize_labels": f"""
        SELECT 'location' AS kind, ext_loc_name AS name, {_label('ext_loc_name')} AS label FROM ext_locations
        UNION ALL
        SELECT DISTINCT 'principal', principal_display_name, {_label('principal_display_name')} FROM public_principals
        UNION ALL
        SELECT DISTINCT 'object', object_name, {_label('object_name')} FROM entries""",
    "unmapped_privileges": """
        SELECT g.action_type, g.object_type,
               CASE WHEN g.principal IS NULL THEN 'no_principal' WHEN g.object_type = 'UNKNOWN' THEN 'unknown_object'
                    WHEN upper(g.action_type) NOT IN (SELECT legacy FROM privilege_map) THEN 'unmapped'
                    ELSE 'not_allowed_on_type' END AS reason,
               count(*) AS n_rows
        FROM grants g
        WHERE g.principal IS NULL OR g.object_type = 'UNKNOWN'
           OR NOT EXISTS (SELECT 1 FROM type_privileges t
                          WHERE t.object_type = g.object_type AND t.legacy = upper(g.action_type))
        GROUP BY ALL""",
    "statement_conditions": """
        SELECT p.policy_arn, p.statement_no, p.sid, p.effect, c.operator, c.condition_key,
               replace(c.condition_values, '?', CAST(p.ord % 5 AS VARCHAR)) AS condition_values
        FROM (SELECT policy_arn, concat('s', CAST(ord AS VARCHAR)) AS sid, effect, ord,
                     row_number() OVER (PARTITION BY role_name, policy_arn ORDER BY ord) - 1 AS statement_no
              FROM policy_resources) p
        JOIN (VALUES (3, 'StringEquals', 'aws:SourceVpc', 'vpc-?'), (3, 'Bool', 'aws:SecureTransport', 'true'),
                     (5, 'IpAddress', 'aws:SourceIp', '10.0.0.0/8,192.168.0.0/16'), (5, 'IpAddress', 'x:Own', '1'),
                     (9, NULL, NULL, 'odd')) AS c(remainder, operator, condition_key, condition_values)
          ON c.remainder = p.ord % 13""",
    "dropped_resources": """
        SELECT p.role_name, p.policy_arn, p.resource AS subject, l.reason
        FROM policy_resources p
        JOIN (VALUES (13, 3, 'conditional'), (13, 5, 'conditional'), (13, 9, 'conditional'), (7, 1, 'action_limited'),
                     (7, 3, 'action_limited'), (7, 4, 'action_limited')) AS l(divisor, remainder, reason)
          ON p.ord % l.divisor = l.remainder
        WHERE effect = 'Allow' AND regexp_matches(resource, '^arn:aws:s3:::([^/]+)(/[*])?$')
        UNION ALL
        SELECT role_name, policy_arn, resource AS subject,
               CASE WHEN effect <> 'Allow' THEN 'not_allowed' WHEN resource NOT LIKE 'arn:aws:s3:::%' THEN 'not_storage'
                    ELSE 'inside_bucket' END AS reason
        FROM policy_resources
        WHERE effect <> 'Allow' OR NOT regexp_matches(resource, '^arn:aws:s3:::([^/]+)(/[*])?$')
        UNION ALL SELECT role_name, policy_arn, '', 'unreadable_document' FROM broken_policies
        UNION ALL SELECT role_name, policy_arn, '', 'no_document' FROM missing_policies
        UNION ALL SELECT role_name, policy_arn, sid, 'no_resource' FROM except_policies
        UNION ALL SELECT a.role_name, '', CAST(count(p.s3_path) AS VARCHAR), 'too_few_paths'
        FROM (SELECT role_name FROM policy_resources UNION SELECT role_name FROM broken_policies
              UNION SELECT role_name FROM missing_policies UNION SELECT role_name FROM except_policies) a
        LEFT JOIN paths p ON p.role_name = a.role_name
        GROUP BY a.role_name HAVING count(p.s3_path) <= 5""",
    "incomplete_blocks": "SELECT kind, subject, missing FROM unfinished WHERE missing <> ''",
    "block_counts": """
        SELECT kind, count(*) AS n_rows, count(*) FILTER (missing = '') AS n_blocks,
               count(*) FILTER (missing <> '') AS n_rejected
        FROM unfinished GROUP BY kind""",
    "label_collisions": f"""
        SELECT kind, {_label('name')} AS label, count(*) AS n_names, min(name) AS first_name, max(name) AS last_name
        FROM (SELECT DISTINCT 'principal' AS kind, principal_display_name AS name, grantee AS owner
              FROM (SELECT principal_display_name,
                           CASE WHEN principal_type = 'USER' AND email_value IS NOT NULL THEN email_value
                                WHEN principal_type = 'SERVICE_PRINCIPAL' AND application_id IS NOT NULL THEN application_id
                                ELSE principal_display_name END AS grantee
                    FROM public_principals)
              UNION SELECT 'location', ext_loc_name, '' FROM ext_locations
              UNION SELECT DISTINCT 'object', object_name, '' FROM entries
              UNION SELECT DISTINCT 'volume', concat(ext_loc_label, '_', volume_label), concat(s3_bucket_url, chr(10), volume, chr(10), catalog_name, chr(10), schema_name)
                    FROM volumes
              UNION SELECT DISTINCT 'artifact', artifact, '' FROM artifacts)
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "bucket_map_duplicates": """
        SELECT s3_bucket_url, count(*) AS n_rows FROM bucket_map GROUP BY s3_bucket_url HAVING count(*) > 1""",
    "unsearchable_paths": r"""
        SELECT DISTINCT s3_path FROM held_paths
        WHERE regexp_matches(s3_path, '[\\^$|(){}\[\]+]|[?][?][?]|[*][?][?]')""",
}


def _needed(sql: str, found: set[str]) -> set[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    for name in words & (RELATIONS.keys() - found):
        # A relation may share its name with a table or a column; only FROM and JOIN use it.
        if re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", sql):
            found.add(name)
            _needed(RELATIONS[name], found)
    return found


def statements() -> dict[str, str]:
    result = {}
    for name, sql in QUERIES.items():
        needed = _needed(sql, set())
        relations = [f"{r} AS ({RELATIONS[r]}\n)" for r in RELATIONS if r in needed]
        prefix = "WITH " + ",\n".join(relations) + "\n" if relations else ""
        result[name] = prefix + sql
    return result
