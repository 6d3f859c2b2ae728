"""Input relations derived from the test tables.

The test tables are a star schema; every relation here is computed from them by Spark and grows
with them.  Principals, policies, libraries and the allowlist come in the raw nested forms in which
exports are landed.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantline.plans.governance import PolicyExports
from grantline.schemas import PRINCIPAL
from grantline.sinks.shared import stage
from grantline.sources import libraries as library_source, policies, principals, storage

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_returnflag string"
    ),
}

BUCKET = "concat(lower(p_type), '-', lower(replace(p_brand, '#', '-')))"
ARTIFACT = "replace(p_name, ' ', '-')"
JAR = f"concat('s3://libs/', {ARTIFACT}, '.jar')"
RESOURCE = f"""CASE p_size % 5
      WHEN 0 THEN concat('arn:aws:s3:::', {BUCKET})
      WHEN 1 THEN concat('arn:aws:s3:::', {BUCKET}, '/*')
      WHEN 2 THEN concat('arn:aws:s3:::', lower(p_type), if(p_partkey % 3 = 0, '-brand-???', '-*/*'))
      WHEN 3 THEN concat('arn:aws:s3:::', {BUCKET}, '/prefix/*')
      ELSE concat('arn:aws:sqs:us-east-1:1:', {BUCKET}) END"""
MAVEN = f"concat('org.', lower(p_type), ':', {ARTIFACT}, ':1.', p_size)"


def _slots(number: str) -> str:
    """0 .. number-1, nothing for 0."""
    return f"filter(sequence(0, greatest(cast({number} AS int) - 1, 0)), n -> n < {number})"


def _member(value: str) -> str:
    """A reference cell of an identity record."""
    empty = "cast(null AS string)"
    return (
        f"named_struct('$ref', {empty}, 'value', {value}, 'display', {empty},"
        f" 'primary', {empty}, 'type', {empty})"
    )


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # --- principals ------------------------------------------------------------------------------
    def principal_records(self, kind: str) -> DataFrame:
        """Identity records of one kind; every 499th is repeated, as overlapping pages do."""
        table, key, name = {
            "USER": ("customer", "c_custkey", "c_name"),
            "SERVICE_PRINCIPAL": ("supplier", "s_suppkey", "s_name"),
            "GROUP": ("nation", "n_nationkey", "n_name"),
        }[kind]
        has_email = f"{key} % 10 <> 0" if kind == "USER" else "false"
        email = _member(f"concat('u', {key}, '@example.com')")
        arn = (
            "concat('arn:aws:iam::123456789012:instance-profile/ip-',"
            f" (cast({key} AS bigint) * 7 + n * (13 + cast({key} AS bigint) div 25)) % 25)"
        )
        # Some users share their name with another one.
        if kind == "USER":
            name = "if(c_custkey % 400 = 399, concat('Twin ', c_custkey div 800), c_name)"
        application = f"concat('app-', {key})" if kind == "SERVICE_PRINCIPAL" else "cast(null AS string)"
        records = self.table(table).selectExpr(
            f"{name} AS displayName",
            f"filter(array({email}), e -> {has_email}) AS emails",
            f"cast({key} AS string) AS id",
            f"if({key} % 4 > 0, transform({_slots(f'{key} % 4')}, n -> {_member(arn)}), null) AS roles",
            f"{application} AS applicationId",
            f"if({key} % 499 = 0, 2, 1) AS copies",
        )
        repeated = records.withColumn("copy", F.expr("explode(sequence(1, copies))"))
        return repeated.drop("copies", "copy").to(PRINCIPAL)

    def principals(self) -> DataFrame:
        """Records of all kinds, tagged."""
        kinds = ["USER", "SERVICE_PRINCIPAL", "GROUP"]
        return principals.all_principals(
            *[principals.tag_principals(self.principal_records(kind), kind) for kind in kinds]
        )

    def principal_lines(self, kind: str) -> DataFrame:
        """Landed lines of one kind, some of them damaged, some with fields that no schema has."""
        record = F.to_json(F.struct(*PRINCIPAL.names))
        number = F.col("id").cast("bigint")
        line = (
            F.when(number % 20 == 3, F.concat(F.lit('{"displayName":"x","id":"'), "id"))
            .when(number % 20 == 4, F.concat(F.lit('["'), "id", F.lit('"]')))
            .when(number % 20 == 5, F.concat(F.lit('{"id":"'), "id", F.lit('","emails":"none"}')))
            .when(number % 20 == 6, F.concat(F.lit('{"displayName":"'), "id", F.lit('"}')))
            .when(number % 20 == 7, F.concat(F.lit('{"id":"'), "id", F.lit('","nickName":"x","emails":[{"value":"v","sent":1}]}')))
            .otherwise(record)
        )
        return self.principal_records(kind).select(line.alias("value"))

    def profile_lines(self) -> DataFrame:
        """Profile documents; of every ten, one is cut off and one is another document."""
        return self.profile_documents().selectExpr(
            "profile_name",
            """CASE cast(substring(profile_name, 4) AS int) % 10 WHEN 8 THEN '{"InstanceProfile":{"Roles":[' WHEN 9 THEN '{"Message":"no"}'
                 ELSE document END AS document""",
        )

    # --- profiles, roles, policies ---------------------------------------------------------------
    def profile_documents(self) -> DataFrame:
        role = "named_struct('RoleName', concat('role-', n_nationkey))"
        profile = f"named_struct('InstanceProfile', named_struct('Roles', array({role})))"
        return self.table("nation").selectExpr(
            "concat('ip-', n_nationkey) AS profile_name", f"to_json({profile}) AS document"
        )

    def profile_roles(self) -> DataFrame:
        return policies.profile_roles(self.profile_documents())

    def policy_resources(self) -> DataFrame:
        """Flat form: role_name, policy_arn, ord, effect, resource."""
        # Roles 20 to 24 have a few parts only; the others share theirs.
        role = "if(p_partkey % 25 < 20 OR p_partkey < 100, p_partkey % 25, p_partkey % 20)"
        return self.table("part").selectExpr(
            f"concat('role-', {role}) AS role_name",
            f"concat('pol-', p_partkey % 50, '-', {role}) AS policy_arn",
            "p_partkey AS ord",
            "if(p_partkey % 11 = 0, 'Deny', 'Allow') AS effect",
            f"{RESOURCE} AS resource",
        )

    def _policy_documents(self, resources: DataFrame) -> DataFrame:
        """Documents per role and policy, at most 40 statements each, as policies are limited.

        A single statement is written as one object, several as a list; resources of even number
        are written as a text, others as a list of one.
        """
        # Consecutive numbers of one policy are 50 apart, so 2000 numbers hold at most 40 of them.
        # Some statements hold under conditions only, or for some actions.
        limits = """concat(
            CASE ord % 13 WHEN 3 THEN concat(',"Condition":{"StringEquals":{"aws:SourceVpc":"vpc-', ord % 5,
                                             '"},"Bool":{"aws:SecureTransport":["true"]}}')
              WHEN 5 THEN ',"Condition":{"IpAddress":{"aws:SourceIp":["10.0.0.0/8","192.168.0.0/16"],"x:Own":1}}'
              WHEN 7 THEN ',"Condition":{}' WHEN 9 THEN ',"Condition":"odd"' ELSE '' END,
            CASE ord % 7 WHEN 1 THEN ',"Action":"s3:GetObject"' WHEN 2 THEN ',"Action":["s3:Get*","s3:*"]'
              WHEN 3 THEN ',"Action":["s3:Get*","s3:List*"]' WHEN 4 THEN ',"NotAction":"s3:DeleteObject"'
              WHEN 5 THEN ',"Action":"*"' ELSE '' END) AS limits"""
        statements = resources.selectExpr("*", limits).selectExpr(
            "role_name",
            "concat(policy_arn, '/', ord div 2000) AS policy_arn",
            """struct(ord, concat('{"Sid":"s', ord, '","Effect":"', effect, '","Resource":',
               if(ord % 2 = 0, concat('"', resource, '"'), to_json(array(resource))), limits, '}') AS text) AS entry""",
        )
        listed = statements.groupBy("role_name", "policy_arn").agg(
            F.sort_array(F.collect_list("entry")).alias("entries")
        )
        return listed.selectExpr(
            "role_name",
            "policy_arn",
            """concat('{"Version":"2012-10-17","Statement":',
               if(size(entries) = 1, entries[0].text, concat('[', array_join(entries.text, ','), ']')),
               '}') AS document""",
        )

    def _odd_documents(self) -> DataFrame:
        """Of every 100 parts, one gives a policy whose document is cut off, one a policy without a
        document, and one a policy that names what it leaves out, held by a role that has no other."""
        return self.table("part").filter("p_partkey % 100 < 3").selectExpr(
            "if(p_partkey % 100 = 2, concat('lone-', p_partkey), concat('role-', p_partkey % 25)) AS role_name",
            "concat(array('broken-', 'missing-', 'except-')[p_partkey % 100], p_partkey) AS policy_arn",
            """CASE p_partkey % 100 WHEN 0 THEN '{"Version":"2012-10-17","Statement":['
                 WHEN 2 THEN concat('{"Version":"2012-10-17","Statement":{"Sid":"e', p_partkey,
                                    '","Effect":"Allow","NotResource":"arn:aws:s3:::x"}}') END AS document""",
        )

    def policy_exports(self) -> PolicyExports:
        documents = self._policy_documents(self.policy_resources()).unionByName(self._odd_documents())
        return self._exports(self.profile_roles(), documents)

    def _exports(self, profile_roles: DataFrame, documents: DataFrame) -> PolicyExports:
        versions = documents.filter("document IS NOT NULL").selectExpr(
            "policy_arn", "stack(2, 'v1', '{}', 'v2', document) AS (version_id, document)"
        )
        return PolicyExports(
            profile_roles=profile_roles,
            attached=documents.select("role_name", "policy_arn"),
            policies=documents.selectExpr("policy_arn", "'v2' AS default_version_id"),
            versions=versions,
        )

    # --- as many roles as suppliers, as many role sets as customers ------------------------------
    def supplier_principals(self) -> DataFrame:
        """Customers with a profile for every supplier of the first line of one of their orders."""
        first = self.table("lineitem").filter("l_linenumber = 1").select("l_orderkey", "l_suppkey")
        held = (
            self.table("orders")
            .join(first, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("o_custkey")
            .agg(F.sort_array(F.collect_set("l_suppkey")).alias("suppliers"))
        )
        arn = "concat('arn:aws:iam::123456789012:instance-profile/sup-', s)"
        email = _member("concat('u', c_custkey, '@example.com')")
        records = self.table("customer").join(held, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
            "c_name AS displayName",
            f"filter(array({email}), e -> c_custkey % 10 <> 0) AS emails",
            "cast(c_custkey AS string) AS id",
            f"transform(suppliers, s -> {_member(arn)}) AS roles",
            "cast(null AS string) AS applicationId",
        )
        return principals.tag_principals(records.to(PRINCIPAL), "USER")

    def supplier_exports(self) -> PolicyExports:
        """A role per supplier, whose policies name the buckets of all parts that the supplier delivers."""
        profile = "named_struct('InstanceProfile', named_struct('Roles', array(named_struct('RoleName', concat('sup-', s_suppkey)))))"
        profiles = self.table("supplier").selectExpr(
            "concat('sup-', s_suppkey) AS profile_name", f"to_json({profile}) AS document"
        )
        delivered = self.table("lineitem").select("l_suppkey", "l_partkey").distinct()
        resources = delivered.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
            "concat('sup-', l_suppkey) AS role_name",
            "concat('sup-', l_suppkey, '-', p_partkey % 50) AS policy_arn",
            "p_partkey AS ord",
            "if(p_partkey % 11 = 0, 'Deny', 'Allow') AS effect",
            f"{RESOURCE} AS resource",
        )
        # The documents are read for what is attached, for the policies and for their versions.
        return self._exports(policies.profile_roles(profiles), stage(self._policy_documents(resources)))

    # --- storage ---------------------------------------------------------------------------------
    def _bucket_keys(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(F.expr(BUCKET).alias("bucket_name"))
            .agg(F.min("p_partkey").alias("k"))
        )

    def buckets(self) -> DataFrame:
        return storage.buckets(self.table("part").selectExpr(f"{BUCKET} AS bucket_name"))

    def location_inventory(self) -> DataFrame:
        tail = "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '/data/' END"
        return self._bucket_keys().filter("k % 2 = 0").selectExpr(
            "concat('Loc ', bucket_name) AS name",
            "concat('cred_', k % 3) AS credential_name",
            "'' AS credential_id",
            f"concat('s3://', bucket_name, {tail}) AS url",
        )

    def locations(self) -> DataFrame:
        return storage.external_locations(self.location_inventory())

    def folders(self) -> DataFrame:
        slots = self._bucket_keys().selectExpr(
            "bucket_name", "k", f"explode({_slots('k % 4')}) AS r_regionkey"
        )
        return slots.join(self.table("region"), "r_regionkey").selectExpr(
            "bucket_name", "concat(lower(r_name), '.v', k % 4, '/') AS folder"
        )

    def bucket_map(self) -> DataFrame:
        """One bucket in four is mapped, some of them twice."""
        mapped = self._bucket_keys().filter("k % 4 = 0")
        return mapped.withColumn("copy", F.expr("explode(sequence(0, if(k % 8 = 0, 1, 0)))")).selectExpr(
            "concat('s3://', bucket_name) AS s3_bucket_url",
            "concat('catalog', (k + copy) % 3) AS catalog_name",
            "concat('schema', k % 5) AS schema_name",
        )

    def object_keys(self) -> DataFrame:
        """Object inventory: an order is an object in the bucket of each of its parts."""
        path = "concat('f.', o_orderkey % 6, '/y=', o_orderkey % 4, '/part-', o_orderkey)"
        objects = self.table("orders").selectExpr(
            "o_orderkey", f"if(o_orderkey % 13 = 0, concat('file-', o_orderkey), {path}) AS object_key"
        )
        places = self.table("lineitem").selectExpr("l_orderkey AS o_orderkey", "l_partkey AS p_partkey")
        parts = self.table("part").selectExpr("p_partkey", f"{BUCKET} AS bucket_name")
        return objects.join(places, "o_orderkey").join(parts, "p_partkey").select("bucket_name", "object_key")

    def unfinished(self) -> dict[str, DataFrame]:
        """Rows for each kind of block, some of which lack a field."""
        location = self._bucket_keys().selectExpr(
            "if(k % 13 = 0, null, concat('New ', bucket_name)) AS ext_loc_name",
            "if(k % 7 = 0, null, concat('cred_', k % 3)) AS credential_name",
            "if(k % 11 = 0, null, concat('s3://', bucket_name)) AS url",
        )
        grant = self.table("customer").selectExpr(
            "if(c_custkey % 17 = 0, null, c_name) AS principal_display_name",
            "if(c_custkey % 19 = 0, null, concat('u', c_custkey)) AS grantee",
            "if(c_custkey % 5 = 0, null, concat('Loc ', c_custkey % 7)) AS ext_loc_name",
        )
        volume = self.table("part").selectExpr(
            "concat('loc_', lower(p_type)) AS ext_loc_label", "concat('v_', p_size) AS volume_label",
            "concat('v.', p_size, '/') AS volume", "if(p_partkey % 9 = 0, null, 'main') AS catalog_name",
            "if(p_partkey % 6 = 0, null, 'landing') AS schema_name", f"concat('s3://', {BUCKET}) AS s3_bucket_url",
        )
        return {"location": location, "registered_location": location, "location_grant": grant, "volume": volume}

    # --- names whose labels clash ----------------------------------------------------------------
    def clashing_grantees(self) -> DataFrame:
        """Names that differ in signs only, namesakes, and names that go on where others end."""
        return self.table("customer").selectExpr(
            "CASE c_custkey % 4 WHEN 0 THEN concat('Team ', c_custkey % 30) WHEN 1 THEN concat('Team.', c_custkey % 30)"
            " WHEN 2 THEN concat('Team ', c_custkey % 30, ' Loc') ELSE c_name END AS principal_display_name",
            "concat('u', c_custkey % 40, '@example.com') AS grantee",
        ).distinct()

    def clashing_locations(self) -> DataFrame:
        """Names that differ in signs only, names with the mark of another one, and ends of others."""
        name = "concat('Loc ', lower(p_type), array('.', '_', '-')[p_partkey % 3], p_size % 10)"
        mark = f"substring(md5(concat({name}, '\\ntrue')), 1, 8)"
        plain = f"lower(regexp_replace({name}, '[^a-zA-Z0-9_]', '_'))"
        return self.table("part").selectExpr(
            f"CASE p_partkey % 7 WHEN 0 THEN concat({plain}, '_', {mark}) WHEN 1 THEN concat(p_type, ' ', p_size % 10)"
            f" ELSE {name} END AS ext_loc_name",
            "p_partkey % 5 <> 4 AS created",
        ).distinct()

    def clashing_volumes(self) -> DataFrame:
        """Folders of one bucket that differ in signs only, and one folder in several schemas."""
        return self.table("part").selectExpr(
            "concat('loc_', lower(p_type)) AS ext_loc_label",
            "concat('v_', p_size % 10) AS volume_label",
            "concat('v', array('.', '_')[p_partkey % 2], p_size % 10, '/') AS volume",
            "'main' AS catalog_name",
            "concat('schema', p_size % 2) AS schema_name",
            f"concat('s3://', {BUCKET}) AS s3_bucket_url",
        )

    def clashing_objects(self) -> DataFrame:
        """Objects whose dotted names differ in dots and underscores only."""
        return self.table("part").selectExpr(
            "array('TABLE', 'SCHEMA')[p_partkey % 2] AS object_type",
            "concat('cat', array('.', '_')[p_size % 2], lower(p_type), array('.', '_')[p_partkey % 3 % 2], p_size % 12) AS object_name",
        ).distinct()

    # --- legacy grants ---------------------------------------------------------------------------
    def grants(self) -> DataFrame:
        actions = (
            "'ALL PRIVILEGES', 'READ_METADATA', 'USAGE', 'select', 'SELECT', 'CREATE', 'MODIFY',"
            " 'CREATE_NAMED_FUNCTION', 'OWN'"
        )
        return self.table("lineitem").selectExpr(
            "if(l_orderkey % 97 = 0, null, concat('u', l_suppkey)) AS principal",
            f"array({actions})[cast(l_quantity AS int) % 9] AS action_type",
            "if(l_linenumber = 7, null, concat('cat_', lower(l_returnflag))) AS catalog",
            "if(l_linenumber IN (1, 7), null, concat('db_', l_orderkey % 5)) AS database",
            "if(l_linenumber IN (3, 4, 5), concat('t_', l_partkey % 40), null) AS table",
            "if(l_linenumber = 6, concat('v_', l_partkey % 10), null) AS view",
        )

    # --- libraries -------------------------------------------------------------------------------
    def _clusters(self, kind: int) -> DataFrame:
        """Clusters of one kind, a library each."""
        jar = f"""
            CASE p_size % 4 WHEN 0 THEN {JAR}
              WHEN 1 THEN concat('/Volumes/main/libs/', {ARTIFACT}, '.jar')
              WHEN 2 THEN concat('dbfs:/libs/', {ARTIFACT}, '.jar') END"""
        maven = f"if(p_size % 4 = 3 OR p_size % 8 = 0, named_struct('coordinates', {MAVEN}), null)"
        return self.table("part").filter(f"p_partkey % 2 = {kind}").selectExpr(
            "cast(p_partkey AS string) AS cluster_id",
            f"array(named_struct('jar', {jar}, 'maven', {maven})) AS libraries",
        )

    def libraries(self) -> DataFrame:
        return library_source.library_inventory(self._clusters(0), self._clusters(1))

    def allowlist_documents(self) -> DataFrame:
        """Snapshot pages of the current allowlist, at most 100 entries each."""
        entries = (
            self.table("part")
            .filter("p_partkey % 7 = 0 AND p_size % 4 IN (0, 3)")
            .selectExpr(
                "if(p_size % 4 = 0, 'jar', 'maven') AS artifact_type",
                f"if(p_size % 4 = 0, {JAR}, {MAVEN}) AS artifact",
                "if(p_partkey % 3 = 0, 'EXACT_MATCH', 'PREFIX_MATCH') AS match_type",
                "p_partkey",
            )
            .groupBy("artifact_type", "artifact", "match_type")
            .agg(F.min("p_partkey").alias("first_key"))
        )
        entry = F.expr("struct(artifact, match_type)")
        pages = entries.groupBy("artifact_type", F.expr("first_key div 700").alias("page")).agg(
            F.collect_list(entry).alias("artifact_matchers")
        )
        return pages.selectExpr("artifact_type", "to_json(struct(artifact_matchers)) AS document")

    def allowlist(self) -> DataFrame:
        return library_source.current_allowlist(self.allowlist_documents())
