import random

import pytest
from pyspark.sql import functions as F

from grantline import fixed
from grantline.functions.paths import bucket_pattern, path_pattern
from grantline.operators import access, documents
from grantline.plans.governance import Governance
from grantline.plans.locations import grant_labels, location_document, plan_locations

LOCATION_SCHEMA = "ext_loc_name string, credential_name string, credential_id string, url string, created boolean"


def governance(spark, holdings, lists):
    """``holdings``: (kind, name, e-mail, application, role); ``lists``: (role, paths)."""
    data = [
        (kind, f"id-{name}", name, email, app, "arn", role, None if role is None else 9)
        for kind, name, email, app, role in holdings
    ]
    schema = (
        "principal_type string, principal_id string, principal_display_name string, email_value string,"
        " application_id string, instance_profile_arn string, role_name string, n_paths bigint"
    )
    path_lists = spark.createDataFrame(
        [(role, f"policy-{role}", paths) for role, paths in lists],
        "role_name string, policy_arn string, s3_paths array<string>",
    ).withColumn("s3_paths_regex", F.transform("s3_paths", path_pattern))
    return Governance(spark.createDataFrame(data, schema), path_lists)


def locations(spark, *urls):
    data = [(f"Loc {url[5:].rstrip('/')}", "cred", "id", url, True) for url in urls]
    return spark.createDataFrame(data, LOCATION_SCHEMA)


def granted(g, plan):
    labels = grant_labels(g, plan.role_locations)
    return access.location_grants(g.access, plan.role_locations, labels.grantees, labels.locations)


def own_labels(frame):
    return frame.select("ext_loc_name", "created").distinct().withColumn("ext_loc_label", F.lower("ext_loc_name"))


def buckets(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "bucket_name string")


def reached(spark, rows, paths, urls, **options):
    g = governance(spark, [("USER", "ann", None, None, "r")], [("r", paths)])
    plan = plan_locations(g, locations(spark, *urls), **options)
    return [u for (u,) in rows(access.location_access(g.access, plan.role_locations), "url")]


def test_default_match_finds_the_pattern_anywhere(spark, rows):
    urls = ["s3://foo", "s3://foo2/x", "s3://a-b/", "s3://axb/"]
    assert reached(spark, rows, ["s3://foo"], urls) == ["s3://foo", "s3://foo2/x"]
    assert reached(spark, rows, ["s3://foo/*"], urls) == []
    assert reached(spark, rows, ["s3://a.b/*"], urls) == ["s3://a-b/", "s3://axb/"]


def test_anchored_match_compares_whole_bucket_names(spark, rows):
    urls = ["s3://foo", "s3://foo2/x", "s3a://foo/y", "s3://a.b/", "s3://axb/"]
    assert reached(spark, rows, ["s3://foo"], urls, anchored=True) == ["s3://foo", "s3a://foo/y"]
    assert reached(spark, rows, ["s3://foo/*"], urls, anchored=True) == ["s3://foo", "s3a://foo/y"]
    assert reached(spark, rows, ["s3://a.b/*"], urls, anchored=True) == ["s3://a.b/"]
    assert len(reached(spark, rows, ["s3://foo*"], urls, anchored=True)) == 3


def test_each_principal_reaches_a_location_once(spark, rows):
    g = governance(
        spark,
        [
            ("USER", "ann", "a@x", None, "r"),
            ("USER", "ann", "a@x", None, "s"),
            ("USER", "bob", None, None, "s"),
            ("USER", "cid", None, None, None),
            ("GROUP", None, None, None, "r"),
        ],
        [("r", ["s3://a", "s3://a/*"]), ("s", ["s3://a*", "s3://b"]), ("t", ["s3://c"])],
    )
    plan = plan_locations(g, locations(spark, "s3://a/", "s3://b/", "s3://c/"))
    assert rows(access.location_access(g.access, plan.role_locations), "principal_display_name", "url") == [
        ("ann", "s3://a/"),
        ("ann", "s3://b/"),
        ("bob", "s3://a/"),
        ("bob", "s3://b/"),
    ]


def test_grantees_that_share_name_and_address_are_granted_once(spark, rows):
    g = governance(
        spark,
        [("USER", "ann", None, None, "r"), ("GROUP", "ann", None, None, "s")],
        [("r", ["s3://a"]), ("s", ["s3://a", "s3://b"])],
    )
    plan = plan_locations(g, locations(spark, "s3://a", "s3://b"))
    grants = granted(g, plan)
    assert rows(grants, "grantee", "ext_loc_name") == [("ann", "Loc a"), ("ann", "Loc b")]


def test_uncovered_and_covered_patterns_make_up_all_patterns(spark, rows):
    g = governance(
        spark,
        [("USER", "ann", None, None, "r")],
        [("r", ["s3://a", "s3://b", "s3://c*", "s3://${x}"]), ("unheld", ["s3://z"])],
    )
    patterns = access.governance_patterns(g.access, g.path_lists)
    matches = access.pattern_locations(patterns, locations(spark, "s3://a/x"))
    uncovered = access.uncovered_patterns(patterns, matches)
    assert rows(access.unregistered_patterns(patterns, locations(spark, "s3://a/x"))) == rows(uncovered)
    assert rows(matches, "s3_path") == [("s3://a",)]
    assert rows(uncovered, "s3_path") == [("s3://b",), ("s3://c*",)]
    assert rows(access.unsearchable_paths(patterns)) == [("s3://${x}",)]


def test_proposals_carry_the_real_bucket_and_reach_their_grants(spark, rows):
    g = governance(
        spark,
        [("USER", "ann", None, None, "r"), ("USER", "bob", None, None, "s")],
        [("r", ["s3://foo*", "s3://bar/*"]), ("s", ["s3://old"])],
    )
    plan = plan_locations(
        g,
        locations(spark, "s3://old/"),
        buckets(spark, "my-foo-x", "foo-x", "bar", "barn", "old"),
        create_new=True,
        credential_name="cred-new",
    )
    new = plan.locations.filter("NOT created")
    assert rows(new, "ext_loc_name", "credential_name", "credential_id", "url") == [
        ("bar", "cred-new", "", "s3://bar"),
        ("foo-x", "cred-new", "", "s3://foo-x"),
    ]
    assert rows(access.location_access(g.access, plan.role_locations), "principal_display_name", "url") == [
        ("ann", "s3://bar"),
        ("ann", "s3://foo-x"),
        ("bob", "s3://old/"),
    ]


def test_new_locations_need_buckets_and_credential(spark):
    g = governance(spark, [("USER", "ann", None, None, "r")], [("r", ["s3://a"])])
    with pytest.raises(ValueError):
        plan_locations(g, locations(spark, "s3://a"), create_new=True, credential_name="c")
    with pytest.raises(ValueError):
        plan_locations(g, locations(spark, "s3://a"), buckets(spark, "a"), create_new=True)


def test_document_has_its_sections_in_order(spark):
    g = governance(
        spark,
        [("USER", 'An "n"', "a@x", None, "r")],
        [("r", ["s3://old", "s3://new"])],
    )
    document = location_document(
        g, locations(spark, "s3://old/"), buckets(spark, "new"), create_new=True, credential_name="c"
    )
    text = [row.output for row in document.orderBy("section", "label").collect()]
    assert text[0].startswith("terraform {\n")
    assert text[1] == fixed.LOCATION_RESOURCE.format(label="new", name="new", url="s3://new", credential="c")
    assert text[2] == fixed.LOCATION_DATA_SOURCE.format(label="loc_old", name="Loc old")
    grant = {"principal_label": "an__n_", "principal": "a@x"}
    assert text[3:] == [
        fixed.LOCATION_GRANT.format(label="loc_old", reference="data.", **grant),
        fixed.LOCATION_GRANT.format(label="new", reference="", **grant),
    ]
    assert '\tprivileges = ["ALL_PRIVILEGES"]\n}\n' in text[3]


def test_names_are_escaped_in_blocks(spark):
    g = governance(spark, [("GROUP", 'a"${b}', None, None, "r")], [("r", ["s3://a"])])
    document = location_document(g, locations(spark, "s3://a"))
    assert [row.output for row in document.filter("section = 3").collect()] == [
        fixed.LOCATION_GRANT.format(
            principal_label="a___b_", label="loc_a", reference="data.", principal='a\\"$${b}'
        )
    ]


def test_document_without_new_locations_has_no_resources(spark):
    g = governance(spark, [("USER", "ann", None, None, "r")], [("r", ["s3://a", "s3://b"])])
    document = location_document(g, locations(spark, "s3://a/"))
    assert sorted(row.section for row in document.collect()) == [0, 2, 3]


def test_one_name_with_both_flags_keeps_both_blocks(spark, rows):
    data = [("x", "c", "", "s3://x", True), ("x", "c", "", "s3://x", False)]
    frame = spark.createDataFrame(data, LOCATION_SCHEMA)
    assert len(rows(documents.location_resources(frame, own_labels(frame)))) == 1
    assert len(rows(documents.location_data_sources(frame, own_labels(frame)))) == 1


def test_incomplete_rows_give_no_block(spark, rows):
    frame = spark.createDataFrame([("x", None, "", "s3://x", False)], LOCATION_SCHEMA)
    assert rows(documents.location_resources(frame, own_labels(frame))) == []


def test_bucket_pattern(spark):
    frame = spark.createDataFrame([("s3://a/.*",), ("s3://a.*/.*",), ("s3://a",)], "p string")
    assert [r[0] for r in frame.select(bucket_pattern(F.col("p"))).collect()] == ["a.*", "a.*", "a"]


def test_hot_role_set_is_split_between_tasks(spark):
    """A role set that a third of all principals have: its partition of the join is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    number = F.col("id").cast("string")
    role = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 100))
    held = spark.range(0, 30000, 1, 16).select(
        F.lit("USER").alias("principal_type"),
        number.alias("principal_id"),
        F.concat(F.lit("name-"), number).alias("principal_display_name"),
        F.lit(None).cast("string").alias("email_value"),
        F.lit(None).cast("string").alias("application_id"),
        role.alias("role_name"),
    )
    roles = [("hot", n) for n in range(3)] + [(f"r{n}", n) for n in range(100)]
    role_locations = spark.createDataFrame(roles, "role_name string, n int").select(
        "role_name",
        F.concat(F.lit("Loc "), "n").alias("ext_loc_name"),
        F.lit("c").alias("credential_name"),
        F.lit("").alias("credential_id"),
        F.concat(F.lit("s3://b"), "n").alias("url"),
        F.lit(True).alias("created"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        result = access.location_access(held, role_locations)
        assert len(result.collect()) == 10000 * 3 + 20000
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_question_marks_match_whole_names_and_are_proposed(spark, rows):
    g = governance(spark, [("USER", "ann", None, None, "r")], [("r", ["s3://logs-???", "s3://log-?"])])
    patterns = access.governance_patterns(g.access, g.path_lists)
    found = access.pattern_locations(patterns, locations(spark, "s3://logs-abc", "s3://log-a"), anchored=True)
    assert rows(found, "s3_path", "url") == [("s3://log-?", "s3://log-a"), ("s3://logs-???", "s3://logs-abc")]
    uncovered = access.unregistered_patterns(patterns, locations(spark, "s3://log-a"))
    assert ("s3://logs-???",) in rows(uncovered, "s3_path")
    proposed = access.proposed_locations(uncovered, buckets(spark, "logs-xyz", "logs-long"), "c")
    assert rows(proposed.filter("s3_path = 's3://logs-???'"), "url") == [("s3://logs-xyz",)]


def test_namesakes_have_addresses_of_their_own(spark):
    g = governance(
        spark,
        [("USER", "Ann Lee", "a@x", None, "r"), ("USER", "Ann Lee", "b@x", None, "r"), ("USER", "bob", "c@x", None, "r")],
        [("r", ["s3://a"])],
    )
    plan = plan_locations(g, locations(spark, "s3://a"))
    labels = [r.principal_label for r in granted(g, plan).collect()]
    assert len(set(labels)) == 3 and "bob" in labels
    assert all(label == "bob" or label.startswith("ann_lee_") for label in labels)


def test_a_role_set_of_many_holders_is_divided_with_default_limits(spark, monkeypatch):
    monkeypatch.setattr(access, "HOLDERS_PER_PART", 100)
    holders = spark.range(1000).selectExpr(
        "'USER' AS principal_type", "cast(id AS string) AS principal_id", "concat('u', id) AS principal_display_name",
        "cast(null AS string) AS email_value", "cast(null AS string) AS application_id", "'r' AS role_name",
    )
    reached = access.reach(holders, spark.createDataFrame([("r", "loc")], "role_name string, ext_loc_name string"), ["principal_id"])
    assert reached.count() == 1000 and reached.distinct().count() == 1000
    assert "part" in reached._jdf.queryExecution().analyzed().toString()


def test_locations_are_written_out_by_many_tasks(spark):
    """Words of few bytes become many rows; adaptive execution would merge them into one task."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    holders = spark.range(3000).selectExpr(
        "concat('u', id) AS principal_id", "concat('u', id) AS principal_display_name", "'r' AS role_name"
    )
    role_locations = spark.range(100).selectExpr("'r' AS role_name", "concat('loc', id) AS ext_loc_name")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        reached = access.reach(holders, role_locations, ["principal_id"])
        per_task = [r.n for r in reached.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) == 300_000
        assert len(per_task) > access.EXPANDING_TASKS // 2 and max(per_task) < 30_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("groups", [1, 3, 256])
def test_reach_equals_brute_force_with_diverse_role_sets(spark, monkeypatch, groups):
    """Words with all 64 bits, several words in a group, roles that overlap, repeated rows and null columns."""
    monkeypatch.setattr(access, "LOCATION_GROUPS", groups)
    monkeypatch.setattr(access, "HOLDERS_PER_PART", 4)
    rng = random.Random(5)
    locations = [(f"loc{n}", None if n % 7 == 0 else f"s3://b{n}") for n in range(300)] + [(None, None)]
    role_locations = [(f"r{r}", *loc) for r in range(20) for loc in rng.sample(locations, rng.choice([1, 5, 64, 250]))]
    role_locations += [("all", *loc) for loc in locations] + role_locations[:50]
    held = [(str(p), f"r{r}") for p in range(60) for r in rng.sample(range(23), rng.randint(1, 6))]
    held += [(str(p), "all") for p in range(50, 80)] + [("99", None), ("98", "unknown")]
    governance = spark.createDataFrame(held, "principal_id string, role_name string").withColumn(
        "principal_display_name", F.concat(F.lit("p"), "principal_id")
    )
    found = access.reach(
        governance, spark.createDataFrame(role_locations, "role_name string, ext_loc_name string, url string"), ["principal_id"]
    )
    assert found.columns == ["principal_id", "ext_loc_name", "url"]
    expected = {(p, name, url) for p, held_role in held for role, name, url in role_locations if role == held_role}
    result = [tuple(r) for r in found.collect()]
    assert len(result) == len(expected) and set(result) == expected


def test_words_stand_for_up_to_64_locations(spark, monkeypatch):
    monkeypatch.setattr(access, "LOCATION_GROUPS", 1)
    pairs = spark.range(1280).selectExpr("concat('r', id % 2) AS role_name", "concat('loc', id div 2) AS ext_loc_name")
    numbered = access.numbered_locations(pairs)
    assert numbered.select("word", "bit").distinct().count() == 640
    assert access.role_words(numbered).count() == 2 * 10


def test_words_are_full_and_sets_go_without_their_roles(spark):
    """Few locations, one word: words that hold one location each, and carry the set's roles, are what is exchanged."""
    pairs = spark.range(120).selectExpr("concat('r', id % 2) AS role_name", "concat('loc', id div 2) AS ext_loc_name")
    numbered = access.numbered_locations(pairs)
    assert numbered.select("word").distinct().count() == 1
    assert numbered.select("word", "bit").distinct().count() == 60
    sets = spark.createDataFrame([(1, 2, ["r0", "r1"], 1)], "set_key long, set_check long, role_set array<string>, n_parts int")
    words = access.set_words(sets, access.role_words(numbered))
    assert sorted(words.columns) == ["bits", "n_parts", "set_check", "set_key", "word"]
    assert [row.bits for row in words.collect()] == [2**60 - 1]


def test_empty_relations_reach_nothing(spark):
    governance = spark.createDataFrame([], "principal_id string, role_name string, principal_display_name string")
    locations = spark.createDataFrame([], "role_name string, ext_loc_name string")
    assert access.reach(governance, locations, ["principal_id"]).collect() == []
