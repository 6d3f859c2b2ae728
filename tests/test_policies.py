import json

from pyspark.sql import functions as F

from grantline.functions.paths import profile_name
from grantline.operators import policies
from grantline.plans.governance import PolicyExports
from grantline.sources.policies import default_documents, parse_documents, profile_roles

S3 = "arn:aws:s3:::"


def exports(spark, documents, attached=None):
    """One policy per entry of ``documents`` (a text or an object), attached to role ``r``."""
    texts = [(f"p{n}", d if isinstance(d, str) else json.dumps(d)) for n, d in enumerate(documents)]
    versions = [(arn, "v1", "{}") for arn, _ in texts] + [(arn, "v2", text) for arn, text in texts]
    attached = attached or [("r", arn) for arn, _ in texts]
    return PolicyExports(
        spark.createDataFrame([("profile", "r")], "profile_name string, role_name string"),
        spark.createDataFrame(attached, "role_name string, policy_arn string"),
        spark.createDataFrame([(a, "v2") for a, _ in texts], "policy_arn string, default_version_id string"),
        spark.createDataFrame(versions, "policy_arn string, version_id string, document string"),
    )


def statement(resource, effect="Allow"):
    return {"Effect": effect, "Action": "*", "Resource": resource}


def test_statement_and_resource_may_be_single_or_lists(spark, rows):
    e = exports(
        spark,
        [
            {"Statement": statement(S3 + "a")},
            {"Statement": [statement([S3 + "b", S3 + "c/*"]), statement(S3 + "d")]},
            {"Statement": []},
            {},
        ],
    )
    lists = e.path_lists()
    assert rows(lists, "policy_arn", "s3_paths", "s3_paths_regex") == [
        ("p0", ["s3://a"], ["s3://a"]),
        ("p1", ["s3://b", "s3://c/*", "s3://d"], ["s3://b", "s3://c/.*", "s3://d"]),
    ]


def test_only_allowed_whole_buckets_count(spark, rows):
    e = exports(
        spark,
        [
            {
                "Statement": [
                    statement(S3 + "no", "Deny"),
                    statement([S3 + "x", S3 + "y/*", S3 + "z/prefix/*", S3 + "w/", S3 + "v*/*"]),
                    statement(["arn:aws:sqs:::q", "*"]),
                    {"Effect": "Allow", "NotResource": S3 + "n"},
                    {"Resource": S3 + "m"},
                ]
            }
        ],
    )
    assert rows(e.path_lists(), "s3_paths") == [(["s3://x", "s3://y/*", "s3://v*/*"],)]
    dropped = policies.dropped_resources(e.attached, e.statements(audited=True), min_paths=1)
    assert rows(dropped, "subject", "reason") == [
        ("", "no_resource"),
        ("*", "not_storage"),
        (S3 + "m", "not_allowed"),
        (S3 + "no", "not_allowed"),
        (S3 + "w/", "inside_bucket"),
        (S3 + "z/prefix/*", "inside_bucket"),
        ("arn:aws:sqs:::q", "not_storage"),
    ]


def test_roles_need_more_than_five_paths_and_repeats_count(spark, rows):
    five = {"Statement": statement([S3 + f"b{n}" for n in range(5)])}
    again = {"Statement": statement([S3 + "b0"])}
    e = exports(spark, [five, again], [("few", "p0"), ("enough", "p0"), ("enough", "p1")])
    lists = e.path_lists()
    assert rows(policies.role_path_counts(lists)) == [("enough", 6)]
    assert len(rows(policies.role_paths(lists))) == 5
    dropped = policies.dropped_resources(e.attached, e.statements(audited=True))
    assert rows(dropped, "role_name", "subject", "reason") == [("few", "5", "too_few_paths")]


def test_unreadable_documents_are_reported(spark, rows):
    e = exports(spark, ['{"Statement":[', "", {"Statement": statement(S3 + "a")}])
    assert rows(e.path_lists(), "policy_arn") == [("p2",)]
    dropped = policies.dropped_resources(e.attached, e.statements(audited=True), min_paths=1)
    assert rows(dropped, "policy_arn", "reason") == [
        ("p0", "unreadable_document"),
        ("p1", "unreadable_document"),
    ]


def test_only_the_default_version_counts(spark, rows):
    e = exports(spark, [{"Statement": statement(S3 + "a")}])
    old = e.policies.withColumn("default_version_id", F.lit("v1"))
    changed = PolicyExports(e.profile_roles, e.attached, old, e.versions)
    assert rows(changed.path_lists()) == []


def test_role_filter_by_list_and_by_relation(spark, rows):
    attached = spark.createDataFrame([("a", "p"), ("b", "p")], "role_name string, policy_arn string")
    assert len(rows(policies.filter_roles(attached))) == 2
    assert len(rows(policies.filter_roles(attached, []))) == 2
    assert rows(policies.filter_roles(attached, ["b"])) == [("b", "p")]
    wanted = spark.createDataFrame([("a",)], "role_name string")
    assert rows(policies.filter_roles(attached, wanted)) == [("a", "p")]


def test_profile_names_and_roles(spark, rows):
    arns = [
        ("arn:aws:iam::123:instance-profile/p",),
        ("arn:aws:iam::123:instance-profile/path/p",),
        ("arn:aws:iam::x:instance-profile/p",),
        ("arn:aws:iam::123:instance-profile/",),
        (None,),
    ]
    named = spark.createDataFrame(arns, "arn string").select(profile_name(F.col("arn")))
    assert [row[0] for row in named.collect()] == ["p", "path/p", None, None, None]
    documents = [
        ("p", '{"InstanceProfile":{"Roles":[{"RoleName":"a"},{"RoleName":"b"}]}}'),
        ("q", '{"InstanceProfile":{"Roles":[]}}'),
        ("r", "{}"),
        ("s", "broken"),
    ]
    landed = spark.createDataFrame(documents, "profile_name string, document string")
    assert rows(profile_roles(landed)) == [("p", "a"), ("p", "b")]


def test_parsed_documents_keep_their_other_columns(spark, rows):
    frame = spark.createDataFrame([("x", "{}"), ("y", "[")], "id string, document string")
    assert rows(parse_documents(frame), "id", "readable") == [("x", True), ("y", False)]


def test_documents_are_parsed_once(spark):
    """The filter on the paths stays above the parser, and above the join that picks the default versions."""
    versions = spark.createDataFrame([("p", "v1", "{}")], "policy_arn string, version_id string, document string")
    chosen = spark.createDataFrame([("p", "v1")], "policy_arn string, default_version_id string")
    attached = spark.createDataFrame([("r", "p")], "role_name string, policy_arn string")
    statements = parse_documents(default_documents(chosen, versions))
    lists = policies.role_path_lists(attached, statements)
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
