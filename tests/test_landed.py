"""Landed JSON that does not fit, and conditions of policy statements."""

from pyspark.sql import functions as F

from grantline.operators import policies
from grantline.schemas import PRINCIPAL
from grantline.sources.policies import landed_profiles, parse_documents, statement_conditions
from grantline.sources.principals import landed_principals
from grantline.sources.tables import parse_landed

LINES = [
    '{"displayName":"a","id":"1","roles":[{"value":"x"}]}',
    '{"displayName":"b","id":"2"',
    '[{"id":"3"}]',
    "5",
    "null",
    '{"id":"4","emails":{"value":"x"}}',
    '{"id":"5","roles":[1]}',
    '{"displayName":"c"}',
    '{"id":null}',
    '{"id":7,"extra":{"a":1},"emails":[{"value":"e","seen":true},{"value":"f","seen":false}]}',
    "{}",
    "not json",
]


def test_every_line_is_kept_or_rejected_with_a_reason(spark, tmp_path):
    (tmp_path / "users.json").write_text("\n".join(LINES) + "\n\n   \n")
    found = landed_principals(spark, str(tmp_path), "USER")
    assert found.records.columns == [*PRINCIPAL.names, "principal_type"]
    assert sorted(r.id for r in found.records.collect()) == ["1", "7"]
    reasons = {r.line: r.reason for r in found.rejected.collect()}
    assert reasons == {
        LINES[1]: "malformed", LINES[2]: "not_an_object", "5": "not_an_object", "null": "not_an_object", LINES[5]: "wrong_type",
        LINES[6]: "wrong_type", LINES[7]: "missing_field", LINES[8]: "missing_field", "{}": "missing_field", "not json": "malformed",
    }
    assert found.records.count() + found.rejected.count() == len(LINES)
    drift = sorted((r.field, r.type, r.n_values) for r in found.drift.collect())
    assert drift == [("emails[].seen", "BOOLEAN", 2), ("extra", "OBJECT<a: BIGINT>", 1)]


def test_null_texts_are_rejected_and_other_columns_go_along(spark, rows):
    frame = spark.createDataFrame([("k", None), ("l", '{"id":"1"}')], "key string, text string")
    found = parse_landed(frame, "text", PRINCIPAL, ("id",))
    assert rows(found.records, "key", "id") == [("l", "1")]
    assert rows(found.rejected) == [("k", None, "malformed")]
    assert found.drift.count() == 0


def test_profiles_without_a_document_are_rejected(spark, rows):
    frame = spark.createDataFrame([("p", '{"InstanceProfile":{"Roles":[]}}'), ("q", "{"), ("r", '{"Other":1}')], "profile_name string, document string")
    assert rows(landed_profiles(frame).rejected, "profile_name", "reason") == [("q", "malformed"), ("r", "missing_field")]


DOCUMENTS = [
    ("p1", """{"Statement":[
        {"Sid":"a","Effect":"Allow","Resource":"arn:aws:s3:::x","Condition":{"StringLike":{"s3:prefix":["u/","v/"],"k":"w"},"Bool":{"t":true}}},
        {"Sid":"b","Effect":"Allow","Resource":"arn:aws:s3:::y","Condition":{},"Action":["s3:*","s3:Get"]},
        {"Sid":"c","Effect":"Allow","Resource":"arn:aws:s3:::z","Condition":[1,2],"Action":"s3:Get"}]}"""),
    ("p2", """{"Statement":{"Sid":"d","Effect":"Deny","Resource":"arn:aws:s3:::x","Condition":{"Null":{}},"NotAction":"s3:Put"}}"""),
    ("p3", "{"),
    ("p4", """{"Statement":{"Sid":"e","Effect":"Allow","Resource":["arn:aws:s3:::v"],"Condition":{"Op":"text"},"Action":"*"}}"""),
]


def test_conditions_of_any_shape(spark, rows):
    frame = spark.createDataFrame(DOCUMENTS, "policy_arn string, document string")
    found = statement_conditions(frame).withColumn("condition_values", F.array_join("condition_values", "|"))
    assert rows(found, "policy_arn", "statement_no", "sid", "operator", "condition_key", "condition_values") == sorted([
        ("p1", 0, "a", "StringLike", "s3:prefix", "u/|v/"), ("p1", 0, "a", "StringLike", "k", "w"), ("p1", 0, "a", "Bool", "t", "true"),
        ("p1", 2, "c", None, None, "[1,2]"), ("p2", 0, "d", "Null", None, "{}"), ("p4", 0, "e", "Op", None, "text"),
    ], key=repr)


def test_limited_statements_are_reported_and_still_give_paths(spark, rows):
    frame = spark.createDataFrame(DOCUMENTS, "policy_arn string, document string")
    attached = frame.select(F.lit("r").alias("role_name"), "policy_arn")
    dropped = policies.dropped_resources(attached, parse_documents(frame, audited=True), min_paths=1)
    assert rows(dropped, "policy_arn", "subject", "reason") == sorted([
        ("p1", "arn:aws:s3:::x", "conditional"), ("p1", "arn:aws:s3:::z", "conditional"), ("p1", "arn:aws:s3:::z", "action_limited"),
        ("p2", "arn:aws:s3:::x", "not_allowed"), ("p3", "", "unreadable_document"), ("p4", "arn:aws:s3:::v", "conditional"),
    ], key=repr)
    paths = {r.policy_arn: r.s3_paths for r in policies.bucket_paths(parse_documents(frame)).collect()}
    assert paths["p1"] == ["s3://x", "s3://y", "s3://z"] and paths["p2"] == [] and paths["p4"] == ["s3://v"]
