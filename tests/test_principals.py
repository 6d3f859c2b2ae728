import json

import pytest

from grantline.operators import access, principals
from grantline.plans.governance import public_principals
from grantline.schemas import PRINCIPAL
from grantline.sources.principals import (
    all_principals,
    parse_principals,
    read_principals,
    tag_principals,
)


def record(name, id, emails=(), roles=None, application=None):
    def cells(values):
        return None if values is None else [(None, v, None, None, None) for v in values]

    return (name, cells(emails), id, cells(roles), application)


def records(spark, *data, kind="USER"):
    return tag_principals(spark.createDataFrame(list(data), PRINCIPAL), kind)


def test_missing_roles_are_dropped_and_empty_roles_vanish_at_the_explode(spark, rows):
    data = records(
        spark, record("a", "1", roles=None), record("b", "2", roles=[]), record("c", "3", roles=["x", "y"])
    )
    public = public_principals(data)
    assert rows(public, "principal_display_name") == [("b",), ("c",)]
    assert rows(
        principals.principal_profiles(public), "principal_display_name", "instance_profile_arn"
    ) == [("c", "x"), ("c", "y")]


def test_overlapping_pages_are_deduplicated_on_kind_name_and_id(spark, rows):
    one = record("a", "1", roles=["x"])
    users = records(spark, one, one, record("a", "2", roles=["x"]), record("a", "1", roles=["b"]))
    groups = records(spark, one, kind="GROUP")
    public = public_principals(all_principals(users, groups))
    assert rows(public, "principal_type", "principal_id", "instance_profile_arns") == [
        ("GROUP", "1", ["x"]),
        ("USER", "1", ["b"]),
        ("USER", "2", ["x"]),
    ]


def test_first_email_of_empty_and_missing_lists_is_null(spark, rows):
    data = records(
        spark,
        record("a", "1", emails=[], roles=["x"]),
        record("b", "2", emails=["p@x", "q@x"], roles=["x"]),
        record("c", "3", emails=None, roles=["x"]),
    )
    assert rows(public_principals(data), "principal_id", "email_value") == [
        ("1", None),
        ("2", "p@x"),
        ("3", None),
    ]


def test_name_filter_takes_the_text_literally(spark, rows):
    data = records(
        spark,
        record("a_b", "1", roles=["x"]),
        record("axb", "2", roles=["x"]),
        record("it's 100%", "3", roles=["x"]),
        record(None, "4", roles=["x"]),
    )
    names = lambda text: rows(public_principals(data, name_filter=text), "principal_id")
    assert names("a_b") == [("1",)]
    assert names("0%") == [("3",)]
    assert names("it's") == [("3",)]
    assert len(names("")) == 4


def test_kinds_are_selected_and_checked(spark, rows):
    data = all_principals(
        records(spark, record("a", "1", roles=["x"])),
        records(spark, record("g", "2", roles=["x"]), kind="GROUP"),
    )
    assert rows(public_principals(data, "GROUP"), "principal_id") == [("2",)]
    assert len(rows(public_principals(data, "ALL"))) == 2
    with pytest.raises(ValueError):
        principals.filter_by_type(public_principals(data), "ROBOT")
    with pytest.raises(ValueError):
        tag_principals(data, "ROBOT")


def test_grantee_depends_on_the_kind(spark, rows):
    data = [
        ("USER", "u", "u@x", "app"),
        ("USER", "v", None, "app"),
        ("SERVICE_PRINCIPAL", "s", "s@x", "app-s"),
        ("SERVICE_PRINCIPAL", "t", "t@x", None),
        ("GROUP", "g", "g@x", "app"),
    ]
    frame = spark.createDataFrame(
        data, "principal_type string, principal_display_name string, email_value string, application_id string"
    )
    assert rows(frame.select("principal_display_name", principals.grantee().alias("grantee"))) == [
        ("g", "g"),
        ("s", "app-s"),
        ("t", "t"),
        ("u", "u@x"),
        ("v", "v"),
    ]


def test_landed_json_is_read_with_the_fixed_schema(spark, rows, tmp_path):
    lines = [
        {"displayName": "a", "id": "1", "roles": [{"value": "x", "$ref": "r"}], "extra": 1},
        {"displayName": "b", "id": "2"},
    ]
    path = tmp_path / "users.json"
    path.write_text("\n".join(map(json.dumps, lines)))
    read = read_principals(spark, str(path), "USER")
    assert rows(read, "displayName", "id", "roles.value", "principal_type") == [
        ("a", "1", ["x"], "USER"),
        ("b", "2", None, "USER"),
    ]
    text = spark.read.text(str(path))
    assert rows(parse_principals(text, "value", "USER")) == rows(read)


def test_governance_keeps_profiles_without_paths(spark, rows):
    arn = "arn:aws:iam::1:instance-profile/"
    data = records(spark, record("a", "1", roles=[arn + "p", arn + "q", "bad"]))
    profiles = principals.principal_profiles(public_principals(data))
    profile_roles = spark.createDataFrame(
        [("p", "r1"), ("p", "r2"), ("q", "r3")], "profile_name string, role_name string"
    )
    counts = spark.createDataFrame([("r1", 6), ("r2", 9)], "role_name string, n_paths bigint")
    result = access.governance(profiles, profile_roles, counts)
    assert rows(result, "instance_profile_arn", "role_name", "n_paths") == [
        (arn + "p", "r1", 6),
        (arn + "p", "r2", 9),
        (arn + "q", None, None),
        ("bad", None, None),
    ]
