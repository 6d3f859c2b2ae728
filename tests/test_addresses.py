"""Addresses that do not repeat, on names made to clash."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from grantline import catalog
from grantline.functions.text import label
from grantline.operators import documents
from grantline.operators.addresses import confused_labels, unique_labels
from grantline.plans.governance import Governance
from grantline.plans.locations import location_document
from grantline.plans.privileges import acl_document
from grantline.plans.volumes import volume_document


def stem():
    return label(F.col("name"))


def plain(name):
    return re.sub("[^a-z0-9_]", "_", name.lower())


def mark(name):
    return hashlib.md5(name.encode()).hexdigest()


def labelled(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    return {r.name: r.label for r in unique_labels(frame, ["name"], stem(), "label").collect()}


def test_only_names_that_need_it_are_marked(spark):
    crafted = "a_b_" + mark("a.b")[:8]
    longer = "c_" + mark("c")
    found = labelled(spark, ["a.b", "a_b", crafted, "c", longer, "day_20240101", "x", "x"])
    assert found == {
        "a.b": "a_b_" + mark("a.b")[:8], "a_b": "a_b_" + mark("a_b")[:8], crafted: crafted + "_" + mark(crafted)[:8],
        "c": "c", longer: longer + "_" + mark(longer)[:8], "day_20240101": "day_20240101", "x": "x",
    }


def test_equal_marks_become_long_ones(spark, monkeypatch):
    monkeypatch.setattr("grantline.operators.addresses.SHORT", 1)
    names = [f"a{sign}b{n}" for sign in ".-_ " for n in range(30)]
    found = labelled(spark, names)
    assert len(set(found.values())) == len(names)
    assert {len(v) - len(plain(n)) for n, v in found.items()} == {33}


def test_random_names_get_labels_of_their_own(spark):
    rng = random.Random(2)
    names = {"".join(rng.choices("aA._-1", k=rng.randint(1, 5))) for _ in range(1500)}
    names |= {f"{plain(n)}_{mark(n)[:8]}" for n in sorted(names)[:200]}
    found = labelled(spark, sorted(names))
    assert set(found) == names and len(set(found.values())) == len(names)
    shared = {n for n in names if sum(plain(m) == plain(n) for m in names) > 1}
    assert all(found[n] != plain(n) for n in shared)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_joined_labels_are_never_confused(spark, seed):
    rng = random.Random(seed)
    firsts = {"_".join(rng.choices(["a", "b", "c"], k=rng.randint(1, 3))) for _ in range(12)}
    seconds = {rng.choice("._").join(rng.choices(["a", "b", "c"], k=rng.randint(1, 3))) for _ in range(25)}
    seconds |= {f"{plain(n)}_{mark(n)[:8]}" for n in sorted(seconds)[:5]} | {mark(n)[:8] for n in sorted(seconds)[:3]}
    frame = spark.createDataFrame([(n,) for n in sorted(firsts)], "first string")
    names = spark.createDataFrame([(n,) for n in sorted(seconds)], "name string")
    confused = confused_labels(frame, "first", names, ["name"], stem())
    found = {r.name: r.label for r in unique_labels(names, ["name"], stem(), "label", confused).collect()}
    assert len(set(found.values())) == len(seconds)
    joined = [f"{p}_{l}" for p, l in itertools.product(firsts, found.values())]
    assert len(joined) == len(set(joined)) == len(firsts) * len(seconds)
    # A name that no pair of firsts can confuse with another one stays as it is.
    between = {b[len(a) + 1 :] for a in firsts for b in firsts if b.startswith(a + "_")}
    possible = {n: [plain(n), f"{plain(n)}_{mark(n)[:8]}", f"{plain(n)}_{mark(n)}"] for n in seconds}
    everything = [p for options in possible.values() for p in options]
    for name, given in found.items():
        if given != plain(name):
            alike = [p for p in everything if p == plain(name)]
            met = [p for p in everything for x in between if p == f"{x}_{plain(name)}" or plain(name) == f"{x}_{p}"]
            assert len(alike) > 1 or met


def addresses(document):
    text = "".join(r.output for r in document.collect())
    found = re.findall(r'^(resource|data) "(\w+)" "(\w+)"', text, re.M)
    return text, [address for address in found]


def test_no_address_repeats_in_any_document(spark):
    holders = [("USER", f"id{n}", name, f"u{n}@x", None, "arn", "r", 9) for n, name in enumerate(["Team", "Team Loc", "t.x", "t_x", "t_x"])]
    schema = (
        "principal_type string, principal_id string, principal_display_name string, email_value string,"
        " application_id string, instance_profile_arn string, role_name string, n_paths bigint"
    )
    lists = [("r", "p", ["s3://b*", "s3://loc.new"], ["s3://b.*", "s3://loc.new"])]
    governance = Governance(
        spark.createDataFrame(holders, schema),
        spark.createDataFrame(lists, "role_name string, policy_arn string, s3_paths array<string>, s3_paths_regex array<string>"),
    )
    names = ["Loc a.b", "Loc a_b", "a.b", "Loc new", "x-y"]
    locations = spark.createDataFrame(
        [(name, "c", "", f"s3://b{n}/", True) for n, name in enumerate(names)],
        "ext_loc_name string, credential_name string, credential_id string, url string, created boolean",
    )
    buckets = spark.createDataFrame([("loc.new",)], "bucket_name string")
    text, found = addresses(location_document(governance, locations, buckets, True, "c"))
    assert len(found) == len(set(found)) == 6 + 5 * 6
    defined = {("data." if kind == "data" else "") + f"{sort}.{name}" for kind, sort, name in found}
    referred = set(re.findall(r"external_location = (\S+)\.id", text))
    assert referred == {d for d in defined if "external_location" in d}

    folders = spark.createDataFrame([("b0", "f.x/"), ("b0", "f_x/"), ("b1", "f.x/")], "bucket_name string, folder string")
    map_rows = [("s3://b1", "c1", "s"), ("s3://b1", "c2", "s")]
    bucket_map = spark.createDataFrame(map_rows, "s3_bucket_url string, catalog_name string, schema_name string")
    _, found = addresses(volume_document(locations, folders, bucket_map, "main", "landing"))
    assert len(found) == len(set(found)) == 4

    grants = spark.createDataFrame(
        [("p", "SELECT", c, d, t, None) for c, d, t in [("a", "b_c", None), ("a", "b", "c"), ("a_b", "c", None), ("a", "b-c", None), ("a.b", "c", None)]],
        "principal string, action_type string, catalog string, database string, table string, view string",
    )
    _, found = addresses(acl_document(grants))
    assert len(found) == len(set(found)) == 5


def test_registered_addresses_are_unique_and_mostly_plain(spark):
    rows = catalog.queries()["address_map"](spark, "/root/testdata/sf0.001").collect()
    assert len({(r.kind, r.address) for r in rows}) == len(rows)
    assert {r.kind for r in rows if re.search("_[0-9a-f]{8}$", r.address)} == {"principal", "location", "volume", "object"}
    people, places = ([r.address for r in rows if r.kind == kind] for kind in ("principal", "location"))
    assert len({f"{p}_{l}" for p in people for l in places}) == len(people) * len(places)
