import json

import pytest
from pyspark.sql import functions as F

from grantline import fixed
from grantline.functions.text import escape, label
from grantline.operators import allowlist, audit, volumes
from grantline.plans.allowlist import allowlist_update
from grantline.plans.volumes import volume_document
from grantline.schemas import CLUSTER_LIBRARIES, EXTERNAL_LOCATION
from grantline.sources import libraries, storage
from grantline.sources.tables import read_landed


def locations(spark, *urls):
    data = [(f"L {n}", "cred", "id", url) for n, url in enumerate(urls)]
    return storage.external_locations(spark.createDataFrame(data, EXTERNAL_LOCATION))


def folders(spark, *data):
    return spark.createDataFrame(list(data), "bucket_name string, folder string")


def test_first_level_folders(spark, rows):
    keys = [("b", "x/1"), ("b", "x/y/2"), ("b", "root"), ("b", "z/"), ("c", "/odd"), ("d", None)]
    frame = spark.createDataFrame(keys, "bucket_name string, object_key string")
    assert rows(storage.first_level_folders(frame)) == [("b", "x/"), ("b", "z/"), ("c", "/")]


def test_buckets_are_listed_once(spark, rows):
    frame = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "bucket_name string")
    assert rows(storage.buckets(frame)) == [("a",), ("b",)]


def test_bucket_of_every_kind_of_url(spark, rows):
    frame = locations(spark, "s3://b", "s3://b/", "s3a://b/x/y", "abfss://b")
    parsed = volumes.location_buckets(frame)
    assert rows(parsed, "url", "s3_bucket_url", "s3_bucket_name") == [
        ("abfss://b", None, None),
        ("s3://b", "s3://b", "b"),
        ("s3://b/", "s3://b", "b"),
        ("s3a://b/x/y", "s3a://b", "b"),
    ]


def test_volumes_take_mapped_or_default_places(spark, rows):
    frame = volumes.volumes(
        locations(spark, "s3://a/", "s3://b/data/"),
        folders(spark, ("a", "Raw Data.v1/"), ("a", None), ("b", "x/"), ("other", "y/")),
        storage.bucket_map(spark, [("s3://a", "cat", "sch")]),
        "main",
        "landing",
    )
    assert rows(frame, "ext_loc_label", "volume", "volume_label", "catalog_name", "schema_name") == [
        ("l_0", "Raw Data.v1/", "raw_data_v1", "cat", "sch"),
        ("l_1", "x/", "x", "main", "landing"),
    ]


def test_volume_block(spark):
    document = volume_document(
        locations(spark, "s3://a/"),
        folders(spark, ("a", "f.1/"), ("a", "f.1/")),
        storage.bucket_map(spark, [("s3://z", "c", "s")]),
        "main",
        "landing",
    )
    (output,) = [row.output for row in document.filter("section = 1").collect()]
    assert output == fixed.VOLUME_RESOURCE.format(
        address="l_0_f_1",
        volume_label="f_1",
        catalog="main",
        schema="landing",
        bucket_url="s3://a",
        folder="f.1/",
    )
    assert '" "volume_l_0_f_1" {\n\tname = "f_1"\n\tcatalog_name = "main"\n' in output
    assert '\tstorage_location = "s3://a/f.1/"\n' in output


def test_duplicate_map_keys_multiply_and_are_reported(spark, rows):
    mapped = storage.bucket_map(spark, [("s3://a", "c1", "s"), ("s3://a", "c2", "s"), ("s3://b", "c", "s")])
    frame = volumes.volumes(locations(spark, "s3://a"), folders(spark, ("a", "x/")), mapped, "m", "l")
    assert rows(frame, "catalog_name") == [("c1",), ("c2",)]
    assert rows(volumes.bucket_map_duplicates(mapped)) == [("s3://a", 2)]


def test_landed_inventories_are_read_with_their_schemas(spark, rows, tmp_path):
    clusters = tmp_path / "clusters.json"
    clusters.write_text(
        '{"cluster_id":"1","libraries":[{"jar":"a.jar"},{"maven":{"coordinates":"g:a:1"}},{"pypi":{}}]}\n'
        '{"cluster_id":"2"}\n'
    )
    landed = read_landed(spark, str(clusters), CLUSTER_LIBRARIES)
    inventory = libraries.library_inventory(landed, landed.limit(0))
    assert rows(inventory, "jar", "maven_coordinates") == [("a.jar", None), (None, "g:a:1"), (None, None)]
    places = tmp_path / "locations.json"
    places.write_text('{"name":"L","credential_name":"c","credential_id":"i","url":"s3://b","owner":"o"}\n')
    found = storage.external_locations(read_landed(spark, str(places), EXTERNAL_LOCATION))
    assert rows(found) == [("L", "c", "i", "s3://b", True)]


def test_libraries_of_both_kinds_of_cluster(spark, rows):
    interactive = spark.createDataFrame(
        [("1", [("a.jar", None), (None, ("g:a:1",))]), ("2", []), ("3", None)], CLUSTER_LIBRARIES
    )
    job = spark.createDataFrame([("4", [("a.jar", ("g:b:1",)), (None, (None,)), (None, None)])], CLUSTER_LIBRARIES)
    inventory = libraries.library_inventory(interactive, job)
    assert rows(inventory) == [
        ("interactive", "a.jar", None),
        ("interactive", None, "g:a:1"),
        ("job", "a.jar", "g:b:1"),
        ("job", None, None),
        ("job", None, None),
    ]
    assert rows(allowlist.classify_libraries(inventory)) == [("jar", "a.jar"), ("maven", "g:a:1")]


def artifacts(spark):
    data = [
        ("jar", "s3://x/a.jar"),
        ("jar", "/Volumes/a.jar"),
        ("jar", "dbfs:/a.jar"),
        ("maven", "g:a:1"),
        ("maven", "g:b:1"),
    ]
    return spark.createDataFrame(data, "artifact_type string, artifact string")


def current(spark):
    documents = [
        ("jar", '{"artifact_matchers":[{"artifact":"s3://x/a.jar","match_type":"OTHER"}]}'),
        ("maven", '{"artifact_matchers":[{"artifact":"g:a:1","match_type":"PREFIX_MATCH"},{"artifact":"old"}]}'),
        ("maven", "{}"),
    ]
    return libraries.current_allowlist(spark.createDataFrame(documents, "artifact_type string, document string"))


def test_delta_compares_artifact_and_match_type(spark, rows):
    both = allowlist.allowlist_delta(artifacts(spark), current(spark), "jar/maven")
    assert rows(both, "artifact") == [("/Volumes/a.jar",), ("g:b:1",), ("s3://x/a.jar",)]
    assert rows(allowlist.allowlist_delta(artifacts(spark), current(spark)), "artifact") == [
        ("/Volumes/a.jar",),
        ("s3://x/a.jar",),
    ]
    assert rows(allowlist.allowlist_delta(artifacts(spark), current(spark), "maven"), "artifact") == [("g:b:1",)]
    with pytest.raises(ValueError):
        allowlist.allowlist_delta(artifacts(spark), current(spark), "egg")


def test_desired_list_keeps_the_current_one(spark, rows):
    desired = set(rows(allowlist.allowlist_desired(artifacts(spark), current(spark), "jar/maven")))
    assert desired >= set(rows(current(spark)))
    only_jar = allowlist.allowlist_desired(artifacts(spark), current(spark), "jar")
    assert {row.artifact_type for row in only_jar.collect()} == {"jar"}


def test_payload_pieces_form_one_json_document_per_type(spark):
    inventory = spark.createDataFrame(
        [("job", 's3://x/"q".jar', None), ("job", "s3://x/a.jar", None), ("job", None, "g:b:1")],
        "cluster_kind string, jar string, maven_coordinates string",
    )
    pieces = allowlist_update(inventory, current(spark), "jar/maven").orderBy("part", "item").collect()
    texts = {kind: "".join(p.output for p in pieces if p.artifact_type == kind) for kind in ("jar", "maven")}
    listed = {
        kind: [m["artifact"] for m in json.loads(text)["artifact_matchers"]] for kind, text in texts.items()
    }
    assert listed == {
        "jar": ['s3://x/"q".jar', "s3://x/a.jar", "s3://x/a.jar"],
        "maven": ["g:a:1", "g:b:1", "old"],
    }


def test_labels_and_their_collisions(spark, rows):
    names = [("location", "A b", ""), ("location", "a-b", ""), ("location", "a-b", ""), ("location", "c", ""), ("volume", "a b", ""),
             ("principal", "ann", "a@x"), ("principal", "ann", "b@x")]
    frame = spark.createDataFrame(names, "kind string, name string, owner string")
    assert rows(frame.select(label(F.col("name"))).distinct()) == [("a_b",), ("ann",), ("c",)]
    assert rows(audit.label_collisions(frame)) == [
        ("location", "a_b", 2, "A b", "a-b"), ("principal", "ann", 2, "ann", "ann"),
    ]


def test_escaping(spark):
    frame = spark.createDataFrame([('a\\b"c\n${d}%{e}$f',)], "v string")
    assert frame.select(escape(F.col("v"))).first()[0] == 'a\\\\b\\"c\\n$${d}%%{e}$f'
