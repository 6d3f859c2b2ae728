import datetime
import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from grantline.fixed import DOCUMENT_HEADER
from grantline.operators.documents import header
from grantline.plans.arguments import volume_path
from grantline.schemas import DOCUMENT_ORDER
from grantline.sinks import text
from grantline.sinks.shared import shared_folder, stage
from grantline.sinks.tables import merge_table, row_counts, save_table, with_row_count
from grantline.operators.allowlist import allowlist_payload
from grantline.plans import files, governance
from grantline.plans.privileges import acl_document
from grantline.sinks.text import document_path, numbered_lines, write_allowlist, write_document
from grantline.sources.tables import query_table, read_table, table_name


def document(spark, size):
    rows = spark.range(size).select(
        F.lit(1).alias("section"),
        F.format_string("label_%05d", "id").alias("label"),
        F.lit("b").alias("block"),
        F.lit(0).alias("part"),
        F.lit("").alias("item"),
        F.format_string("block %05d\n", "id").alias("output"),
    )
    return rows.repartition(5, F.rand(1)).unionByName(header(spark))


def written(folder):
    parts = sorted(folder.glob("part-*"))
    return parts, "".join(part.read_text() for part in parts)


def expected(size):
    return DOCUMENT_HEADER + "\n" + "".join(f"block {n:05d}\n\n" for n in range(size))


def test_small_document_is_one_ordered_file(spark, tmp_path):
    write_document(document(spark, 300), str(tmp_path / "a.tf"), n_files=1)
    parts, text = written(tmp_path / "a.tf")
    assert len(parts) == 1
    assert text == expected(300)


def test_large_document_is_several_files_in_order(spark, tmp_path):
    write_document(document(spark, 300), str(tmp_path / "a.tf"), n_files=4)
    parts, text = written(tmp_path / "a.tf")
    assert 2 <= len(parts) <= 4
    assert text == expected(300)


@pytest.mark.parametrize("n_files", [1, 4, 16])
def test_counts_and_line_numbers_do_not_depend_on_the_parts(spark, tmp_path, n_files):
    done = write_document(document(spark, 3000), str(tmp_path / "a.tf"), n_files=n_files)
    parts, text = written(tmp_path / "a.tf")
    assert len(parts) == n_files and (done.n_pieces, done.n_blocks) == (3001, {0: 1, 1: 3000})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")  # several tasks read one part
        lines = numbered_lines(spark, str(tmp_path / "a.tf"))
        assert lines.rdd.getNumPartitions() > 1
        assert [tuple(r) for r in lines.orderBy("line_no").collect()] == list(enumerate(text.split("\n")[:-1], 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_task_of_a_part_does_not_sort_its_pieces(spark, tmp_path, monkeypatch):
    """The one file of a document is written from few compressed packs, not from all pieces in one sort."""
    unpacked, seen = text._unpacked, tmp_path / "seen"
    seen.mkdir()

    def watched(frames):
        def noted():
            for frame in frames:
                for texts in frame["texts"]:
                    (seen / f"{len(texts)}-{uuid.uuid4().hex}").touch()
                yield frame

        yield from unpacked(noted())

    monkeypatch.setattr(text, "_unpacked", watched)
    done = write_document(document(spark, 30000), str(tmp_path / "a.tf"), n_files=1)
    sizes = [int(p.name.split("-")[0]) for p in seen.iterdir()]
    assert done.n_pieces == 30001 and written(tmp_path / "a.tf")[1] == expected(30000)
    assert len(sizes) <= 64 and sum(sizes) < len(expected(30000)) / 2


def test_parts_hold_whole_blocks(spark, tmp_path):
    data = spark.range(4000).selectExpr(
        "concat('u', id) AS principal", "'SELECT' AS action_type", "concat('c', id % 7) AS catalog",
        "cast(null AS string) AS database", "cast(null AS string) AS table", "cast(null AS string) AS view",
    )
    write_document(acl_document(data), str(tmp_path / "acl.tf"), n_files=3)
    parts, text = written(tmp_path / "acl.tf")
    assert len(parts) > 1 and text.count("principal") >= 4000
    for part in parts:
        content = part.read_text()
        assert content.count("{") == content.count("}")


def test_allowlist_documents_are_valid_json(spark, tmp_path):
    desired = spark.createDataFrame(
        [("jar", "s3://a", "EXACT_MATCH"), ("jar", "s3://a", "PREFIX_MATCH"), ("jar", "s3://a b", "PREFIX_MATCH"), ("maven", "g:a:1", "PREFIX_MATCH")],
        "artifact_type string, artifact string, match_type string",
    )
    write_allowlist(allowlist_payload(desired.repartition(4)), str(tmp_path / "allow"))
    found = {}
    for folder in (tmp_path / "allow").glob("artifact_type=*"):
        entries = json.loads(written(folder)[1])["artifact_matchers"]
        found[folder.name.split("=")[1]] = [(e["artifact"], e["match_type"]) for e in entries]
    assert sorted(found["jar"]) == [("s3://a", "EXACT_MATCH"), ("s3://a", "PREFIX_MATCH"), ("s3://a b", "PREFIX_MATCH")]
    assert found["maven"] == [("g:a:1", "PREFIX_MATCH")]


def test_a_document_from_table_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "volume_path", lambda path: path)
    name = f"spark_catalog.default.grants_{tmp_path.name.replace('-', '_')}"
    grants = spark.createDataFrame(
        [("u", "SELECT", "c", None, None, None)],
        "principal string, action_type string, catalog string, database string, table string, view string",
    )
    save_table(grants, name, str(tmp_path / "table"))
    done = files.write_grants(spark, name, str(tmp_path / "out"))
    assert (done.n_pieces, done.n_blocks) == (4, {0: 1, 1: 1})
    assert '"u"' in "".join(p.read_text() for p in Path(done.path).glob("part-*"))


def test_rerun_writes_the_same_bytes(spark, tmp_path):
    for name in ("a", "b"):
        write_document(document(spark, 100), str(tmp_path / name))
    assert written(tmp_path / "a")[1] == written(tmp_path / "b")[1]


def test_document_order_is_a_total_order_of_the_columns(spark):
    assert [c for c in document(spark, 1).columns if c != "output"] == DOCUMENT_ORDER


@pytest.mark.parametrize(
    "kind, name",
    [
        ("locations", "tf_exported_extloc_grants20240203_040506.tf"),
        ("volumes", "tf_exported_volumes20240203_040506.tf"),
        ("privileges", "tf_exported_acl_grants_20240203_040506.tf"),
    ],
)
def test_document_names(kind, name):
    assert document_path("/x/", kind, datetime.datetime(2024, 2, 3, 4, 5, 6)) == f"/x/{name}"


def test_table_roundtrip_overwrites(spark, rows, tmp_path):
    name = "spark_catalog.default.roundtrip"
    save_table(spark.range(3), name, str(tmp_path / "t"))
    save_table(spark.range(2), name, str(tmp_path / "t"))
    assert rows(read_table(spark, name)) == [(0,), (1,)]
    assert rows(query_table(spark, name)) == [(0,), (1,)]


def test_a_half_written_pair_is_refused(spark, tmp_path, monkeypatch):
    run = tmp_path.name.replace("-", "_")
    names = f"spark_catalog.default.a_{run}", f"spark_catalog.default.l_{run}"

    def pair(n):
        return governance.Governance(spark.range(n), spark.range(n + 1))

    governance.save_governance(pair(1), *names, str(tmp_path / "t"))
    loaded = governance.load_governance(spark, *names)
    assert (loaded.access.count(), loaded.path_lists.count()) == (1, 2)

    written = []

    def stop_after_one(rows, name, path=None):
        if written:
            raise RuntimeError("lost")
        written.append(name)
        save_table(rows, name, path)

    monkeypatch.setattr(governance, "save_table", stop_after_one)
    with pytest.raises(RuntimeError):
        governance.save_governance(pair(5), *names, str(tmp_path / "t"))
    assert read_table(spark, names[0]).count() == 5 and read_table(spark, names[1]).count() == 2
    with pytest.raises(ValueError, match="not of one finished run"):
        governance.load_governance(spark, *names)

    monkeypatch.setattr(governance, "save_table", save_table)
    governance.save_governance(pair(7), *names, str(tmp_path / "t"))
    other = f"spark_catalog.default.b_{run}", f"spark_catalog.default.m_{run}"
    governance.save_governance(pair(7), *other, str(tmp_path / "u"))
    assert governance.load_governance(spark, *names).access.count() == 7
    with pytest.raises(ValueError):
        governance.load_governance(spark, names[0], other[1])


def test_merged_tables_keep_columns_and_partitions(spark, rows, tmp_path):
    name = f"spark_catalog.default.merge_{tmp_path.name.replace('-', '_')}"
    merge_table(spark.createDataFrame([(1, "old", "a"), (2, "old", "b")], "n long, note string, kind string"), name, "kind", str(tmp_path / "m"))
    merge_table(spark.createDataFrame([("b", 3, [1])], "kind string, n long, extra array<int>"), name, "kind")
    assert rows(read_table(spark, name), "n", "note", "extra", "kind") == [(1, "old", None, "a"), (3, None, [1], "b")]
    merge_table(spark.createDataFrame([("c", 4)], "kind string, n long"), name, "kind")
    assert rows(read_table(spark, name), "n", "kind") == [(1, "a"), (3, "b"), (4, "c")]
    with pytest.raises(ValueError, match="another type"):
        merge_table(spark.createDataFrame([("c", "x")], "kind string, n string"), name, "kind")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("name", ["a.b.c", "a-1.b_2.C3", "`a-b`.c.`d`", " a.b.c "])
def test_valid_table_names(name):
    assert table_name(name).count("`") == 6


@pytest.mark.parametrize("name", ["abcde", "a.b", "a.b.c.d", "a.b.c;", "a.b.", "a b.c.d", "", "`a.b.c", "a.b.c\n;"])
def test_invalid_table_names(name):
    with pytest.raises(ValueError):
        table_name(name)


def test_volume_paths():
    assert volume_path("/Volumes/a/b-1/c_2/") == "/Volumes/a/b-1/c_2"
    for path in ["/Volumes/a/b", "/Volumes/a/b/c/d", "Volumes/a/b/c", "/Volumes/a/b/c d", "/tmp/a/b/c"]:
        with pytest.raises(ValueError):
            volume_path(path)


def test_staged_rows_come_from_the_shared_folder(spark, rows):
    staged = stage(spark.range(5).withColumn("x", F.array(F.lit("a"))))
    assert rows(staged) == [(n, ["a"]) for n in range(5)]
    assert staged.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
        spark.conf.get("spark.checkpoint.dir").lstrip("/")
    )
    assert shared_folder(spark) != shared_folder(spark)


def test_row_counts(spark, rows):
    observed_rows, observed = with_row_count(spark.range(7), "seven")
    observed_rows.write.format("noop").mode("overwrite").save()
    assert observed.get["n_rows"] == 7
    assert rows(row_counts({"a": spark.range(2), "b": spark.range(0)})) == [("a", 2), ("b", 0)]
