"""Registered queries of the package against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from checks.compare import canonical
from grantline.llm.neardup import near_duplicates
from grantline.llm.oracles import DECONTAMINATION
from grantline.llm.pieces import load_vocabulary
from grantline.llm.queries import ORACLES, PIECE_MODEL, QUERIES
from grantline.llm.secrets import digest, scan
from grantline.sinks.shared import stage

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "benchmark", "conversations"]


def expected(sql, **replaced):
    with duckdb.connect() as db:
        for table in TABLES:
            if table in replaced:
                db.register(table, replaced[table])
            else:
                db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
        result = db.execute(sql)
        return canonical([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    assert canonical(found.columns, found.collect()) == expected(ORACLES[name])


def test_all_operators_are_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 11) if not any(name.startswith(f"op{n}_") for name in names)] == []
    assert "pipeline" in names and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_pipeline_stage_by_stage(spark):
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs, seen = raw, []
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = stage(function(spark, docs, SMALL))
        assert kept.columns == raw.columns
        assert kept.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
        seen.append((name, docs, kept))
        docs = kept

    _, _, unique = seen[1]
    again = near_duplicates(unique, percent=80)
    assert again.where("NOT kept").count() == 0
    _, before, clean = seen[2]
    leaks = expected(DECONTAMINATION, documents=before.toPandas())
    found = {row[leaks[0].index("doc_id")] for row in leaks[1]}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in clean.collect()} == found
    _, before, redacted = seen[3]
    assert digest(scan(redacted)).where("n_assign + n_access + n_hex > 0").count() == 0
    changed = before.join(redacted.withColumnRenamed("text", "new").select("doc_id", "new"), "doc_id").where("text <> new")
    hits = digest(scan(before)).where("spans <> ''")
    assert {r.doc_id for r in changed.collect()} == {r.doc_id for r in hits.collect()}

    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    vocabulary = load_vocabulary(PIECE_MODEL, ranks=True)
    texts = {r.doc_id: r.text for r in docs.collect()}
    import numpy as np

    assert {r.doc_id: vocabulary.decode(np.array(r.token_ids)) for r in encoded} == texts


def test_pipeline_keeps_clean_documents(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.select_quality(spark, docs, SMALL).select("doc_id")
    clean = labels.where("quality = 1 AND toxic = 0")
    assert clean.join(kept, "doc_id").count() >= 0.95 * clean.count()
    bad = labels.where("quality = 0")
    assert bad.join(kept, "doc_id").count() <= 0.3 * bad.count()
