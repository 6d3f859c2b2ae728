"""Stages of the pipeline on tables whose further columns have the operators' own names."""

import corpus_pipeline
from grantline.sinks.shared import stage

SMALL = "/root/testdata/sf0.001"
NAMES = [
    "base", "candidates", "spans", "rows_of_id", "n_grams", "gumbel_key", "log_weight", "quality_score", "toxicity_score", "row",
    "text_hash", "group_key", "kept", "id", "n", "low", "high", "set", "items", "item_id", "found", "label", "component_id",
]


def test_stages_keep_columns_of_any_name(spark):
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = [f"concat('{name}-', doc_id) AS `{name}`" for name in NAMES]
    docs = stage(raw.selectExpr("*", *extra))
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept = stage(function(spark, docs, SMALL))
        assert kept.columns == docs.columns and kept.count() > 0
        wrong = " OR ".join(f"`{name}` <> concat('{name}-', doc_id)" for name in NAMES)
        assert kept.where(wrong).count() == 0
        docs = kept
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert set(NAMES) <= set(last.columns) and last.count() == docs.count()
