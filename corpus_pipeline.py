"""From raw documents to piece ids: five stages, each on all that the one before kept.

1. importance resampling drops what does not look like the labelled good and clean documents;
2. near duplicates: one document of each group stays;
3. documents that contain a benchmark item go;
4. secrets are replaced by a mark;
5. texts are encoded into pieces.

All stages but the last return the columns of documents.  Each works on doc_id and text alone, in a
table without other columns, so further columns may have any names; they are joined to its decisions.

Null and empty texts are scored, compared with nothing, hold no items and no secrets, and have no pieces; rows
with a null doc_id stay where a decision is by doc_id.  Of rows with one doc_id and one text, one stays.
Very long texts are worked on whole.  Empty tables give empty ones.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantline.llm.decontaminate import contained_items, without_items
from grantline.llm.importance import classifier
from grantline.llm.neardup import near_duplicates, one_per_group
from grantline.llm.pieces import encode, load_vocabulary
from grantline.llm.queries import PIECE_MODEL
from grantline.llm.secrets import without_secrets
from grantline.sinks.shared import stage


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text")


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classifier(_texts(docs), labels)
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return model.sampled(rows).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs, near_duplicates(_texts(docs), percent=80))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_items(docs, contained_items(_texts(docs), benchmark)).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    found = without_secrets(rows).withColumn("text", F.when(F.col("row.text").isNotNull(), F.col("text")))
    found = found.withColumn("row", F.col("row").withField("text", F.col("text")))
    if "n_chars" in docs.columns:
        n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("row", F.col("row").withField("n_chars", n_chars))
    return found.select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, with n_tokens and token_ids."""
    encoded = encode(docs, load_vocabulary(PIECE_MODEL, ranks=True))
    return encoded.withColumn("n_tokens", F.size("token_ids"))


STAGES = [
    ("quality_classifier", select_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", redact_secrets),
    ("sentencepiece_encoding", encode_pieces),
]

#: Sampling, Markov models and the segmentation are beyond SQL: tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
