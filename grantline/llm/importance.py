"""Quality classifier: importance resampling with hashed n-gram models.

A text is a bag of words and word pairs, hashed into a fixed number of buckets.  A head compares two
generative models of the buckets, one of target text and one of raw text, by the log ratio of their
probabilities.  There are two: quality (target: labelled good documents; raw: all documents) and
toxicity (target: labelled clean documents; raw: labelled toxic ones).  Counts are shrunk to what
the two together would give, so rare buckets say little; toxicity reads only buckets with a strong ratio.
A document's score by a head is its sum of log ratios over the square root of its number of n-grams.

The margin of a document is the smaller of its two scores above the heads' thresholds, which are set on
labelled rows that the models have not seen.  The sample is then drawn by Gumbel top-k: of log weights
margin / temperature plus Gumbel noise, the k largest, with k the number of documents above the
thresholds.  A low temperature leaves only borderline documents to chance; the noise is a hash of
doc_id, so a run can be repeated.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from grantline.llm.groups import hashed_sample
from grantline.llm.words import encoded, mixed, word_hashes
from grantline.sinks.shared import stage

#: Texts hashed at once.
ROWS = 512
_COUNTS = ["raw", "good", "clean", "toxic"]


@dataclass
class Settings:
    """``labelled_rows``: about so many labelled documents are used at most, a hashed sample."""

    buckets: int = 1 << 18
    labelled_rows: int = 50_000
    prior: float = 5.0
    least_toxic_ratio: float = 2.0
    temperature: float = 0.01


def _buckets(texts: list, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word and word pair, and the text it is from."""
    hashes, counts = word_hashes(encoded(texts), marks=True)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[1:] == owner[:-1]
    pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:] * np.uint64(5))[inside]
    found = np.concatenate([hashes, pairs]) % np.uint64(buckets)
    return found.astype(np.int64), np.concatenate([owner, owner[1:][inside]])


def _count_buckets(buckets: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(_COUNTS), buckets), np.int64)
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                rows = batch.slice(start, ROWS)
                found, owner = _buckets(rows.column("text").to_pylist(), buckets)
                sums[0] += np.bincount(found, minlength=buckets)
                for n, name in enumerate(_COUNTS[1:], 1):
                    chosen = rows.column(name).to_numpy(zero_copy_only=False).astype(bool)
                    sums[n] += np.bincount(found[chosen[owner]], minlength=buckets)
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(s[used]) for s in sums)], ["bucket", *_COUNTS])

    return counted


def _log_ratio(target: np.ndarray, raw: np.ndarray, prior: float, least: float = 0.0) -> np.ndarray:
    share = (target + raw + 1.0) / (target.sum() + raw.sum() + len(raw))
    ratio = np.log((target + prior) / (target.sum() * share + prior))
    ratio -= np.log((raw + prior) / (raw.sum() * share + prior))
    return np.where(np.abs(ratio) < least, 0.0, ratio)


def labelled(labels: DataFrame, limit: int) -> DataFrame:
    """doc_id, quality, toxic and fold of about ``limit`` labelled documents at most; of repeated labels the
    worse ones hold, rows without doc_id or a label are left out."""
    one = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    chosen = hashed_sample(stage(one), ["doc_id"], limit)
    return stage(chosen.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(19)), F.lit(2)).cast("int")))


def fit(documents: DataFrame, sample: DataFrame, settings: Settings) -> np.ndarray:
    """The log ratios of both heads by bucket.  Raw counts are of all documents, the others of fold 0."""
    train = sample.where("fold = 0").select(
        "doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 0).alias("clean"), (F.col("toxic") == 1).alias("toxic")
    )
    flagged = documents.select("doc_id", "text").join(F.broadcast(train), "doc_id", "left")
    flagged = flagged.select("text", *[F.coalesce(n, F.lit(False)).alias(n) for n in _COUNTS[1:]])
    schema = StructType([StructField(n, LongType()) for n in ["bucket", *_COUNTS]])
    sums = flagged.mapInArrow(_count_buckets(settings.buckets), schema).groupBy("bucket").agg(
        *[F.sum(n).alias(n) for n in _COUNTS]
    )
    # One row per bucket: of fixed size, whatever the corpus.
    table = sums.toPandas()
    counts = np.zeros((len(_COUNTS), settings.buckets))
    counts[:, table["bucket"].to_numpy()] = table[_COUNTS].to_numpy().T
    raw, good, clean, toxic = counts
    heads = [
        _log_ratio(good, raw, settings.prior) if good.sum() else np.zeros(settings.buckets),
        _log_ratio(clean, toxic, settings.prior, settings.least_toxic_ratio)
        if clean.sum() and toxic.sum() else np.zeros(settings.buckets),
    ]
    return np.array(heads)


def score(documents: DataFrame, heads: np.ndarray) -> DataFrame:
    """The documents with n_grams and their score by each head; a text without words scores 0."""
    added = ["n_grams", "quality_score", "toxicity_score"]
    kept = [c for c in documents.columns if c not in added]
    buckets = heads.shape[1]
    small = heads.astype(np.float32)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                rows = batch.slice(start, ROWS)
                found, owner = _buckets(rows.column("text").to_pylist(), buckets)
                n = np.bincount(owner, minlength=len(rows))
                root = np.sqrt(np.maximum(n, 1))
                sums = [np.bincount(owner, weights=head[found], minlength=len(rows)) / root for head in small]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(n.astype(np.int64)), *map(pa.array, sums)], [*kept, *added]
                )

    schema = StructType(
        [documents.schema[c] for c in kept]
        + [StructField("n_grams", LongType()), StructField("quality_score", DoubleType()), StructField("toxicity_score", DoubleType())]
    )
    return documents.select(*kept).mapInArrow(scored, schema)


def _threshold(scores: np.ndarray, wanted: np.ndarray) -> tuple[float, float]:
    """The threshold that is right most often, in the middle of its gap, and the usual margin above it."""
    if not len(scores) or wanted.all() or not wanted.any():
        return -np.inf, 1.0
    order = np.argsort(scores, kind="stable")
    x, y = scores[order], wanted[order]
    right = np.concatenate([[y.sum()], y.sum() + np.cumsum(1 - 2 * y.astype(int))])
    edge = np.concatenate([[True], x[1:] != x[:-1], [True]])
    best = int(np.argmax(np.where(edge, right, -1)))
    low, high = x[max(0, best - 1)], x[min(best, len(x) - 1)]
    middle = float((low + high) / 2)
    return middle, max(1e-6, float(np.median(scores[wanted])) - middle)


def largest(rows: DataFrame, key: str, k: int) -> float:
    """The k-th largest value of a column, by counts per range that are narrowed round by round."""
    slots = 4096
    ends = rows.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low, high, above = ends.low, ends.high, 0
    if k <= 0 or low is None:
        return float("inf")
    while True:
        width = (high - low) / slots
        if width <= max(abs(low), abs(high)) * 1e-15:
            return low
        slot = F.least(F.floor((F.col(key) - low) / width), F.lit(slots - 1)).alias("slot")
        inside = rows.where((F.col(key) >= low) & (F.col(key) <= high))
        found = inside.groupBy(slot).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("least"), F.max(key).alias("most")).collect()
        for row in sorted(found, key=lambda r: -r.slot):
            if above + row.n >= k:
                if above + row.n == k:
                    return row.least
                if (row.least, row.most) == (low, high):
                    return low
                low, high = row.least, row.most
                break
            above += row.n


@dataclass
class Classifier:
    heads: np.ndarray
    thresholds: list[tuple[float, float]]
    temperature: float
    cut: float = -np.inf

    def log_weight(self) -> Column:
        margins = [
            F.lit(1.0) if np.isinf(level) else (F.col(name) - float(level)) / float(usual)
            for name, (level, usual) in zip(("quality_score", "toxicity_score"), self.thresholds)
        ]
        return F.least(*margins) / self.temperature

    def keyed(self, scores: DataFrame) -> DataFrame:
        unit = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(23)), 11).cast("double") + 0.5) / float(2**53)
        return scores.withColumn("log_weight", self.log_weight()).withColumn(
            "gumbel_key", F.col("log_weight") - F.log(-F.log(unit))
        )

    def weighted(self, documents: DataFrame) -> DataFrame:
        """The documents with their scores, log_weight and gumbel_key."""
        return self.keyed(score(documents, self.heads))

    def sampled(self, documents: DataFrame) -> DataFrame:
        return self.weighted(documents).where(F.col("gumbel_key") >= self.cut)


def classifier(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Classifier:
    """Fit both heads, set their thresholds and find the cut of the Gumbel top-k over all documents.

    Without labelled rows of both kinds a head accepts everything.  Null and empty texts score 0 by both
    heads.  Documents with equal texts have equal weights and noise of their own; repeated rows of one
    doc_id share their noise.  An empty table gives an empty sample.
    """
    settings = settings or Settings()
    sample = labelled(labels, settings.labelled_rows)
    heads = fit(documents, sample, settings)
    scores = stage(score(documents.select("doc_id", "text"), heads).drop("text"))
    held = sample.where("fold = 1").join(scores, "doc_id").select("quality", "toxic", "quality_score", "toxicity_score")
    rows = held.toPandas()  # at most the labelled rows
    thresholds = [
        _threshold(rows["quality_score"].to_numpy(), (rows["quality"] == 1).to_numpy()),
        _threshold(rows["toxicity_score"].to_numpy(), (rows["toxic"] == 0).to_numpy()),
    ]
    model = Classifier(heads, thresholds, settings.temperature)
    keyed = model.keyed(scores)
    k = keyed.where("log_weight >= 0").count()
    model.cut = largest(keyed, "gumbel_key", k)
    return model
