"""Benchmark decontamination: short test items found inside long documents.

Items and documents are sets of five-word shingles.  A document is sketched by one-permutation MinHash:
the range of hash values is cut into bins and the least shingle of every bin is kept.  Documents are
partitioned by size, and a partition of up to 2**j shingles has 2**(j + e) bins, so a shingle that
document and item share is missing from the sketch only if a smaller one fell into its bin, with a
chance of at most 2**-(e + 1).  An item of q shingles that is contained to a share t has ceil(t q) chances
to be seen; e is the least number that keeps the chance of seeing none below ``miss`` for the shortest
item there is.  What the sketches find is decided on the full sets.

All of it is DataFrame expressions.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from grantline.sinks.shared import stage

#: Item shingles up to this number are sent to all tasks; more are joined by a shuffle.
BROADCAST_SHINGLES = 2_000_000


def shingles(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` words as sorted 64-bit hashes, words being in lower case and divided
    by white space.  Fewer words make one shingle, no words none.

    ``sort_array`` compares numbers; ``array_sort`` would evaluate a comparing expression for each two."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.sort_array(F.array_distinct(_shingled(words, size)))


def _shingled(words: Column, size: int) -> Column:
    # The words are bound once by a one-element transform, not computed for every shingle.
    def bound(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(1), F.size(w) - size + 1),
            lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(size)]),
        )
        short = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= size, runs).otherwise(short)

    return F.element_at(F.transform(F.array(words), bound), 1)


def _bins(n_shingles: Column, extra: int) -> Column:
    """The number of bits of a bin number in the size partition of a document."""
    return F.greatest(F.lit(1), F.ceil(F.log2(n_shingles.cast("double"))).cast("int") + extra)


def sketch(sorted_shingles: Column, bits: Column) -> Column:
    """The least shingle of every bin."""
    return F.filter(
        sorted_shingles,
        lambda x, i: (i == 0)
        | (F.call_function("shiftrightunsigned", x, 64 - bits) != F.call_function("shiftrightunsigned", F.get(sorted_shingles, i - 1), 64 - bits)),
    )


def sketches(documents: DataFrame, extra: int, shingle_size: int) -> DataFrame:
    """doc_id and each ``shingle`` of the document's sketch.

    An empty set has an empty sketch and needs no filter, which would be moved below the sets and compute
    every one of them a second time.
    """
    sets = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", shingles(F.col("text"), shingle_size).alias("set")
    )
    return sets.select("doc_id", F.explode(sketch(F.col("set"), _bins(F.size("set"), extra))).alias("shingle"))


def extra_bits(least_shingles: int, containment: float, miss: float) -> int:
    chances = max(1, math.ceil(containment * least_shingles - 1e-9))
    return max(0, min(40, math.ceil(-math.log2(miss) / chances) - 1))


def contained_items(
    documents: DataFrame,
    benchmark: DataFrame,
    containment: float = 0.8,
    shingle_size: int = 5,
    miss: float = 1e-7,
) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_common and containment (n_common / n_item_shingles) of every
    pair with at least the given containment.

    Null and empty texts on either side match nothing; rows with a null id take no part.  Rows that
    repeat an id give a pair once, with the largest n_common.  Items that share a text are all found.
    An empty table on either side gives no pairs; other columns are not read.
    """
    items = stage(
        benchmark.where("item_id IS NOT NULL")
        .select("item_id", shingles(F.col("text"), shingle_size).alias("item"))
    ).where(F.size("item") > 0)
    shape = items.agg(F.min(F.size("item")).alias("least"), F.sum(F.size("item")).alias("total")).first()
    extra = extra_bits(shape.least or 1, containment, miss)
    hint = F.broadcast if (shape.total or 0) <= BROADCAST_SHINGLES else (lambda frame: frame)
    seen = sketches(documents, extra, shingle_size)
    wanted = items.select("item_id", F.explode("item").alias("shingle"))
    candidates = stage(
        seen.join(hint(wanted), "shingle").groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    )
    full = documents.select("doc_id", "text").join(candidates, "doc_id")
    compared = (
        full.select("doc_id", "items", shingles(F.col("text"), shingle_size).alias("set"))
        .select("doc_id", "set", F.explode("items").alias("item_id"))
        .join(hint(items), "item_id")
        .select("doc_id", "item_id", F.size("item").cast("long").alias("n_item_shingles"),
                F.size(F.array_intersect("item", "set")).cast("long").alias("n_common"))
    )
    pairs = compared.where(F.col("n_common") >= F.lit(containment) * F.col("n_item_shingles") - 1e-9)
    return (
        pairs.groupBy("doc_id", "item_id", "n_item_shingles").agg(F.max("n_common").alias("n_common"))
        .withColumn("containment", F.col("n_common") / F.col("n_item_shingles"))
    )


def without_items(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents that contain no item; documents with a null id stay."""
    return documents.join(pairs.select("doc_id").distinct(), "doc_id", "left_anti")
