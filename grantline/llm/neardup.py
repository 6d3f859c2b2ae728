"""Near-duplicate texts by a chosen-path set similarity join.

Texts are sets of word shingles.  In a tree, the root divides the texts by their least shingle in a hashed
order of its own; a text goes on to the node of its least shingle.  Two texts of Jaccard similarity s meet in
the same child with probability s.  A node that is still large is divided again, twice and by two orders
that are functions of its path, and so on.  Small nodes are compared exhaustively, on full sets.  With
two children per node a pair survives all levels of a tree with a probability of at least the fixpoint of
p = 1 - (1 - s p)**2 times s, and independent trees are added until the chance of missing a pair is below
``miss``.

A group of many similar texts stays together at every level, so a large node is also compared with some
of its texts, the hubs: blocks of hubs meet each other and all other blocks of the node, a cell each.
What they link is joined before the next level, nodes whose texts are all in one component are dropped,
and in the others only texts outside the node's largest component become hubs: all of them up to
``hubs``, then a share.  A hub has met all texts of its node and leaves it, so nodes shrink even where
nothing else divides them, and every pair that meets in a node is compared or already joined.
"""

import math
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from grantline.llm.groups import further_components, runs
from grantline.llm.vectors import spanning
from grantline.llm.words import encoded, mixed, shingle_sets
from grantline.sinks.shared import stage

#: Texts hashed at once.
ROWS = 256
_SEEDS = np.random.default_rng(31).integers(0, 2**63, 64, dtype=np.uint64)
_CHILD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def trees_for(similarity: float, miss: float) -> int:
    """How many trees keep the chance of missing a pair below ``miss``."""
    survive = 1.0
    for _ in range(200):
        survive = 1 - (1 - similarity * survive) ** 2
    return math.ceil(math.log(miss) / math.log(1 - similarity * survive))


def _least(values: np.ndarray, starts: np.ndarray, seed: np.uint64) -> np.ndarray:
    """The node that each set goes on to, by its least value in the order of a seed."""
    return mixed(np.minimum.reduceat(mixed(values ^ seed), starts) + seed)


def _signatures(shingle_size: int, trees: int):
    def signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), ROWS):
                rows = frame.iloc[first : first + ROWS]
                sets = shingle_sets(encoded(rows["text"]), shingle_size)
                sizes = np.array([len(s) for s in sets])
                filled = sizes > 0
                low, high = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
                paths = np.zeros((len(rows), trees), np.uint64)
                if filled.any():
                    values = np.concatenate(sets)
                    starts = (np.cumsum(sizes) - sizes)[filled]
                    low[filled] = np.add.reduceat(mixed(values ^ _SEEDS[-1]), starts)
                    high[filled] = np.bitwise_xor.reduceat(mixed(values ^ _SEEDS[-2]), starts)
                    for t in range(trees):
                        paths[filled, t] = _least(values, starts, _SEEDS[t])
                yield pd.DataFrame(
                    {"id": rows["id"].to_numpy(), "text_hash": rows["text_hash"].to_numpy(), "n": sizes, "low": low.view(np.int64), "high": high.view(np.int64),
                     "paths": list(paths.view(np.int64))}
                )

    return signed


def _compare(shingle_size: int, percent: int, max_depth: int):
    """Links of each cell's hubs, and the children of its other rows (kind 0: id, linked id; 1: id, node)."""

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for rows in runs(frames, "cell"):
            ids, labels, hub = rows["id"].to_numpy(), rows["label"].to_numpy(), rows["is_hub"].to_numpy()
            side, two, goes_on = rows["side"].to_numpy(), rows["two"].to_numpy()[0], rows["goes_on"].to_numpy()
            sets = shingle_sets([zlib.decompress(text) for text in rows["text"]], shingle_size)
            at = np.flatnonzero(hub & (side == 0))
            others = np.flatnonzero(side == 1) if two else np.arange(len(rows))
            if len(at) and len(others):
                known = np.unique(np.concatenate([sets[h] for h in at]))
                holds = np.zeros((len(known), len(at)), bool)
                for column, h in enumerate(at):
                    holds[np.searchsorted(known, sets[h]), column] = True
                size = np.array([len(sets[h]) for h in at])
                pairs = []
                for row in others:
                    own = sets[row]
                    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    place = place[known[place] == own]
                    common = holds[place].sum(axis=0)
                    linked = 100 * common >= percent * (len(own) + size - common)
                    linked &= labels[at] != labels[row]
                    pairs += [(ids[row], ids[h]) for h in at[linked] if ids[h] != ids[row]]
                out += [(0, x, root, 0, 0) for x, root in spanning(pairs).items() if x != root]
            rest = np.flatnonzero(goes_on & np.array([len(s) > 0 for s in sets]))
            if len(rest):
                depth, node = int(rows["depth"].iloc[0]), rows["node"].to_numpy()[:1].view(np.uint64)
                values = np.concatenate([sets[r] for r in rest])
                sizes = np.array([len(sets[r]) for r in rest])
                for child in range(2 if depth < max_depth else 0):
                    seed = mixed(node * _CHILD[child] + _CHILD[2])[0]
                    nodes = _least(values, np.cumsum(sizes) - sizes, seed).view(np.int64)
                    out += [(1, ids[r], n, s, depth + 1) for r, n, s in zip(rest, nodes, sizes)]
                if depth >= max_depth:
                    out += [(1, ids[r], node.view(np.int64)[0], s, depth) for r, s in zip(rest, sizes)]
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["kind", "a", "b", "n", "depth"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["kind", "a", "b", "n", "depth"])

    return compared


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as compressed bytes: each goes to several cells."""
    for frame in frames:
        yield pd.DataFrame({"id": frame["id"], "text": [zlib.compress(text, 1) for text in encoded(frame["text"])]})


def _cells(frontier: DataFrame, joined: DataFrame | None, cell_rows: int, hubs: int, draw: int = 0) -> DataFrame:
    """The rows of nodes that still hold several components, dealt to cells.

    A small node is one cell.  In others, hubs and the remaining texts are dealt to blocks, and a cell is
    a block of hubs with itself, with another block of hubs (side 1), or with a block of the others.
    Every ``draw`` takes other hubs, and at least one, so that a node that cannot be divided gets smaller.
    """
    rows = frontier.withColumn("weight", 1 + F.col("n") / 1024).withColumn("drawn", F.xxhash64("id", "node", F.lit(draw)))
    if joined is None:
        rows = rows.withColumn("label", F.col("id"))
    else:
        rows = rows.join(joined, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    by_label = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("weight").alias("w"), F.min("drawn").alias("least"))
    outside = F.col("w_all") - F.col("w_major")
    nodes = (
        by_label.groupBy("node")
        .agg(F.sum("c").alias("n_all"), F.sum("w").alias("w_all"), F.max_by("label", "c").alias("major"),
             F.max("c").alias("c_major"), F.max_by("w", "c").alias("w_major"),
             # One of the first and the last label is outside the largest component.
             F.min(F.struct("label", "least")).alias("first_label"), F.max(F.struct("label", "least")).alias("last_label"))
        .where("n_all > c_major")
        .withColumn("small", (F.col("w_all") <= cell_rows) | (F.col("n_all") <= 2))
        .withColumn("rate", F.when(F.col("small") | (outside <= hubs), 2.0).otherwise(
            F.greatest(hubs / outside, 2 / (F.col("n_all") - F.col("c_major")))))
        .withColumn("w_hubs", F.least(F.lit(1.0), F.col("rate")) * outside)
        .withColumn("n_hub_blocks", F.greatest(F.lit(1), F.ceil(F.col("w_hubs") / cell_rows)).cast("int"))
        .withColumn("n_blocks", (F.col("n_hub_blocks") + F.ceil((F.col("w_all") - F.col("w_hubs")) / cell_rows)).cast("int"))
        .withColumn("sure", F.when(F.col("first_label.label") != F.col("major"), F.col("first_label")).otherwise(F.col("last_label")))
        .drop("c_major", "w_all", "w_major", "w_hubs", "first_label", "last_label")
    )
    chance = F.pmod(F.col("drawn"), F.lit(1 << 30)) / float(1 << 30)
    sure = (F.col("label") == F.col("sure.label")) & (F.col("drawn") == F.col("sure.least"))
    spread = F.xxhash64("id", F.lit(7))
    blocks = F.col("n_blocks") - F.col("n_hub_blocks")
    own = F.when(F.col("is_hub"), F.pmod(spread, F.col("n_hub_blocks"))).otherwise(
        F.col("n_hub_blocks") + F.pmod(spread, F.greatest(F.lit(1), blocks))
    )
    # A hub meets all blocks, any other text the blocks of hubs.
    met = F.sequence(F.lit(0), F.when(F.col("is_hub"), F.greatest(F.col("n_blocks"), F.col("n_hub_blocks") + 1)).otherwise(F.col("n_hub_blocks")) - 1)
    pairs = F.transform(met, lambda k: F.struct(F.least(k, "block").alias("first"), F.greatest(k, "block").alias("second")))
    alone = F.array(F.struct(F.lit(0).alias("first"), F.lit(0).alias("second")))
    return (
        rows.join(nodes, "node")
        .withColumn("is_hub", (F.col("label") != F.col("major")) & ((chance < F.col("rate")) | sure))
        .withColumn("block", F.when(F.col("small"), 0).otherwise(own).cast("int"))
        .withColumn("pair", F.explode(F.when(F.col("small"), alone).otherwise(pairs)))
        .select(
            F.xxhash64("node", "pair.first", "pair.second").alias("cell"), "node", "id", "label", "is_hub", "depth",
            (F.col("pair.first") != F.col("pair.second")).alias("two"),
            (F.col("block") != F.col("pair.first")).cast("int").alias("side"),
            # The children of a text come from one of its cells.
            ((F.col("rate") < 1) & ~F.col("is_hub") & (F.col("pair.first") == 0)).alias("goes_on"),
        )
    )


def near_duplicates(
    documents: DataFrame,
    percent: int = 80,
    shingle_size: int = 5,
    miss: float = 1e-6,
    cell_rows: int = 384,
    hubs: int = 512,
    max_depth: int = 8,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash and group_key of every row.

    Texts are linked if their sets' Jaccard similarity is at least ``percent`` hundredths.  The component
    is named by its smallest doc_id, and that document is kept.  Null texts and texts without words have
    no shingles and are linked with nothing.  Equal sets are compared once.  Rows that repeat a doc_id
    with another text are vertices of their own; ``text_hash`` tells them apart, and ``group_key`` components
    of one name.  A row with a null doc_id is linked with nothing and has a null component and is not
    kept.  An empty table gives no rows; other columns are not read.  A text is hashed and, in a cell,
    compared whole: a task holds the texts of one cell.
    """
    trees = trees_for(percent / 100, miss)
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = stage(
        texts.mapInPandas(
            _signatures(shingle_size, trees), "id long, text_hash long, n long, low long, high long, paths array<long>"
        )
    )
    # A class is all rows with one set; its first row stands for it, under a number of the class.
    keys = ["low", "high", "n"]
    rows_of_class = signed.where("n > 0 AND id IS NOT NULL").groupBy(*keys).agg(
        F.min_by("paths", "id").alias("paths"), F.min(F.struct("id", "text_hash")).alias("first")
    )
    classes = stage(rows_of_class.select(F.xxhash64(*keys).alias("id"), *keys, "first.*", "paths").toDF(
        "id", *keys, "doc", "hash", "paths"
    ))
    rooted = classes.select("id", "n", F.posexplode("paths").alias("tree", "node"))
    sizes = rooted.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    roots = stage(rooted.join(sizes.select("node"), "node").select("id", "n", "tree", "node"))
    # The same join at every size: a broadcast of these rows would grow with the corpus.
    wanted = classes.join(roots.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("class"), "doc", "hash")
    met = texts.join(wanted.hint("merge"), (F.col("id") == F.col("doc")) & (F.col("text_hash") == F.col("hash")))
    near = stage(
        met.dropDuplicates(["doc", "hash"]).select(F.col("class").alias("id"), "text").mapInPandas(_packed, "id long, text binary")
    )
    frontier = roots.where("tree = 0").select("node", "id", "n", F.lit(0).alias("depth"))
    later = roots.where("tree > 0").select("node", "id", "n", F.lit(0).alias("depth"))
    joined = None
    for draw in count():
        cells = stage(_cells(frontier, joined, cell_rows, hubs, draw))
        if cells.isEmpty():
            if later is None:
                break
            frontier, later = later, None
            continue
        found = stage(
            cells.join(near, "id").repartition("cell").sortWithinPartitions("cell")
            .mapInPandas(_compare(shingle_size, percent, max_depth), "kind int, a long, b long, n long, depth int")
        )
        joined = further_components(joined, found.where("kind = 0").select("a", "b"))
        frontier = found.where("kind = 1").select(F.col("b").alias("node"), F.col("a").alias("id"), "n", "depth").distinct()
        if later is not None:
            frontier, later = frontier.unionByName(later), None
    named = classes.select(*keys, F.col("id").alias("first"), "doc")
    if joined is None:
        named = named.withColumn("label", F.col("first"))
    else:
        named = named.join(joined.withColumnRenamed("id", "first"), "first", "left").withColumn(
            "label", F.coalesce("component", "first")
        )
    smallest = named.groupBy("label").agg(F.min("doc").alias("smallest"))
    result = signed.join(named.join(smallest, "label").select(*keys, "label", "smallest"), keys, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("smallest", "id"))
    return result.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"), "text_hash",
        F.coalesce("label", F.xxhash64("id", "text_hash")).alias("group_key"),
    )


def one_per_group(documents: DataFrame, groups: DataFrame) -> DataFrame:
    """The kept documents, one row for each group; rows with a null doc_id stay.

    Of rows that have one doc_id and one text, the first by its JSON form is taken.  Columns may have any names.
    """
    kept = groups.where("kept").groupBy("group_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    kept = kept.groupBy("first.doc_id", "first.text_hash").agg(F.lit(1).alias("found")).drop("found")
    rows = documents.select(
        F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
    )
    found = rows.join(kept, ["doc_id", "text_hash"])
    once = found.groupBy("doc_id", "text_hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return once.select("row.*").unionByName(rows.where("doc_id IS NULL").select("row.*"))
