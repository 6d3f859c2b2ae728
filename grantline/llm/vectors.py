"""Near-duplicate vectors by an exact metric range join.

On the unit sphere, cosine >= c is the same as distance <= r with r = sqrt(2 - 2c).  Pivots cut each
group (label and dimension) into cells of the vectors nearest to them.  If y lies in the cell of pivot
q and within r of x, which lies in the cell of p, then d(x, q) <= d(y, q) + r <= d(y, p) + r <=
d(x, p) + 2r, and d(x, q) <= R(q) + r with R(q) the radius of the cell: vectors that meet both are
copied into the cell of q, all others cannot have a partner there.  Every cell is then joined on its
own.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from grantline.llm.groups import components, runs
from grantline.sinks.shared import stage

#: Allowance for rounding in distances; links are decided on the cosine itself.
SLACK = 1e-6


def _unit(vectors) -> np.ndarray:
    rows = np.array(list(vectors), dtype=np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distance to every pivot, pivots being the first rows of each run (columns as in _CELLED)."""
    for rows in runs(frames, "part"):
        is_pivot = rows["pivot"].to_numpy() >= 0
        own = rows[~is_pivot]
        if not len(own):
            continue
        distance = _distances(_unit(own["vector"]), _unit(rows["vector"][is_pivot]))
        home = distance.argmin(axis=1)
        yield pd.DataFrame(
            {
                "grp": own["grp"].to_numpy(),
                "id": own["id"].to_numpy(),
                "copies": own["copies"].to_numpy(),
                "vector": own["vector"].to_numpy(),
                "home": rows["pivot"][is_pivot].to_numpy()[home],
                "home_distance": distance.min(axis=1),
                "pivots": [rows["pivot"][is_pivot].to_numpy()] * len(own),
                "distances": list(distance),
            }
        )


_CELLED = (
    "grp long, id long, copies long, vector array<double>, home int, home_distance double, "
    "pivots array<int>, distances array<double>"
)


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def spanning(pairs) -> dict[int, int]:
    """The least id joined to each id of the pairs."""
    parent: dict[int, int] = {}
    for a, b in pairs:
        a, b = _root(parent, int(a)), _root(parent, int(b))
        parent[max(a, b)] = min(a, b)
    return {x: _root(parent, x) for x in parent}


def _cell_links(cosine: float):
    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs(frames, "part"):
            left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
            if not len(left) or not len(right):
                continue
            ids, others = left["id"].to_numpy(), right["id"].to_numpy()
            a, b = np.array(list(left["vector"])), np.array(list(right["vector"]))
            near = _unit(a) @ _unit(b).T >= cosine - SLACK
            near &= ids[:, None] < others[None, :]
            i, j = near.nonzero()
            dots = np.einsum("nd,nd->n", a[i], b[j])
            lengths = np.sqrt(np.einsum("nd,nd->n", a, a))[i] * np.sqrt(np.einsum("nd,nd->n", b, b))[j]
            linked = dots / lengths >= cosine
            i, j = i[linked], j[linked]
            if not len(i):
                continue
            degree: dict[int, int] = {}
            for x, n in zip(ids[i].tolist() + others[j].tolist(),
                            right["copies"].to_numpy()[j].tolist() + left["copies"].to_numpy()[i].tolist()):
                degree[x] = degree.get(x, 0) + n
            root = spanning(zip(ids[i], others[j]))
            yield pd.DataFrame({"id": list(degree), "degree": list(degree.values()), "root": [root[x] for x in degree]})

    return compared


def near_duplicate_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    group_column: str = "label",
    cell_rows: int = 4096,
    max_pivots: int = 256,
    block_rows: int = 1024,
) -> DataFrame:
    """One row per vector: its id, n_links, component_id and kept.

    Vectors are compared if their groups are equal and not null and they have the same dimension.
    Null ids, null or empty vectors, zero vectors and vectors with null or non-finite components link
    with nothing; such a row has no links and is its own component (a null id: a null component, and
    not kept).  Equal vectors of a group are compared once and counted as linked with each other; a
    repeated row counts as one more vector, and so do different vectors of one id.  Other columns are not read.  An empty table gives an
    empty result.

    A group gets a pivot for every ``cell_rows`` distinct vectors, ``max_pivots`` at most; a pivot is
    any vector of the group, so the choice affects only the work.  The larger a cell, the more blocks
    of ``block_rows`` it is compared in: a task holds two blocks.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.col(group_column).alias("label"),
    )
    usable = F.expr(
        "id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0"
        " AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    keyed = rows.where(usable).withColumn("grp", F.xxhash64("label", F.size("vector")))
    distinct = stage(
        keyed.groupBy("grp", "label", "vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumn("id", F.xxhash64("grp", "label", "vector"))  # a number of the vector: ids may repeat
    )
    sizes = stage(
        distinct.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "n_pivots", F.least(F.lit(max_pivots), F.ceil(F.col("n") / cell_rows)).cast("int")
        )
    )
    sized = distinct.join(sizes, "grp").withColumn("pivot", F.pmod(F.xxhash64("id"), F.col("n_pivots")).cast("int"))
    pivots = stage(
        sized.groupBy("grp", "pivot").agg(F.min_by("vector", F.xxhash64("id", F.lit(1))).alias("vector"))
    )
    # Every slice of a group meets all its pivots.
    slices = sizes.select("grp", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / block_rows).cast("int"))).alias("slice"))
    placed = sized.select(
        "grp",
        F.pmod(F.xxhash64("id", F.lit(2)), F.ceil(F.col("n") / block_rows).cast("int") + 1).cast("int").alias("slice"),
        F.lit(-1).alias("pivot"), "id", "copies", "vector",
    ).unionByName(
        pivots.join(slices, "grp").select("grp", "slice", "pivot", F.lit(-1).cast("long").alias("id"),
                                          F.lit(0).cast("long").alias("copies"), "vector")
    )
    celled = stage(
        placed.withColumn("part", F.xxhash64("grp", "slice"))
        .repartition("part").sortWithinPartitions("part")
        .mapInPandas(_nearest, _CELLED)
    )
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * cosine)) + SLACK
    radii = celled.groupBy("grp", F.col("home").alias("cell")).agg(
        F.max("home_distance").alias("reach"), F.count(F.lit(1)).alias("n_home")
    )
    in_cells = (
        celled.select("grp", "id", "copies", "vector", "home", "home_distance",
                      F.explode(F.arrays_zip("pivots", "distances")).alias("p"))
        .select("grp", "id", "copies", "vector", "home", F.col("p.pivots").alias("cell"), F.col("p.distances").alias("d"), "home_distance")
        .where((F.col("cell") == F.col("home")) | (F.col("d") <= F.col("home_distance") + 2 * radius))
        .join(radii, ["grp", "cell"])
        .where((F.col("cell") == F.col("home")) | (F.col("d") <= F.col("reach") + radius))
    )
    members = stage(in_cells.select("grp", "cell", "id", "copies", "vector", "n_home", (F.col("cell") == F.col("home")).alias("is_home")))
    counts = members.groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("n_all"))
    blocked = members.join(counts, ["grp", "cell"]).withColumns(
        {
            "n_left": F.ceil(F.col("n_home") / block_rows),
            "n_right": F.ceil(F.col("n_all") / block_rows),
        }
    )
    left = blocked.where("is_home").select(
        "grp", "cell", "id", "copies", "vector", F.lit(0).alias("side"),
        F.pmod(F.xxhash64("id", F.lit(3)), "n_left").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_right") - 1)).alias("j"),
    )
    right = blocked.select(
        "grp", "cell", "id", "copies", "vector", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_left") - 1)).alias("i"),
        F.pmod(F.xxhash64("id", F.lit(4)), "n_right").alias("j"),
    )
    found = stage(
        left.unionByName(right).select("id", "copies", "vector", "side", F.xxhash64("grp", "cell", "i", "j").alias("part"))
        .repartition("part").sortWithinPartitions("part")
        .mapInPandas(_cell_links(cosine), "id long, degree long, root long")
    )
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    degrees = found.groupBy("id").agg(F.sum("degree").alias("degree"))
    labelled = distinct.join(degrees, "id", "left").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = labelled.join(smallest, "component").select(
        "grp", "label", "vector", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    compared = keyed.join(classes, ["grp", "label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return compared.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
