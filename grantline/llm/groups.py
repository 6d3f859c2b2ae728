"""Rows of one key in a sorted stream of batches, and connected components."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from grantline.sinks.shared import stage


def runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """One frame for each run of equal keys; a run may go over several batches."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        keys = frame[key].to_numpy()
        cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1), len(frame)]
        for start, end in zip(cuts, cuts[1:]):
            part = frame.iloc[start:end]
            if held and held[-1][key].iloc[0] != part[key].iloc[0]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def hashed_sample(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """About ``limit`` rows, or all if there are fewer: those whose keys hash below a share of the range.

    No task has to order or hold more than its share of the sample.  Rows with equal keys go together.
    """
    n, slots = rows.count(), 1 << 40
    share = min(1.0, limit / n) if n else 1.0
    return rows.where(F.pmod(F.xxhash64(*keys, F.lit(41)), F.lit(slots)) < int(slots * share))


def components(links: DataFrame) -> DataFrame:
    """(id, component): for each id that occurs in the links (a, b), the smallest id it is joined to.

    Vertices are contracted to their least neighbour in a hashed order until no link is left, which
    takes a number of rounds that grows with the logarithm of the number of vertices.  Every round is
    a table in the shared folder.  A vertex with many links is counted up before the shuffle and its
    joins are left to adaptive splitting.
    """
    left = stage(links.select("a", "b").where("a <> b").distinct())
    roots = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        least = both.groupBy("a").agg(F.min_by("b", F.xxhash64("b")).alias("b"))
        parents = stage(
            least.select(
                F.col("a").alias("id"),
                F.when(F.xxhash64("b") < F.xxhash64("a"), F.col("b")).otherwise(F.col("a")).alias("root"),
            )
        )
        if roots is None:
            roots = parents
        else:
            later = parents.select(F.col("id").alias("root"), F.col("root").alias("next"))
            roots = stage(
                roots.join(later, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
            )
        ends = [parents.select(F.col("id").alias(end), F.col("root").alias(f"{end}_root")) for end in ("a", "b")]
        moved = left.join(ends[0], "a").join(ends[1], "b")
        left = stage(
            moved.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).where("a <> b").distinct()
        )
    if roots is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    smallest = roots.groupBy("root").agg(F.min("id").alias("component"))
    return stage(roots.join(smallest, "root").select("id", "component"))


def further_components(joined: DataFrame | None, links: DataFrame) -> DataFrame:
    """What ``components`` gives for further links, and those behind ``joined``, together.

    Only the components that the new links join are contracted, so a round costs what is new and is not
    followed by all rounds of the links before it.
    """
    if joined is None:
        return components(links)
    ends = [joined.select(F.col("id").alias(end), F.col("component").alias(f"{end}_root")) for end in ("a", "b")]
    roots = [F.coalesce(f"{end}_root", end).alias(end) for end in ("a", "b")]
    merged = components(links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(*roots))
    later = merged.select(F.col("id").alias("component"), F.col("component").alias("next"))
    moved = joined.join(later, "component", "left").select("id", F.coalesce("next", "component").alias("component"))
    return stage(moved.unionByName(merged.join(joined, "id", "left_anti")))
