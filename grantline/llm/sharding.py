"""Shards of near equal bytes by a k-d tree over the documents' metadata.

A node is split along its widest dimension (extent relative to the whole table's) where the weight of
its items divides as the numbers of shards below do, so an eight-shard tree has three levels of medians.
Items are texts, with all their copies: equal texts share a shard.  The cut of every node of a level is
found together, by weights per range of keys that are narrowed round by round; only these sums, at most
``SUMS`` of them, and the tree itself reach the driver.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from grantline.sinks.shared import stage

#: Sums that one round may bring to the driver.
SUMS = 1 << 16
#: A tree is joined to the items by broadcast, so its size is bounded.
MAX_SHARDS = 1 << 14
_SPACE = 1 << 62


@dataclass
class Node:
    number: int
    first_shard: int
    n_shards: int


def _order_key(value: Column) -> Column:
    """Text as a number of the same order, by its first seven bytes."""
    return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def metadata(documents: DataFrame) -> dict[str, Column]:
    """The default dimensions: numbers as they are, texts in alphabetical order, nulls first."""
    dimensions = {}
    for name, kind in documents.dtypes:
        if name in ("doc_id", "n_chars"):
            dimensions[name] = F.coalesce(F.col(name).cast("long"), F.lit(-1))
        elif name in ("lang", "source") and kind == "string":
            dimensions[name] = F.coalesce(_order_key(F.col(name)), F.lit(-1))
    return dimensions


def _with_keys(items: DataFrame, cuts: list[tuple], n_dimensions: int) -> DataFrame:
    """Items of the nodes that are split, with their key in 62 bits: the place on the node's widest
    dimension, then a hash that divides what is equal there."""
    spark = items.sparkSession
    table = F.broadcast(spark.createDataFrame(cuts, "node long, dimension int, least double, extent double"))
    dimension = F.element_at(F.array(*[f"d{n}" for n in range(n_dimensions)]), F.col("dimension") + 1).cast("double")
    place = F.when(F.col("extent") > 0, (dimension - F.col("least")) / F.col("extent")).otherwise(0.0)
    high = F.least(F.floor(place * (2**30 - 1)), F.lit(2**30 - 1)).cast("long")
    low = F.xxhash64("text_hash", "size", "text_crc32", F.lit(11)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return items.join(table, "node").withColumn("key", F.shiftleft(high, 32).bitwiseOR(low))


def _cuts(keyed: DataFrame, wanted: dict[int, float], tolerance: float) -> dict[int, int]:
    """For each node the key below which there is about the wanted weight."""
    spark = keyed.sparkSession
    slots = 1 << max(4, (SUMS // len(wanted)).bit_length() - 1)
    found: dict[int, int] = {}
    ranges = {node: (0, _SPACE, 0.0) for node in wanted}
    while ranges:
        width = {node: max(1, -(-(high - low) // slots)) for node, (low, high, _) in ranges.items()}
        table = F.broadcast(
            spark.createDataFrame(
                [(node, low, high, width[node]) for node, (low, high, _) in ranges.items()],
                "node long, low long, high long, width long",
            )
        )
        inside = keyed.join(table, "node").where("key >= low AND key < high")
        sums: dict[int, dict[int, int]] = {node: {} for node in ranges}
        for row in inside.groupBy("node", F.expr("(key - low) DIV width").alias("slot")).agg(F.sum("weight").alias("w")).collect():
            sums[row.node][row.slot] = row.w
        narrowed = {}
        for node, (low, high, before) in ranges.items():
            for slot in sorted(sums[node]):
                weight = sums[node][slot]
                start = low + slot * width[node]
                if before + weight < wanted[node]:
                    before += weight
                    found[node] = start + width[node]
                    continue
                if weight <= tolerance or width[node] == 1:
                    nearer = wanted[node] - before < before + weight - wanted[node]
                    found[node] = start if nearer else start + width[node]
                else:
                    narrowed[node] = (start, min(high, start + width[node]), before)
                break
        ranges = narrowed
    return found


def kd_shards(
    documents: DataFrame,
    n_shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None,
    tolerance: float = 1e-4,
    slot_groups: int = 1024,
) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every row.

    The size of a row is its text's UTF-8 bytes plus 1; a null text counts as empty.  Leaves are split
    until there are ``n_shards``, or as many as make ``target_bytes`` each.  Shards differ by at most
    ``tolerance`` of the total per cut, and by the bytes of one text with all its copies, which stay
    together however many they are.  Ties on a dimension are divided by a hash of the text.  Null
    metadata sort first.  Slots count each shard's rows from 0; repeated rows get slots of their own.
    An empty table gives no rows; other columns are not read.
    """
    columns = metadata(documents) if dimensions is None else dimensions
    names = [f"d{n}" for n in range(len(columns))]
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            *[column.alias(name) for name, column in zip(names, columns.values())],
        )
    )
    keys = ["text_hash", "size", "text_crc32"]
    items = stage(
        rows.groupBy(*keys).agg(F.sum("size").alias("weight"), *[F.min(n).alias(n) for n in names]).withColumn(
            "node", F.lit(0).cast("long")
        )
    )
    extents = [F.min(n).alias(f"low_{n}") for n in names] + [F.max(n).alias(f"high_{n}") for n in names]
    whole = items.agg(F.sum("weight").alias("weight"), *extents).first()
    total = whole.weight or 0
    shards = n_shards or max(1, -(-total // (target_bytes or 1 << 30)))
    if shards > MAX_SHARDS:
        raise ValueError(f"{shards} shards: the tree is kept to {MAX_SHARDS}")
    span = [max(1, (whole[f"high_{n}"] or 0) - (whole[f"low_{n}"] or 0)) for n in names]
    level = [Node(0, 0, shards)]
    leaves: list[Node] = []
    while level:
        leaves += [node for node in level if node.n_shards == 1]
        level = [node for node in level if node.n_shards > 1]
        if not level:
            break
        seen = {row.node: row for row in items.groupBy("node").agg(F.sum("weight").alias("weight"), *extents).collect()}
        cuts, wanted = [], {}
        for node in level:
            row = seen.get(node.number)
            if row is None:
                continue
            widths = [(row[f"high_{n}"] - row[f"low_{n}"]) / s for n, s in zip(names, span)]
            widest = widths.index(max(widths))
            low, high = float(row[f"low_d{widest}"]), float(row[f"high_d{widest}"])
            cuts.append((node.number, widest, low, high - low))
            wanted[node.number] = row.weight * (node.n_shards // 2) / node.n_shards
        children = []
        for node in level:
            half = node.n_shards // 2
            children.append(Node(2 * node.number + 1, node.first_shard, half))
            children.append(Node(2 * node.number + 2, node.first_shard + half, node.n_shards - half))
        if cuts:
            keyed = _with_keys(items, cuts, len(names))
            found = _cuts(keyed, wanted, tolerance * total)
            table = F.broadcast(
                items.sparkSession.createDataFrame([(n, found.get(n, 0)) for n in wanted], "node long, cut long")
            )
            moved = keyed.join(table, "node").withColumn(
                "node", 2 * F.col("node") + F.when(F.col("key") < F.col("cut"), 1).otherwise(2)
            )
            done = items.join(F.broadcast(table.select("node")), "node", "left_anti")
            items = stage(moved.select(*keys, "weight", *names, "node").unionByName(done.select(*keys, "weight", *names, "node")))
        level = children
    numbers = items.sparkSession.createDataFrame([(n.number, n.first_shard) for n in leaves], "node long, shard int")
    placed = stage(
        rows.join(items.join(F.broadcast(numbers), "node").select(*keys, "shard"), keys)
        .select("doc_id", "size", "text_crc32", "shard",
                F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slot_groups)).cast("int").alias("part"))
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    return (
        placed.withColumn("place", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("offset") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def write_shards(documents: DataFrame, shards: DataFrame, path: str) -> None:
    """Write the documents to one folder per shard, by ``doc_id`` and the text's checksum."""
    keyed = documents.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    places = shards.select("doc_id", "text_crc32", "shard").distinct()
    keyed.join(places, ["doc_id", "text_crc32"]).drop("text_crc32").write.partitionBy("shard").parquet(path)
