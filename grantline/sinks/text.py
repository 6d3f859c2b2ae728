"""Text documents."""

import datetime
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from grantline.fixed import DOCUMENT_PREFIXES
from grantline.schemas import DOCUMENT_ORDER
from grantline.sinks.shared import stage

#: Parts of a document, and the sections that it may have.
N_FILES = 8
MAX_SECTIONS = 8
#: Ranges that the pieces of a part are sorted in, and of a document at least.
RANGES = 16
MIN_RANGES = 64


def document_path(folder: str, kind: str, at: datetime.datetime | None = None) -> str:
    at = at or datetime.datetime.now()
    return f"{folder.rstrip('/')}/{DOCUMENT_PREFIXES[kind]}{at:%Y%m%d_%H%M%S}.tf"


@dataclass(frozen=True)
class Written:
    """A written document: how many pieces it has, and how many blocks in each section."""

    path: str
    n_pieces: int
    n_blocks: dict[int, int]


def write_document(
    document: DataFrame, path: str, order: list[str] = DOCUMENT_ORDER, n_files: int = N_FILES
) -> Written:
    """Write the pieces of a document in order, in ``n_files`` parts whatever its size.

    The parts in name order are the document.  All pieces of a block are in one part, so each part is
    made of whole blocks.

    The pieces are staged first: the limits of the ranges are sampled from their keys, and the document is
    not computed a second time for that.  They are sorted in ``RANGES`` ranges for each part, by as many tasks,
    and leave them as packs: some thousand texts in a row, compressed.  The task that writes a part orders its
    packs and unpacks one at a time, so what it holds is small next to the part, also if that is the whole
    document.  Pieces are counted by the tasks that write them, behind the exchange, so neither the sample nor a
    task that is run again is counted.
    """
    keys = order[: order.index("part")]
    pieces = stage(document.select(*order, "output"))
    ranges = max(RANGES * n_files, MIN_RANGES)
    sections = [f"section_{n}" for n in range(MAX_SECTIONS)]
    packs = stage(
        pieces.repartitionByRange(ranges, *keys).sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("range"), "section", "part", "output")
        .mapInPandas(_packed, ", ".join(["range int, pack int, texts binary", *[f"{c} long" for c in ["n_pieces", *sections]]]))
    )
    # Some keys have many pieces, so parts are made of ranges by what these hold.
    held = packs.groupBy("range").agg(F.sum("n_pieces").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    share = F.coalesce(before, F.lit(0)) / F.sum("n").over(Window.partitionBy())
    placed = packs.join(held.select("range", F.floor(share * n_files).cast("int").alias("file")), "range")
    placed = placed.repartitionById(n_files, "file") if n_files > 1 else placed.repartition(1)
    counted = Observation(f"pieces of {path}")
    observed = placed.sortWithinPartitions("range", "pack").observe(
        counted, *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["n_pieces", *sections]]
    )
    observed.select("texts").mapInPandas(_unpacked, "output string").write.mode("overwrite").text(path)
    found = counted.get
    return Written(path, found["n_pieces"], {n: found[c] for n, c in enumerate(sections) if found[c]})


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The texts of each batch of sorted pieces as one compressed text, and how many pieces and blocks they are."""
    for number, frame in enumerate(frames):
        starts = frame["section"][frame["part"] == 0]
        blocks = {f"section_{n}": [int((starts == n).sum())] for n in range(MAX_SECTIONS)}
        # A null text is a line without content, as the text writer has it.
        texts = zlib.compress("\n".join(frame["output"].fillna("")).encode(), 1)
        yield pd.DataFrame(
            {"range": frame["range"].iloc[:1].to_numpy(), "pack": [number], "texts": [texts], "n_pieces": [len(frame)], **blocks}
        )


def _unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per pack, which is written with a line feed behind it as each piece is."""
    for frame in frames:
        for texts in frame["texts"]:
            yield pd.DataFrame({"output": [zlib.decompress(texts).decode()]})


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written document as ``line_no`` (from 1, through all parts) and ``line``.

    Lines are counted per piece of a file that one task reads; the counts, one row per such piece, are
    summed up in file order, and each line adds its place in the piece.  The lines themselves are never
    in one task.
    """
    read = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )
    pieces = read.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return read.join(offsets, ["file", "start"]).select(
        (F.col("offset") + F.col("at") - F.col("first") + 1).alias("line_no"), "line"
    )


def write_allowlist(payload: DataFrame, path: str, n_files: int = N_FILES) -> None:
    """Write one valid JSON document per artifact type, below ``path/artifact_type=...``.

    A document may be in several parts, as in ``write_document``.
    """
    order = ["artifact_type", "part", "item"]
    placed = stage(payload.select(*order, "output")).repartitionByRange(n_files, *order).sortWithinPartitions(*order)
    placed.select("artifact_type", "output").write.mode("overwrite").partitionBy("artifact_type").text(path)
