"""Repeated substrings by merging Burrows-Wheeler transforms.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier in the table.

Strings first meet those that they could be equal to.  Every string of ``length`` bytes has a least
gram of ``GRAM`` bytes in a hashed order; runs of starts with the same least gram make one segment of text, and
strings that are equal have the same gram at the same offset, so no segment holds a string twice.  Equal segments are collapsed to their first place, each
later place being a repeat as a whole, and segments whose gram is in no other segment hold no repeat
and are left out.  What stays is dealt to cells by gram, where the same is done once more with another order of the grams.

In a cell, shards of segments get a Burrows-Wheeler transform each, over the rotations of each segment.
The transforms are merged by refining their interleave: if it is right for the first h symbols, reading
off the symbols before each suffix and dividing it by them, in order, makes it right for h + 1.  No
suffix is compared or sorted again.  Boundaries between suffixes that differ in the first h symbols
are carried along, so after ``length`` bytes the blocks between boundaries are the intervals of
suffixes with that common prefix, and a block of more than one is a repeated string.  A symbol is a few
bytes.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, functions as F

from grantline.llm.words import mixed
from grantline.sinks.shared import stage

GRAM = 40
#: Bytes of text that are divided into segments at once, of one shard and of one cell.
CHUNK, SHARD, CELL = 1 << 21, 1 << 18, 1 << 21
#: A gram with more segments is divided by the strings themselves.
HOT = 512
_BYTES = np.random.default_rng(77).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.random.default_rng(78).integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(79).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = (1 << 63) - 1


def _grams(text: np.ndarray, order: int) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on: of two overlapping runs of a power of two."""
    h, reach = _BYTES[text], 1
    while 2 * reach <= GRAM:
        h = h[:-reach] * _STEP[reach.bit_length()] + h[reach:]
        reach *= 2
    n = len(text) - GRAM + 1
    return mixed((h[:n] * _STEP[0] + h[GRAM - reach : GRAM - reach + n]) ^ _PLACE[-1 - order])


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int, order: int = 0) -> tuple[np.ndarray, ...]:
    """(text, start, starts, gram, hash) of the segments of each text, by the grams' order of that number."""
    width = length - GRAM + 1
    out: list[tuple] = []
    block: list[int] = []
    held = 0

    def flush() -> None:
        data = np.frombuffer(b"".join(texts[i] for i in block), np.uint8)
        if len(data) < length:
            return
        sizes = np.array([len(texts[i]) for i in block])
        first = np.cumsum(sizes) - sizes
        grams = _grams(data, order)
        least = _window_least(grams, width)
        valid = np.zeros(len(least) + 1, bool)
        for f, s in zip(first, sizes):
            if s >= length:
                valid[f : f + s - length + 1] = True
        valid = valid[: len(least)]
        change = np.ones(len(least), bool)
        # A window whose least gram is its first one is the last to have it.
        change[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
        begins = np.zeros(len(least), bool)
        begins[first[sizes >= length]] = True
        change |= begins
        at = np.flatnonzero(change & valid)
        # A run ends where the next begins or its text has no more starts.
        end_of = np.repeat(first + sizes - length + 1, sizes)
        ends = np.minimum(np.append(at[1:], len(least)), end_of[at])
        n = ends - at
        total = n.astype(np.uint64)
        last = ends + length - 1 - GRAM
        for k in range((width + length) // GRAM + 1):
            total += grams[np.minimum(at + k * GRAM, last)] * _PLACE[k]
        place = np.searchsorted(first, at, side="right") - 1
        while len(place) and (at >= first[place] + sizes[place]).any():
            place = np.where(at >= first[place] + sizes[place], place - 1, place)
        out.append((np.array(block)[place], at - first[place], n, least[at], mixed(total)))

    for i, text in enumerate(texts):
        block.append(i)
        held += len(text)
        if held >= CHUNK:
            flush()
            block, held = [], 0
    if block:
        flush()
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    return tuple(np.concatenate(part) for part in zip(*out))


_SEGMENT = "gram long, hash long, doc long, nth long, start long, n long"


def _found(length: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments of a batch that are first in it, and, with a null gram, the places of the others."""
        for batch in batches:
            texts = [t or b"" for t in batch.column("bytes").to_pylist()]
            docs, nths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "nth"))
            place, start, n, gram, own = segments(texts, length)
            doc, nth = (docs[place], nths[place]) if len(place) else (place, place)
            order = np.lexsort((start, nth, doc, own, gram))
            place, start, n, gram, own, doc, nth = (x[order] for x in (place, start, n, gram, own, doc, nth))
            again = np.zeros(len(own), bool)
            again[1:] = (own[1:] == own[:-1]) & (gram[1:] == gram[:-1])
            later = _later(~again, doc, nth, start)
            keep = ~again | later
            back = np.flatnonzero(keep)[np.lexsort((start[keep], nth[keep], doc[keep]))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram[back].view(np.int64), mask=later[back]), pa.array(own[back].view(np.int64)),
                    pa.array(doc[back]), pa.array(nth[back]), pa.array(start[back].astype(np.int64)), pa.array(n[back].astype(np.int64)),
                ],
                ["gram", "hash", "doc", "nth", "start", "n"],
            )

    return found


def _later(new: np.ndarray, doc: np.ndarray, nth: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of equal things in the order of doc, nth and start, the first being ``new``: which are the first of a
    later place.  The same place of rows that repeat doc_id and text is not earlier than itself."""
    before = np.ones(len(new), bool)
    before[1:] = (doc[1:] != doc[:-1]) | (nth[1:] != nth[:-1]) | (start[1:] != start[:-1])
    return ~new & before


def _met(gram: np.ndarray, own: np.ndarray, doc: np.ndarray, nth: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of segments in the order of gram, hash, doc, nth and start: which are at a later place than an equal one,
    which are first and not the only ones of their gram, and how many different ones the gram has."""
    new_gram = np.ones(len(gram), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new = new_gram.copy()
    new[1:] |= own[1:] != own[:-1]
    later = _later(new, doc, nth, start)
    group = np.cumsum(new_gram) - 1
    count = np.bincount(group, weights=new)[group].astype(np.int64) if len(group) else group
    return later, new & (count > 1), count


def _meetings():
    """Of rows sorted by gram, hash, doc, nth and start: later places (kind 1), and first places of segments that
    have to be compared (kind 0), with the number of segments of their gram."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "hash", "doc", "nth", "start", "n"]
        held: list[np.ndarray] | None = None

        def settle(rows: list[np.ndarray]) -> pa.RecordBatch:
            gram, own, doc, nth, start, n = rows
            later, compared, count = _met(gram, own, doc, nth, start)
            use = later | compared
            return pa.RecordBatch.from_arrays(
                [pa.array(later[use].astype(np.int32)), *(pa.array(x[use]) for x in (gram, doc, nth, start, n)),
                 pa.array(count[use].astype(np.int64))],
                ["kind", "gram", "doc", "nth", "start", "n", "n_segments"],
            )

        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows)]
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            held = [x[cut:] for x in rows]
            if cut:
                yield settle([x[:cut] for x in rows])
        if held is not None:
            yield settle(held)

    return met


def transform(shard: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order of all rotations of the shard's strings by their first ``length`` bytes, the strings'
    bytes, and for each byte the first place of its string and the string's length."""
    sizes = np.array([len(s) for s in shard])
    data = np.frombuffer(b"".join(shard), np.uint8)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    inner = np.arange(len(data)) - first
    key = np.zeros(len(data), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | data[first + (inner + k) % size]
    depth, ranks = 8, _dense(key)
    while depth < length and ranks.max() < len(data) - 1:
        step = min(depth, length - depth)
        ahead = ranks[first + (inner + step) % size]
        ranks = _dense(ranks.astype(np.uint64) * np.uint64(len(data)) + ahead.astype(np.uint64))
        depth += step
    return np.argsort(ranks, kind="stable"), data, first, size


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(key), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return ranks


def merged_blocks(shards: list[list[bytes]], length: int) -> list[np.ndarray]:
    """For every byte of every shard, the number of the block of suffixes (rotations) that share its first
    ``length`` bytes, and a negative number of its own for a suffix that shares them with no other.

    The interleave is a list of rows of the shards' transforms.  A suffix that differs from all others in the first h
    symbols is settled, and so is the one that a symbol more before it makes: neither has to be followed.
    """
    parts = [transform(shard, length) for shard in shards]

    def before(width: int) -> np.ndarray:
        symbols = []
        for order, data, first, size in parts:
            inner = np.arange(len(data)) - first
            symbol = np.zeros(len(data), np.uint64)
            for k in range(width, 0, -1):
                symbol = (symbol << np.uint64(8)) | data[first + (inner - k) % size]
            symbols.append(symbol[order])
        return _dense(np.concatenate(symbols))

    width = next(w for w in (4, 3, 2, 1) if length % w == 0)
    symbols = before(width)
    if symbols.max() > 65535:
        width = 2 if length % 2 == 0 else 1
        symbols = before(width)
    symbols = symbols.astype(np.uint16)
    sizes = np.array([len(order) for order, *_ in parts])
    firsts = np.cumsum(sizes) - sizes
    # The row of each suffix with the symbol before it: a shard's rows in the order of those symbols.
    back = np.empty(len(symbols), np.int32)
    for first, size in zip(firsts, sizes):
        back[first + np.argsort(symbols[first : first + size], kind="stable")] = np.arange(first, first + size)
    rows = np.arange(len(symbols), dtype=np.int32)
    block = np.zeros(len(rows), np.int32)
    for _ in range(length // width):
        ahead = symbols[rows]
        order = np.argsort(ahead, kind="stable")
        rows, block, ahead = back[rows[order]], block[order], ahead[order]
        new = np.ones(len(block) + 1, bool)
        new[1:-1] = (ahead[1:] != ahead[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(new[:-1], dtype=np.int32)
        shared = ~(new[:-1] & new[1:])
        rows, block = rows[shared], block[shared]
    of_row = -1 - np.arange(len(symbols), dtype=np.int32)
    of_row[rows] = block
    out = []
    for (order, *_), first, size in zip(parts, firsts, sizes):
        own = np.empty(size, np.int32)
        own[order] = of_row[first : first + size]
        out.append(own)
    return out


def _merged_repeats(
    strings: list[bytes], docs: np.ndarray, nths: np.ndarray, starts: np.ndarray, length: int
) -> tuple[np.ndarray, ...]:
    """Runs (doc, nth, start, n) of the strings' starts whose block has an earlier one."""
    shards: list[list[bytes]] = [[]]
    held = 0
    for string in strings:
        if held >= SHARD:
            shards.append([])
            held = 0
        shards[-1].append(string)
        held += len(string)
    block = np.concatenate(merged_blocks(shards, length))
    sizes = np.array([len(s) for s in strings])
    string = np.repeat(np.arange(len(strings)), sizes)
    inner = np.arange(len(string)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = (inner <= sizes[string] - length) & (block >= 0)
    block, string, start = block[whole], string[whole], starts[string[whole]] + inner[whole]
    doc, nth = docs[string], nths[string]
    order = np.lexsort((start, nth, doc, block))
    block, doc, nth, start = block[order], doc[order], nth[order], start[order]
    new = np.ones(len(block), bool)
    new[1:] = block[1:] != block[:-1]
    later = _later(new, doc, nth, start)
    doc, nth, start = doc[later], nth[later], start[later]
    order = np.lexsort((start, nth, doc))
    doc, nth, start = doc[order], nth[order], start[order]
    run = np.ones(len(doc), bool)
    run[1:] = (doc[1:] != doc[:-1]) | (nth[1:] != nth[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(run)
    last = np.append(at[1:], len(doc))[: len(at)] - 1
    return doc[at], nth[at], start[at], start[last] - start[at] + 1


def _repeats(length: int):
    def cell(rows: pa.Table) -> pa.RecordBatch:
        whole_strings = rows.column("bytes").to_pylist()
        # Once more by the least grams in another order: what is equal is collapsed, what is alone left out.
        place, inner, n, gram, own = segments(whole_strings, length, order=1)
        key = mixed(rows.column("cell").to_numpy().view(np.uint64)[place] ^ gram)
        doc, nth = (rows.column(c).to_numpy()[place] for c in ("doc", "nth"))
        start = rows.column("start").to_numpy()[place] + inner
        order = np.lexsort((start, nth, doc, own, key))
        place, inner, n, key, own, doc, nth, start = (x[order] for x in (place, inner, n, key, own, doc, nth, start))
        later, compared, _ = _met(key, own, doc, nth, start)
        repeats = [(doc[later], nth[later], start[later], n[later])]
        strings = [whole_strings[p][i : i + k + length - 1] for p, i, k in zip(place[compared], inner[compared], n[compared])]
        if strings:
            repeats.append(_merged_repeats(strings, doc[compared], nth[compared], start[compared], length))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)) for part in zip(*repeats)], ["doc", "nth", "start", "n"])

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells are taken together until they fill ``CELL``; none is divided."""
        held: pa.Table | None = None
        for batch in batches:
            known = pa.compute.is_null(batch.column("bytes"))
            done = batch.filter(known)
            if len(done):
                yield pa.RecordBatch.from_arrays(
                    [*(done.column(c) for c in ("doc", "nth", "start")), pa.array(np.ones(len(done), np.int64))],
                    ["doc", "nth", "start", "n"],
                )
            rows = pa.Table.from_batches([batch.filter(pa.compute.invert(known))])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.nbytes >= CELL:
                cells = held.column("cell").to_numpy()
                cut = int(np.searchsorted(cells, cells[-1], side="left"))
                if cut:
                    yield cell(held.slice(0, cut))
                    held = held.slice(cut).combine_chunks()
        if held is not None and len(held):
            yield cell(held)

    return repeats


def _cut(length: int):
    """The bytes of the segments of each document; those of crowded grams string by string, and with null
    bytes where the batch has the string earlier."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"cell": [], "doc": [], "nth": [], "start": [], "bytes": []}
            first: dict[bytes, tuple[int, int, int]] = {}

            def put(cell, doc, nth, start, string) -> None:
                for column, value in zip(out.values(), (cell, doc, nth, start, string)):
                    column.append(value)

            for row in sorted(batch.to_pylist(), key=lambda r: (r["doc"], r["nth"])):
                text, doc, nth = row["bytes"], row["doc"], row["nth"]
                for s in sorted(row["wanted"], key=lambda s: s["start"]):
                    if s["n_segments"] <= HOT:
                        put(s["gram"], doc, nth, s["start"], text[s["start"] : s["start"] + s["n"] + length - 1])
                        continue
                    for i in range(s["start"], s["start"] + s["n"]):
                        string = text[i : i + length]
                        if first.setdefault(string, (doc, nth, i)) < (doc, nth, i):
                            put(i, doc, nth, i, None)
            for string, (doc, nth, i) in first.items():
                put(xxhash.xxh3_64_intdigest(string) - (1 << 63), doc, nth, i, string)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(out[c], pa.int64()) for c in ("cell", "doc", "nth", "start")), pa.array(out["bytes"], pa.binary())], list(out)
            )

    return cut


def repeated_starts(documents: DataFrame, length: int = 100) -> DataFrame:
    """(doc, nth, start, n): runs of byte offsets at which a string of ``length`` bytes starts that also starts
    earlier: in a smaller doc, in a smaller nth of the same, or earlier in the same text.  ``documents`` has
    doc, nth and bytes; rows of the same doc and nth have the same bytes."""
    if length < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes are compared")
    found = stage(documents.select("doc", "nth", "bytes").mapInArrow(_found(length), _SEGMENT))
    met = stage(
        found.where("gram IS NOT NULL").repartition("gram").sortWithinPartitions("gram", "hash", "doc", "nth", "start")
        .mapInArrow(_meetings(), "kind int, gram long, doc long, nth long, start long, n long, n_segments long")
    )
    wanted = met.where("kind = 0").groupBy("doc", "nth").agg(F.collect_list(F.struct("gram", "start", "n", "n_segments")).alias("wanted"))
    pieces = documents.select("doc", "nth", "bytes").join(wanted, ["doc", "nth"]).mapInArrow(
        _cut(length), "cell long, doc long, nth long, start long, bytes binary"
    )
    compared = stage(
        pieces.repartition("cell").sortWithinPartitions("cell").mapInArrow(_repeats(length), "doc long, nth long, start long, n long")
    )
    copies = found.where("gram IS NULL").select("doc", "nth", "start", "n")
    return copies.unionByName(met.where("kind = 1").select("doc", "nth", "start", "n")).unionByName(compared)


def _covered(length: int):
    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for row in batch.to_pylist():
                text, kept, at, spans, removed = row["bytes"] or b"", [], 0, 0, 0
                for run in sorted((r["start"], r["start"] + r["n"] + length - 1) for r in row["runs"] or []):
                    if run[0] > at or not spans:
                        kept.append(text[at : run[0]])
                        spans += 1
                        removed -= run[0]
                        at = run[1]
                        removed += at
                    elif run[1] > at:
                        removed += run[1] - at
                        at = run[1]
                kept.append(text[at:])
                rest = b"".join(kept)
                for name, value in zip(out, (row["doc"], len(text), removed, spans, hashlib.sha256(rest).hexdigest(), rest)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(out[c], pa.int64()) for c in list(out)[:4]), pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())],
                list(out),
            )

    return covered


def _keyed(documents: DataFrame) -> DataFrame:
    """doc, nth and bytes of every row: doc is for the order, doc and nth name a text.

    nth is 0 but for ids that have different texts, where it is the text's hash, and for null ids, where the
    rows are numbered in the order of their hashes.  Only those numbers could change between runs, and
    they are written.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    named = rows.where("doc IS NOT NULL").withColumn("hash", F.xxhash64("bytes"))
    several = stage(
        named.groupBy("doc").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low <> high")
        .select("doc", F.lit(True).alias("several"))
    )
    named = named.join(several, "doc", "left").select("doc", F.when(F.col("several"), F.col("hash")).otherwise(F.lit(0)).alias("nth"), "bytes")
    # Rows of one text are told apart by their place, so they need not be sorted by one task.
    unnamed = (
        rows.where("doc IS NULL").withColumn("hash", F.xxhash64("bytes")).withColumn("place", F.monotonically_increasing_id())
        .orderBy("hash", "place").select(F.lit(_LAST).alias("doc"), F.monotonically_increasing_id().alias("nth"), "bytes")
    )
    return named.unionByName(stage(unnamed))


def without_repeats(documents: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay) of every row.

    A null text counts as empty; texts of fewer than ``length`` bytes lose nothing.  Documents go by
    doc_id, null ids last.  Rows of one doc_id with different texts are documents each, in the order of
    their texts' hashes, and so are all rows with a null id.  Rows that repeat doc_id and text are one
    document: none is earlier than the other, and all lose the same.  An empty table gives no rows;
    other columns are not read.
    """
    rows = _keyed(documents)
    starts = repeated_starts(rows, length).groupBy("doc", "nth").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    done = rows.join(starts, ["doc", "nth"], "left").mapInArrow(
        _covered(length), "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return done.select(F.expr(f"nullif(doc, {_LAST})").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
