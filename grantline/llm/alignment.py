"""Alignment of the tokens that two tokenizers give for the same text.

The ends of the tokens, in bytes, are the keys of one dictionary per tokenizer, each with the place of its
token.  Ends that both dictionaries hold, in order, cut the text into groups; a group is a slice of both id
lists, and inside it every two tokens that share bytes are linked.

The first tokenizer is a byte-level BPE, the second a SentencePiece model; both read the text behind one
space.  Neither joins two words across a single space between them, so a text is cut there into parts, which
are aligned by themselves (both lists end there) and, where they repeat within a few megabytes of text,
once.  Some thousand parts share their dictionaries, with ends counted on from part to part.  Tokenizers run
inside the tasks; their files are read on the driver and sent along.

How often an id pair is linked in the whole corpus is needed for every link again.  A block of documents
stores its distinct pairs once, with counts; these are summed over the blocks, and each block is sent the
sums of its own pairs.  No link travels by itself, and a pair that is everywhere is one row per block.
"""

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from grantline.sinks.shared import stage

#: Bytes of text of a block of documents, and parts that are given to a tokenizer at once.
BLOCK = 1 << 22
PARTS = 4096
#: Single spaces between two characters that no tokenizer takes for white space.
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])").split

# Fixed value: how the byte-level tokenizer divides a text before it merges.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ASCII and the letters of Latin-1 and Latin Extended-A.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ſ]*").fullmatch


class _Sent:
    """Goes to the executors as its source only; what is built from it is built where it is used."""

    def __init__(self, source):
        self.source = source

    def __getstate__(self):
        return {"source": self.source}

    @cached_property
    def lengths(self) -> np.ndarray:
        """How many bytes each id spells."""
        return np.array([len(spelled) for spelled in self.spelled], np.int64)

    @cached_property
    def digits(self) -> np.ndarray:
        """The decimal digits of each id as bytes, with zeros behind them."""
        written = np.array([str(n).encode() for n in range(len(self.spelled))])
        return written.view(np.uint8).reshape(len(written), -1)


class ByteLevelTokenizer(_Sent):
    """A byte-level BPE in the format of the ``tokenizers`` library; strings of special tokens are plain text."""

    @classmethod
    def read(cls, path: str) -> "ByteLevelTokenizer":
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    @cached_property
    def _model(self):
        import tokenizers

        model = tokenizers.Tokenizer.from_str(self.source)
        model.encode_special_tokens = True
        return model

    @cached_property
    def spelled(self) -> list[bytes]:
        """The bytes of each id.  Printable bytes are written as themselves, the others, in order, from U+0100 on."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [byte for byte in range(256) if byte not in printable]
        byte_of = {chr(byte): byte for byte in printable} | {chr(256 + k): byte for k, byte in enumerate(others)}
        vocabulary = json.loads(self.source)["model"]["vocab"]
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            entries[number] = bytes([byte_of.get(c, 63) for c in entry])
        return entries

    @cached_property
    def _ranked(self):
        """The same vocabulary for a quicker library, where ids are in the order of the merges; else nothing."""
        import tiktoken

        model = json.loads(self.source)["model"]
        merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        if any(model["vocab"].get(entry) != number for number, entry in enumerate(merged, 256)):
            return None
        ranks = {self.spelled[number]: number for number in range(256 + len(merged))}
        if len(ranks) < 256 + len(merged) or any(len(self.spelled[number]) != 1 for number in range(256)):
            return None
        return tiktoken.Encoding("bytes", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, parts: list[str]) -> list[list[int]]:
        """The ids of each part behind a space.

        Parts of plain letters are left to the quicker library; on others the two could differ in what
        they hold for a letter, so these go to the one that the file is made for.
        """
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranked = self._ranked
        found = [ranked(" " + part) if ranked and _PLAIN(part) else None for part in parts]
        rest = [n for n, ids in enumerate(found) if ids is None]
        for n, encoding in zip(rest, self._model.encode_batch_fast([" " + parts[n] for n in rest], add_special_tokens=False)):
            found[n] = encoding.ids
        return found


class PieceTokenizer(_Sent):
    """A SentencePiece model, which writes the space before the text itself."""

    @classmethod
    def read(cls, path: str) -> "PieceTokenizer":
        with open(path, "rb") as file:
            model = cls(file.read())
        if any(b" " in piece.lstrip(b" ") for piece in model.spelled):
            raise ValueError("a piece with a space inside crosses the cuts between parts")
        return model

    @cached_property
    def _model(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.source)

    @cached_property
    def spelled(self) -> list[bytes]:
        model = self._model
        pieces = [model.id_to_piece(n) for n in range(model.get_piece_size())]
        return [
            bytes([int(piece[3:5], 16)]) if model.is_byte(n) else piece.replace("▁", " ").encode()
            for n, piece in enumerate(pieces)
        ]

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self._model.encode(parts)


def group_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each list lie before the ends that both have in common, in order."""
    a_place = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    b_place = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    common = sorted(a_place.keys() & b_place.keys())
    return tuple(np.fromiter(map(place.__getitem__, common), np.int64, len(common)) for place in (a_place, b_place))


def group_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all pairs of tokens that share bytes.

    Inside a group no two ends are equal, so from one end to the next, whichever list it is of, lie the
    bytes that exactly one pair has in common.
    """
    both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = both[np.diff(both, prepend=0) > 0]
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _written(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, digits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` for all groups, and where in it each id starts, groups one after the other."""
    ids = np.zeros(len(a) + len(b), np.int64)
    sign = np.full(len(ids), ord(","), np.uint8)
    b_before = b_cuts - np.diff(b_cuts, prepend=0)
    ids[np.arange(len(a)) + np.repeat(b_before, np.diff(a_cuts, prepend=0))] = a
    ids[np.arange(len(b)) + np.repeat(a_cuts, np.diff(b_cuts, prepend=0))] = b
    sign[a_cuts + b_before - 1] = ord("|")
    sign[a_cuts + b_cuts - 1] = ord(";")
    length = (digits[ids] > 0).sum(axis=1)
    letters = np.concatenate([digits[ids], np.zeros((len(ids), 1), np.uint8)], axis=1)
    letters[np.arange(len(ids)), length] = sign
    return letters[letters > 0].tobytes(), np.cumsum(np.concatenate([[0], length + 1]))


class _Lists:
    """Lists of numbers, one after the other, that are put together again in any order."""

    def __init__(self, flat: list[np.ndarray], sizes: list[np.ndarray]):
        none = np.zeros(0, np.int64)
        self.flat, self.sizes = np.concatenate([none, *flat]), np.concatenate([none, *sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, used: np.ndarray) -> np.ndarray:
        size = self.sizes[used]
        return self.flat[np.repeat(self.starts[used] - np.cumsum(size) + size, size) + np.arange(size.sum())]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


class _Block:
    """The parts of some texts, each aligned once."""

    def __init__(self, texts: list[str | None], first: ByteLevelTokenizer, second: PieceTokenizer):
        split = [_CUT(text) if text else [] for text in texts]
        # Where each part comes for the first time, and then its number among those that do.
        first_places: dict[str, int] = {}
        place = np.fromiter(map(first_places.setdefault, chain.from_iterable(split), count()), np.int64)
        parts = list(first_places)
        number = np.zeros(len(place), np.int64)
        number[np.fromiter(first_places.values(), np.int64, len(parts))] = np.arange(len(parts))
        used = np.split(number[place], np.cumsum([len(one) for one in split])[:-1])
        self.spelled: list[bytes] = []
        right, lists = [np.zeros(0, bool)], [([], []) for _ in range(6)]
        for at in range(0, len(parts), PARTS):
            correct, *aligned = self._aligned(parts[at : at + PARTS], first, second)
            right.append(correct)
            for (flat, sizes), (values, size) in zip(lists, aligned):
                flat.append(values)
                sizes.append(size)
        self.a, self.b, self.a_cuts, self.b_cuts, self.a_links, self.b_links = (_Lists(*one) for one in lists)
        # A text with a part whose bytes are not its tokens' has no tokens at all.
        right = np.concatenate(right)
        self.used = [own if right[own].all() else own[:0] for own in used]

    def _aligned(self, parts: list[str], first: ByteLevelTokenizer, second: PieceTokenizer):
        """Which parts are their tokens' bytes, and, for these, ids, cuts and links of both sides."""
        wholes = [(" " + part).encode("utf-8", "surrogatepass") for part in parts]
        sides = [(model, model.encode(parts)) for model in (first, second)]
        right = np.ones(len(parts), bool)
        for model, lists in sides:
            flat, sizes = _flat(lists)
            ends = np.concatenate([[0], np.cumsum(model.lengths[flat])])[np.cumsum(sizes)]
            if not np.array_equal(ends, np.cumsum([len(whole) for whole in wholes])) or b"".join(
                map(model.spelled.__getitem__, flat.tolist())
            ) != b"".join(wholes):
                right &= [b"".join(map(model.spelled.__getitem__, ids)) == whole for ids, whole in zip(lists, wholes)]
        if not right.all():
            sides = [(model, [ids if ok else [] for ids, ok in zip(lists, right)]) for model, lists in sides]
        (a, a_sizes), (b, b_sizes) = (_flat(lists) for _, lists in sides)
        a_ends, b_ends = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
        a_cuts, b_cuts = group_ends(a_ends, b_ends)
        a_links, b_links = group_links(a_ends, b_ends)
        # Which part each token is of; a group and a link are of the part of their tokens.
        a_part, b_part = (np.repeat(np.arange(len(parts)), sizes) for sizes in (a_sizes, b_sizes))
        a_first, b_first = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
        n_cuts = np.bincount(a_part[a_cuts - 1], minlength=len(parts))
        n_links = np.bincount(a_part[a_links], minlength=len(parts))
        text, places = _written(a, b, a_cuts, b_cuts, first.digits if len(first.digits) > len(second.digits) else second.digits)
        limits = places[np.concatenate([[0], np.cumsum(a_sizes + b_sizes)])].tolist()
        self.spelled += [text[low : high - 1] if high > low else b"" for low, high in zip(limits, limits[1:])]
        return (
            right, (a, a_sizes), (b, b_sizes),
            (a_cuts - a_first[a_part[a_cuts - 1]], n_cuts), (b_cuts - b_first[b_part[b_cuts - 1]], n_cuts),
            (a_links - a_first[a_part[a_links]], n_links), (b_links - b_first[b_part[b_links]], n_links),
        )

    def whole(self, lists: _Lists, tokens: _Lists, used: np.ndarray) -> np.ndarray:
        """Places within parts as places within the text."""
        size = tokens.sizes[used]
        return lists.joined(used) + np.repeat(np.cumsum(size) - size, lists.sizes[used])

    def pairs(self, n_second: int) -> np.ndarray:
        """The id pair of each link of each part, as one number."""
        a = self.a.flat[self.a_links.flat + np.repeat(self.a.starts, self.a_links.sizes)]
        b = self.b.flat[self.b_links.flat + np.repeat(self.b.starts, self.b_links.sizes)]
        return a * n_second + b


def _blocks(batches: Iterator[pa.RecordBatch], text_column: str) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``BLOCK`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        start = held = 0
        for n, size in enumerate(pc.binary_length(batch.column(text_column)).to_pylist()):
            if n > start and held + (size or 0) > BLOCK:
                yield batch.slice(start, n - start)
                start, held = n, 0
            held += size or 0
        if start < len(batch):
            yield batch.slice(start)


def _list_column(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]), kind))


def align(documents: DataFrame, first: ByteLevelTokenizer, second: PieceTokenizer, text_column: str = "text") -> DataFrame:
    """The documents with the ids of both tokenizers, their groups and links.

    ``a_ids`` and ``b_ids`` are the ids; group g has the ids from place ``a_ends[g-1]`` to ``a_ends[g]`` and
    from ``b_ends[g-1]`` to ``b_ends[g]``; link k is between the ids at places ``a_links[k]`` and ``b_links[k]``.
    Null and empty texts, and texts whose bytes are not those of their tokens, have empty lists.  Repeated rows
    and null ids are rows like others, an empty table gives an empty one; all other columns are kept, those
    named like the new ones replaced.  Very long texts are whole, in memory in proportion to their length.
    """
    new = ["a_ids", "b_ids", "a_ends", "b_ends", "a_links", "b_links"]
    kept = [c for c in documents.columns if c not in new]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, text_column):
            block = _Block(rows.column(text_column).to_pylist(), first, second)
            lists = [
                [block.a.joined(used) for used in block.used], [block.b.joined(used) for used in block.used],
                *[
                    [block.whole(part, tokens, used) for used in block.used]
                    for part, tokens in (
                        (block.a_cuts, block.a), (block.b_cuts, block.b), (block.a_links, block.a), (block.b_links, block.b)
                    )
                ],
            ]
            columns = [*(rows.column(c) for c in kept), *(_list_column(one, pa.int32()) for one in lists)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    fields = ", ".join(f"{c} array<int>" for c in new)
    empty = documents.sparkSession.createDataFrame([], fields).schema
    schema = documents.select(*kept).schema
    for field in empty:
        schema = schema.add(field)
    return documents.select(*kept).mapInArrow(aligned, schema)


_COUNTED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _counted(documents: DataFrame, first: ByteLevelTokenizer, second: PieceTokenizer) -> DataFrame:
    """doc_id, counts and hash of each document with its block and parts; a block's last row has its links.

    ``parts`` numbers the parts of the block; ``part_links`` has the links of all parts, ``part_sizes`` of
    them each, as places in ``pairs``, which are linked ``counts`` times in the block.
    """
    n_second = len(second.spelled)
    lists = "parts array<int>, part_links array<int>, part_sizes array<int>, pairs array<long>, counts array<long>"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in _blocks(batches, "text"):
            block = _Block(rows.column("text").to_pylist(), first, second)
            pairs, places = np.unique(block.pairs(n_second), return_inverse=True)
            size = block.a_links.sizes
            uses = np.bincount(np.concatenate([np.zeros(0, np.int64), *block.used]), minlength=len(size))
            counts = np.bincount(places, weights=np.repeat(uses, size), minlength=len(pairs)).astype(np.int64)
            sums = [
                [int(one.sizes[used].sum()) for used in block.used] for one in (block.a, block.b, block.a_cuts, block.a_links)
            ]
            hashes = [
                hashlib.sha256(b";".join(map(block.spelled.__getitem__, used.tolist()))).hexdigest() if len(used) else ""
                for used in block.used
            ]

            def last(values: np.ndarray, kind: pa.DataType) -> pa.Array:
                return pa.array([None] * (len(rows) - 1) + [values], pa.list_(kind))

            columns = [
                rows.column("doc_id"), *(pa.array(one, pa.int64()) for one in sums), pa.array(hashes, pa.string()),
                pa.array(np.full(len(rows), number), pa.int64()), _list_column(block.used, pa.int32()),
                last(places, pa.int32()), last(size, pa.int32()), last(pairs, pa.int64()), last(counts, pa.int64()),
            ]
            names = [c.split()[0] for c in f"doc_id x, {_COUNTED}, block x, {lists}".split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)
            number += 1

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {_COUNTED}, block long, {lists}"
    return documents.select("doc_id", "text").mapInArrow(counted, schema)


def _pair_totals(blocks: DataFrame, n_second: int) -> DataFrame:
    """(pair, n, best): how often each pair is linked, and whether no pair with its second id is more often."""
    own = blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = stage(own.where("p.counts > 0").groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")))
    of_second = totals.withColumn("second", F.col("pair") % n_second)
    # At most as many rows as the second vocabulary has ids.
    most = of_second.groupBy("second").agg(F.max("n").alias("most"))
    return of_second.join(F.broadcast(most), "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_counts(documents: DataFrame, first: ByteLevelTokenizer, second: PieceTokenizer) -> DataFrame:
    """(a_id, b_id, n, best): the links of the whole corpus, and which are the most frequent ones of their b_id."""
    n_second = len(second.spelled)
    totals = _pair_totals(stage(_counted(documents, first, second)), n_second)
    return totals.select(
        F.expr(f"pair div {n_second}").alias("a_id"), (F.col("pair") % n_second).alias("b_id"), "n", "best"
    )


def alignment_digests(documents: DataFrame, first: ByteLevelTokenizer, second: PieceTokenizer) -> DataFrame:
    """Counts of tokens, groups and links of each document, and how usual its links are in the corpus.

    ``n_best`` counts links whose pair is, in the corpus, among the most frequent of its second id,
    ``count_sum`` sums how often each link's pair is linked.  ``groups_sha256`` hashes the groups' ids,
    ``a1,a2|b1;a3|b2,b3``.  Documents without tokens (see ``align``) have zeros and an empty string.  There is a row
    for every input row: repeated rows count each, null ids are like others.  Only doc_id and text are read.
    """
    blocks = stage(_counted(documents, first, second))
    answers = (
        blocks.where("pairs IS NOT NULL").select(F.col("block").alias("asked"), F.posexplode("pairs").alias("place", "pair"))
        .join(_pair_totals(blocks, len(second.spelled)), "pair").select("asked", "place", "n", "best")
    )
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def summed(rows: pa.Table, answered: pa.Table) -> pa.Table:
        rows, answered = rows.combine_chunks(), answered.combine_chunks()
        links = rows.filter(pc.is_valid(rows.column("part_sizes")))
        places = links.column("part_links")[0].values.to_numpy(zero_copy_only=False)
        sizes = links.column("part_sizes")[0].values.to_numpy(zero_copy_only=False)
        ends = np.cumsum([0, *sizes])
        parts = rows.column("parts").chunk(0)
        used, bounds = parts.values.to_numpy(zero_copy_only=False), parts.offsets.to_numpy()
        columns = []
        for name in ("best", "n"):
            values = np.zeros(int(places.max(initial=-1)) + 1, np.int64)
            values[answered.column("place").to_numpy()] = answered.column(name).to_numpy().astype(np.int64)
            # A place without an answer is linked in no document that has tokens.
            of_part = np.diff(np.concatenate([[0], np.cumsum(values[places])])[ends])
            columns.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(of_part[used])])[bounds]), pa.int64()))
        return pa.table([*(rows.column(c) for c in names), *columns], [*names, "n_best", "count_sum"])

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {_COUNTED}, n_best long, count_sum long"
    held = blocks.select(*names, "block", "parts", "part_links", "part_sizes")
    return held.groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(summed, schema)
