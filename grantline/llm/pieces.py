"""Encoding of text into the pieces of a given vocabulary, and back.

Text is segmented by the Viterbi algorithm: of all segmentations into pieces, the one with the highest
sum of log scores (on ties, the longer last piece).  Pieces are found with a double-array trie.  A
character that is no piece is spelled in byte pieces, at a score below that of any piece.

A space is written as a marker and a marker goes before the text; decoding turns markers into spaces and
drops the first.  Inside this module the marker is the byte 0xFF, which no text contains, so a literal
U+2581 is spelled in bytes and comes back as itself: every text round-trips.
"""

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MARKER = "▁"
_MARK = b"\xff"
#: Bytes of text whose words are segmented together; longer texts are cut where a segment begins.
CHUNK = 1 << 19
#: A piece has markers only at its start, so segments begin where runs of markers do.
_SEGMENTS = re.compile(rb"\xff+[^\xff]*|[^\xff]+").finditer


class DoubleArray:
    """A trie in two arrays: from state s, byte c leads to t = base[s] + c if check[t] == s."""

    def __init__(self, entries: dict[bytes, int]):
        tree: dict = {}
        for word, number in entries.items():
            node = tree
            for byte in word:
                node = node.setdefault(byte, {})
            node[-1] = number
        # All states fit below: each is placed at most a few slots after the last full region.
        base, check, value = [0] * 512, [-1] * 512, [-1] * 512
        check[0] = 0
        free, queue = 1, [(0, tree)]
        for state, node in queue:
            value[state] = node.get(-1, -1)
            codes = sorted(c for c in node if c >= 0)
            if not codes:
                continue
            while check[free] >= 0:
                free += 1
            first = start = max(1, free - codes[0])
            while any(check[start + c] >= 0 for c in codes):
                start += 1
                if start + 512 > len(check):
                    for array, empty in ((base, 0), (check, -1), (value, -1)):
                        array.extend([empty] * len(array))
            if start - first > 64:
                free = start  # leave crowded regions behind
            base[state] = start
            for c in codes:
                check[start + c] = state
                queue.append((start + c, node[c]))
            if start + 1024 > len(check):
                for array, empty in ((base, 0), (check, -1), (value, -1)):
                    array.extend([empty] * len(array))
        self.base, self.check, self.value = (np.array(array, np.int32) for array in (base, check, value))
        self.longest = max(map(len, entries), default=0)


class Vocabulary:
    """Pieces with log scores.  With ``ranks``, scores are minus the place of a piece in a list ordered
    by frequency, and the log score is that of Zipf's law, -log(place + 1), up to a constant."""

    def __init__(self, pieces: list[tuple[str, float, str]], ranks: bool):
        self.spelled = [b""] * len(pieces)
        self.byte_ids = np.full(256, -1, np.int32)
        entries: dict[bytes, int] = {}
        self.scores = np.zeros(len(pieces))
        for number, (piece, score, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = number
                self.spelled[number] = bytes([int(piece[3:5], 16)])
            elif kind == "piece" and piece:
                word = piece.encode().replace(MARKER.encode(), _MARK)
                if _MARK in word.lstrip(_MARK):
                    raise ValueError(f"a marker inside the piece {piece!r}")
                entries[word] = number
                self.spelled[number] = word
                self.scores[number] = -math.log(1 - score) if ranks else score
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        self.trie = DoubleArray(entries)
        self.unknown = float(self.scores.min()) - 10.0
        lead = np.ones(256, np.int32)
        lead[0xC0:0xE0], lead[0xE0:0xF0], lead[0xF0:0xF8] = 2, 3, 4
        self.char_length = lead

    def _edges(self, text: np.ndarray, end_of: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, end, piece) of every piece in the words; -1 for characters that are none."""
        trie = self.trie
        is_start = (text & 0xC0) != 0x80
        starts = np.flatnonzero(is_start).astype(np.int32)
        char_end = np.minimum(starts + self.char_length[text[starts]], end_of[starts])
        known = np.zeros(len(text), bool)
        found = []
        at, begin, state, own_end = starts, starts, np.zeros(len(starts), np.int32), char_end
        while len(at):
            target = trie.base[state] + text[at]
            ok = (trie.check[target] == state) & (target != 0)
            begin, at, state, own_end = begin[ok], at[ok] + 1, target[ok], own_end[ok]
            value = trie.value[state]
            ends = value >= 0
            found.append((begin[ends], at[ends], value[ends]))
            known[begin[ends & (at == own_end)]] = True
            more = at < end_of[begin]
            begin, at, state, own_end = begin[more], at[more], state[more], own_end[more]
        lost = ~known[starts]
        found.append((starts[lost], char_end[lost], np.full(int(lost.sum()), -1, np.int32)))
        return tuple(np.concatenate(part) for part in zip(*found))

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the words, one after the other, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int32, count=len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        begin, end, piece = self._edges(text, (starts + lengths)[word_of])
        # Positions between bytes: each word has one more of them than bytes.
        word = word_of[begin]
        order = np.argsort(begin - starts[word], kind="stable")
        begin, end, piece, word = begin[order], end[order], piece[order], word[order]
        score = np.where(piece >= 0, self.scores[piece], self.unknown)
        steps = np.searchsorted(begin - starts[word], np.arange(int(lengths.max(initial=0)) + 1))
        best = np.full(len(text) + len(words), -np.inf)
        best[starts + np.arange(len(words))] = 0.0
        via = np.full(len(best), -1, np.int32)
        source, sink = begin + word, end + word
        for low, high in zip(steps, [*steps[1:], len(begin)]):
            if low == high:
                continue
            total = best[source[low:high]] + score[low:high]
            better = total > best[sink[low:high]]
            hit = sink[low:high][better]
            best[hit] = total[better]
            via[hit] = np.flatnonzero(better) + low
        chosen, owners = [], []
        own = np.flatnonzero(lengths > 0)
        at = (starts + lengths + np.arange(len(words)))[own]
        while len(at):
            edge = via[at]
            chosen.append(edge)
            owners.append(own)
            at = source[edge]
            more = at > (starts + np.arange(len(words)))[own]
            at, own = at[more], own[more]
        edges = np.concatenate([np.zeros(0, np.int64), *chosen[::-1]])
        owner = np.concatenate([np.zeros(0, np.int64), *owners[::-1]])
        edges = edges[np.argsort(owner, kind="stable")]
        owner = np.sort(owner, kind="stable")
        size = np.where(piece[edges] >= 0, 1, end[edges] - begin[edges])
        first = np.cumsum(size) - size
        spread = np.repeat(np.arange(len(edges)), size)
        inner = np.arange(len(spread)) - first[spread]
        ids = np.where(
            piece[edges][spread] >= 0,
            piece[edges][spread],
            self.byte_ids[text[np.minimum(begin[edges][spread] + inner, max(0, len(text) - 1))]] if len(text) else 0,
        ).astype(np.int32)
        return ids, np.bincount(owner, weights=size, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the texts, one after the other, and how many each text has.

        Segments are independent of each other, so they are taken ``CHUNK`` bytes at a time, across and
        within texts.  In a chunk, a segment that repeats is worked out once.
        """
        counts = np.zeros(len(texts), np.int64)
        found: list[np.ndarray] = []
        places: dict[bytes, int] = {}
        used: list[int] = []
        owners: list[tuple[int, int]] = []

        def flush() -> None:
            ids, lengths = self.segment(list(places))
            first, order = np.cumsum(lengths) - lengths, np.array(used, np.int64)
            size = lengths[order]
            total = np.concatenate([[0], np.cumsum(size)])
            found.append(ids[np.repeat(first[order] - total[:-1], size) + np.arange(total[-1])])
            bounds = np.cumsum([0] + [k for _, k in owners])
            np.add.at(counts, [n for n, _ in owners], np.diff(total[bounds]))
            places.clear()
            used.clear()
            owners.clear()

        held = 0
        for n, text in enumerate(texts):
            if not text:
                continue
            before = len(used)
            for match in _SEGMENTS((" " + text).encode("utf-8", "surrogatepass").replace(b" ", _MARK)):
                part = match.group()
                used.append(places.setdefault(part, len(places)))
                held += len(part)
                if held >= CHUNK:
                    owners.append((n, len(used) - before))
                    flush()
                    before = held = 0
            owners.append((n, len(used) - before))
        flush()
        return np.concatenate(found), counts

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.spelled.__getitem__, ids.tolist()))
        return joined.replace(_MARK, b" ")[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=4)
def load_vocabulary(path: str, ranks: bool) -> Vocabulary:
    """The pieces of a SentencePiece model file, read on the driver; a vocabulary is of bounded size."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(n: int) -> str:
        if model.is_byte(n):
            return "byte"
        return "other" if model.is_unknown(n) or model.is_control(n) or model.is_unused(n) else "piece"

    return Vocabulary(
        [(model.id_to_piece(n), model.get_score(n), kind(n)) for n in range(model.get_piece_size())], ranks
    )


def _batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for n, length in enumerate(pc.binary_length(texts).to_pylist()):
        held += length or 0
        if held >= CHUNK:
            yield start, n + 1
            start, held = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(documents: DataFrame, vocabulary: Vocabulary, text_column: str = "text", out: str = "token_ids") -> DataFrame:
    """The documents with a column of piece ids in place of their text.

    A null or empty text has no pieces.  All other columns are kept as they are; one named like the new
    column is replaced.  Repeated rows are encoded each; of segmentations with equal scores the one with the
    longer last piece is taken; an empty table gives an empty one.  Very long texts are cut between segments,
    which changes no result, so that the work arrays stay small; only the ids of a text are held whole.
    """
    kept = [c for c in documents.columns if c not in (text_column, out)]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in _batches(batch.column(text_column)):
                rows = batch.slice(start, end - start)
                ids, counts = vocabulary.encode(rows.column(text_column).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                column = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), column], [*kept, out])

    schema = StructType([documents.schema[c] for c in kept] + [StructField(out, ArrayType(IntegerType()))])
    return documents.select(*kept, text_column).mapInArrow(encoded, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_column: str = "token_ids", out: str = "text") -> DataFrame:
    """The rows with the text of their piece ids as a further column; null ids give an empty text."""
    kept = [c for c in rows.columns if c != out]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A batch's texts are made some at a time, as they are larger than the ids' bytes suggest.
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                lists = part.column(ids_column)
                values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                texts = [vocabulary.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, out]
                )

    schema = StructType([rows.schema[c] for c in kept] + [StructField(out, StringType())])
    return rows.select(*kept).mapInArrow(decoded, schema)
