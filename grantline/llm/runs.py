"""Periodic runs of words, by block convolution.

A run of period q that is at least twice as long as q holds a block of consecutive words, at a place that
is a multiple of its size b, whose copy q words further is in the run as well; b is the power of two with
2b - 1 <= q <= 4b - 2 (and 2 for all periods up to 6, as runs of 12 words leave six places).  So at every
dyadic scale b, each block is compared with all places of the window that follows: the sum of squared
differences at every distance comes from one convolution, done exactly by a number-theoretic transform.
Distances without a mismatch are seeds, and each seed is extended word by word to the run that it lies in.

Sums are known modulo a prime; a sum that is a multiple of it without being nil is found out by the
extension, which compares words.  Words are numbered by their first place, so equal numbers are equal words.

Many short texts are taken together, with a number of its own between any two of them, which no run can
cross.  A block is not transformed if one of its words does not come again in the block's window (then no
copy exists), nor if the window lies within a known run of a period up to b (then copies are at multiples of
that period only, and belong to that run).
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: A run has so many words at least, and twice its period.
LEAST = 12
#: The modulus of the transform: 15 * 2**27 + 1, with the primitive root 31.
PRIME = 2013265921
_ROOT = 31
#: Bytes of text that are searched together, and numbers that are transformed together.
CHUNK = 1 << 20
CELLS = 1 << 18


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of the order ``size``."""
    root = pow(_ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(max(1, size // 2), np.uint64)
    filled = 1
    while filled < len(powers):
        step = np.uint64(pow(root, filled, PRIME))
        powers[filled : 2 * filled] = powers[:filled] * step % np.uint64(PRIME)
        filled *= 2
    return powers


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row; row lengths are a power of two, numbers below the prime."""
    size = rows.shape[1]
    prime, roots = np.uint64(PRIME), _roots(size, inverse)
    x = rows.reshape(len(rows), size, 1)
    n, s = size, 1
    while n > 1:
        low, high = x[:, : n // 2], x[:, n // 2 :]
        factor = roots[:: size // n][: n // 2, None]
        x = np.stack([(low + high) % prime, (low + prime - high) * factor % prime], axis=2)
        n, s = n // 2, s * 2
        x = x.reshape(len(rows), n, s)
    x = x.reshape(len(rows), size)
    return x * np.uint64(pow(size, -1, PRIME)) % prime if inverse else x


def _seeds(x: np.ndarray, blocks: np.ndarray, b: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the blocks' copies at distances from ``first`` to ``last``; ``x`` is padded."""
    places, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size, width = 4 * b, b + last - first
    prime = np.uint64(PRIME)
    for part in np.array_split(blocks, max(1, -(-len(blocks) * size // CELLS))):
        pattern = np.zeros((len(part), size), np.uint64)
        window = np.zeros((len(part), size), np.uint64)
        pattern[:, :b] = x[part[:, None] + np.arange(b)][:, ::-1]
        window[:, :width] = x[part[:, None] + first + np.arange(width)]
        # At place b - 1 + d of the convolution is the product of the block and the window's words from d on.
        products = transform(transform(pattern) * transform(window) % prime, inverse=True)
        products = products[:, b - 1 : b + last - first]
        own = (pattern * pattern % prime).sum(axis=1) % prime
        sums = np.zeros((len(part), width + 1), np.uint64)
        np.cumsum(window[:, :width] * window[:, :width] % prime, axis=1, out=sums[:, 1:])
        theirs = (sums[:, b:] - sums[:, : width - b + 1]) % prime
        differences = (own[:, None] + theirs + 2 * (prime - products)) % prime
        block, distance = np.nonzero(differences == 0)
        places.append(part[block])
        distances.append(distance + first)
    return np.concatenate(places), np.concatenate(distances)


def _candidates(x: np.ndarray, order: np.ndarray, keys: np.ndarray, end: np.ndarray, length: np.ndarray,
                runs: list[tuple[int, int, int]], b: int, first: int, last: int) -> np.ndarray:
    """The places of the blocks that may have a copy in their window."""
    n = len(x)
    at = order[length[order] >= max(LEAST, 2 * first)]
    next_one = np.searchsorted(keys, x[at] * np.int64(n) + np.minimum(at + first, n - 1))
    found = next_one < len(order)
    found[found] = x[order[next_one[found]]] == x[at[found]]
    again = order[np.minimum(next_one, len(order) - 1)]
    found &= (again >= at + first) & (again <= at + last) & (again < end[at])
    recurs = np.zeros(n + b, bool)
    recurs[at[found]] = True
    blocks = np.flatnonzero(recurs[: n // b * b].reshape(-1, b).all(axis=1)) * b
    hidden = np.zeros(len(blocks), bool)
    for start, stop, period in runs:
        if period <= b and stop - start >= b + last:
            hidden[np.searchsorted(blocks, start) : np.searchsorted(blocks, stop - b - last, "right")] = True
    return blocks[~hidden]


def _extended(x: np.ndarray, place: int, b: int, q: int) -> tuple[int, int] | None:
    """The longest stretch with period q around a block and its copy q words on; nothing if they differ."""
    if not np.array_equal(x[place : place + b], x[place + q : place + q + b]):
        return None
    stop, step = place + b, 64
    limit = len(x) - q
    while stop < limit:
        reach = min(limit, stop + step)
        wrong = np.flatnonzero(x[stop:reach] != x[stop + q : reach + q])
        if len(wrong):
            stop += int(wrong[0])
            break
        stop, step = reach, step * 2
    start, step = place, 64
    while start > 0:
        reach = max(0, start - step)
        wrong = np.flatnonzero(x[reach:start] != x[reach + q : start + q])
        if len(wrong):
            start = reach + int(wrong[-1]) + 1
            break
        start, step = reach, step * 2
    return start, stop + q


def find_runs(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in some texts, each a stretch of the numbered words ``x``.

    Numbers are below the length of ``x``.  Between two texts stands a number that occurs once.
    """
    n = len(x)
    lengths = ends - starts
    longest = int(lengths.max(initial=0))
    if longest < LEAST:
        return []
    end, length = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for start, stop in zip(starts.tolist(), ends.tolist()):
        end[start:stop] = stop
        length[start:stop] = stop - start
    order = np.argsort(x, kind="stable")
    order = order[length[order] >= LEAST]
    keys = x[order] * np.int64(n) + order
    found: dict[tuple[int, int], int] = {}
    b = 2
    while 2 * b - 1 <= longest // 2 or b == 2:
        first, last = (1, 6) if b == 2 else (2 * b - 1, 4 * b - 2)
        runs = [(start, stop, q) for (start, stop), q in found.items()]
        blocks = _candidates(x, order, keys, end, length, runs, b, first, last)
        if len(blocks):
            # Beyond the end stands a number that no word has.
            padded = np.concatenate([x, np.full(b + last, n, np.int64)])
            places, distances = _seeds(padded.astype(np.uint64), blocks, b, first, last)
            by_place = np.argsort(places, kind="stable")
            places, distances = places[by_place], distances[by_place]
            known = np.zeros(len(places), bool)
            for start, stop, q in runs:
                if stop - start >= b + first:
                    part = slice(*np.searchsorted(places, [start, stop]))
                    known[part] |= (distances[part] % q == 0) & (places[part] + b + distances[part] <= stop)
            places, distances = places[~known], distances[~known]
            covered, distance = 0, 0
            for k in np.lexsort((places, distances)).tolist():
                place, q = int(places[k]), int(distances[k])
                if q == distance and place + b + q <= covered:
                    continue
                stretch = _extended(x, place, b, q)
                if stretch is None:
                    continue
                distance, covered = q, stretch[1]
                # A stretch that is known already has the smaller period that it was found with.
                if stretch[1] - stretch[0] >= max(LEAST, 2 * q):
                    found.setdefault(stretch, q)
        b *= 2
    return sorted((start, stop, q) for (start, stop), q in found.items())


def text_runs(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text, and its runs as (start, length, period) in words."""
    split = [text.split() for text in texts]  # bytes are split at space, tab, \n, \v, \f and \r
    lengths = np.array([len(words) for words in split], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    x = np.arange(int((lengths + 1).sum()), dtype=np.int64)
    numbers: dict[bytes, int] = {}
    for start, words in zip(starts.tolist(), split):
        if len(words) >= LEAST:
            x[start : start + len(words)] = np.fromiter(map(numbers.setdefault, words, count(start)), np.int64, len(words))
    runs = find_runs(x, starts, starts + lengths)
    own = np.searchsorted(starts, [start for start, _, _ in runs], "right") - 1
    per_text: dict[int, list[tuple[int, int, int]]] = {}
    for text, (start, stop, period) in zip(own.tolist(), runs):
        per_text.setdefault(text, []).append((start - int(starts[text]), stop - start, period))
    for n, words in enumerate(split):
        yield words, per_text.get(n, [])


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that some run contains after its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


RUNS = ArrayType(StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")]), containsNull=False)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start = held = 0
    for n, size in enumerate(pc.binary_length(texts).to_pylist()):
        held += size or 0
        if held >= CHUNK:
            yield start, n + 1
            start, held = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


def periodic_runs(documents: DataFrame, text_column: str = "text", with_collapsed: bool = True) -> DataFrame:
    """The documents' other columns with ``runs``, and the text without the runs' repeats as ``collapsed``.

    ``runs`` is an array of (start, length, period), in words, by start and period: all stretches of
    at least max(12, 2 * period) words with that smallest period, which no neighbouring word extends.
    ``collapsed`` has the other words and each run's first period, joined by one space; ``with_collapsed=False`` gives
    its SHA-256 alone, as ``collapsed_sha256``.  Null, empty and short texts have no runs; rows with null
    ids and repeated rows are searched each; an empty table gives an empty one.  Equal periods and overlapping runs are all
    kept.  Texts are searched whole, alone when they are long.  Columns named like the new ones are replaced.
    It is a map over rows: nothing is shuffled.
    """
    last = "collapsed" if with_collapsed else "collapsed_sha256"
    kept = [c for c in documents.columns if c not in (text_column, "runs", last)]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in _chunks(batch.column(text_column)):
                rows = batch.slice(start, stop - start)
                texts = [text.encode() if text else b"" for text in rows.column(text_column).to_pylist()]
                offsets, flat, rest = [0], [], []
                for words, runs in text_runs(texts):
                    flat += runs
                    offsets.append(len(flat))
                    left = collapsed(words, runs)
                    rest.append(left.decode() if with_collapsed else hashlib.sha256(left).hexdigest())
                fields = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
                runs = pa.StructArray.from_arrays(
                    fields, fields=[pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]
                )
                columns = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), pa.array(rest, pa.string())]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *columns], [*kept, "runs", last])

    schema = StructType([documents.schema[c] for c in kept] + [StructField("runs", RUNS), StructField(last, StringType())])
    return documents.select(*kept, text_column).mapInArrow(searched, schema)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts repeats a stretch of its words up to its end.

    With h the CRC-32 of the decimal doc_id and g = h // 10: if h is a multiple of ten, each word from place
    a = g % n on becomes the word a + (i - a) % p, with p = 1 + (n - a) // (3 + g % 8).  A null id plants nothing.
    """
    chosen = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("words")
    planted = F.expr(
        "array_join(transform(words, (w, i) -> IF(i < a, w, element_at(words, a + (i - a) % p + 1))), ' ')"
    )
    return (
        chosen.withColumn("words", F.when(F.col("h") % 10 == 0, words))
        .withColumn("g", F.floor(F.col("h") / 10))
        .withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
        .withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
        .select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))
    )


def run_digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and hashes of the runs of each document."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))

    def line_ends(column: Column) -> Column:
        return F.concat(F.array_join(column, "\n"), F.when(F.size(column) > 0, "\n").otherwise(""))

    best = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))
    )
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), (-F.col("best.length")).alias("length"), F.col("best.period").alias("period"),
        F.expr("-1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line_ends(lines), 256).alias("runs_sha256"), "collapsed_sha256",
    )
