"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage
return; the letters A-Z are lower-cased.  Hashes stand for words and shingles: two of them are equal
by chance with a probability of about 2**-58.
"""

from collections.abc import Iterator

import numpy as np

#: Bytes that are hashed at once; longer texts are cut between words.
BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: 0: white space, 1: letters, digits, underscores and all beyond ASCII, 2: punctuation.
_KIND = np.full(256, 2, dtype=np.uint8)
_KIND[[95, *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[_SPACE] = 0
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BYTES = np.random.default_rng(20240917).integers(0, 2**64, 256, dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 2**64))
_SHINGLE = np.random.default_rng(5).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of the input."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for slot, factor in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(n, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[slot] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def encoded(texts) -> list[bytes]:
    """UTF-8 bytes of each text; nothing for a missing one."""
    return [text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b"" for text in texts]


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """Texts with their place, long ones cut at white space."""
    for place, text in enumerate(texts):
        at = 0
        while len(text) - at > BLOCK:
            cut = at + BLOCK
            while cut < len(text) and not _SPACE[text[cut]]:
                cut += 1
            yield place, text[at:cut]
            at = cut
        yield place, text[at:] if at else text


def _hashed(pieces: list[bytes], marks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many each piece has."""
    joined = np.frombuffer(b" ".join(pieces).translate(_LOWER) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1
    if marks:
        kind = _KIND[joined]
        edges = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
        starts, ends = edges[:-1], edges[1:]
        inner = kind[starts] > 0
        starts, ends = starts[inner], ends[inner]
    else:
        edges = np.flatnonzero(np.diff(~_SPACE[joined], prepend=False))
        starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(max(BLOCK, len(joined)) + 1)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[joined] * power[: len(joined)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0)


def word_hashes(texts: list[bytes], marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one text after the other, and the number of words of each text.

    With ``marks``, runs of punctuation are words of their own.
    """
    found, counts = [], np.zeros(len(texts), dtype=np.int64)
    places: list[int] = []
    block: list[bytes] = []
    held = 0

    def flush() -> None:
        hashes, per_piece = _hashed(block, marks)
        found.append(hashes)
        np.add.at(counts, places, per_piece)

    for place, piece in _pieces(texts):
        if block and held + len(piece) > BLOCK:
            flush()
            places, block, held = [], [], 0
        places.append(place)
        block.append(piece)
        held += len(piece) + 1
    if block:
        flush()
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text after text, and how many each text has.

    A text with fewer words, but at least one, has its whole sequence as the only shingle.
    """
    ends = np.cumsum(counts)
    starts = ends - counts
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    values = np.zeros(len(first), dtype=np.uint64)
    length = np.repeat(np.minimum(counts, size), n)
    for k in range(size):
        part = padded[first + k] * _SHINGLE[k]
        values += np.where(length > k, part, np.uint64(0))
    return mixed(values + length.astype(np.uint64)), n


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    values, n = shingle_hashes(*word_hashes(texts), size)
    return [np.unique(part) for part in np.split(values, np.cumsum(n)[:-1])] if len(texts) else []
