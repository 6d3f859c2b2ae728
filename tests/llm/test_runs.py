"""Periodic runs against a comparison of all words at all distances."""

import hashlib
import random
import re
import zlib

import numpy as np

from grantline.llm.runs import PRIME, collapsed, periodic_runs, run_digest, text_runs, transform

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    numbers = {}
    x = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = {}
    for q in range(1, len(x) // 2 + 1):
        equal = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, stop in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if stop - start + q >= max(12, 2 * q):
                found.setdefault((start, stop - start + q), q)
    return sorted((start, length, q) for (start, length), q in found.items())


def brute_kept(words, runs):
    dropped = {k for start, length, q in runs for k in range(start + q, start + length)}
    return [w for k, w in enumerate(words) if k not in dropped]


def repetitive(rng):
    words = []
    while len(words) < rng.randint(0, 400):
        if rng.random() < 0.5:
            words += rng.choices("abcdefghij"[: rng.randint(1, 10)], k=rng.randint(1, 30))
        else:
            part = rng.choices("abcxyz"[: rng.randint(1, 6)], k=rng.randint(1, 40))
            words += (part * 5)[: rng.randint(1, 5 * len(part))]
    return words


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (8, 16, 64):
        a, b = (rng.integers(0, PRIME, (3, size), dtype=np.uint64) for _ in range(2))
        product = transform(transform(a) * transform(b) % np.uint64(PRIME), inverse=True)
        for row in range(3):
            for k in range(size):
                assert int(product[row, k]) == sum(int(a[row, i]) * int(b[row, (k - i) % size]) for i in range(size)) % PRIME


def test_runs_equal_brute_force():
    rng = random.Random(5)
    texts = [repetitive(rng) for _ in range(300)]
    texts += [["a"] * n for n in (11, 12, 13, 500)] + [["a", "b"] * 6, list("abcabcabcab"), list("abcdef" * 2), list("abcdefg") * 2]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts += [list(fibonacci[-1]), [f"w{k % 333}" for k in range(1500)], [f"w{k}" for k in range(100)]]
    together = list(text_runs([" ".join(words).encode() for words in texts]))
    n_runs = 0
    for words, (split, runs) in zip(texts, together):
        expected = brute_runs(words)
        assert runs == expected, words
        assert list(text_runs([" ".join(words).encode()]))[0][1] == expected
        assert collapsed(split, runs).decode().split() == brute_kept(words, expected)
        n_runs += len(runs)
    assert n_runs > 500


def test_long_texts():
    assert [runs for _, runs in text_runs([b"a " * 200_000])] == [[(0, 200_000, 1)]]
    half = " ".join(f"w{k * k % 9973}x{k}" for k in range(30_000))
    assert [runs for _, runs in text_runs([f"{half} {half}".encode(), b""])] == [[(0, 60_000, 30_000)], []]


def test_operator(spark):
    text = "x " + "a b c " * 5 + "\n\té y"
    table = [(1, text, 5), (1, text, 5), (2, None, 5), (3, "", 5), (None, "q " * 12, 5), (4, "a b", 5)]
    frame = spark.createDataFrame(table, "doc_id long, text string, runs int")
    found = {r.doc_id: r for r in periodic_runs(frame).collect()}
    assert periodic_runs(frame).columns == ["doc_id", "runs", "collapsed"] and len(found) == 5
    assert [tuple(r) for r in found[1].runs] == [(1, 15, 3)] and found[1].collapsed == "x a b c é y"
    assert [tuple(r) for r in found[None].runs] == [(0, 12, 1)] and found[None].collapsed == "q"
    assert (found[2].runs, found[2].collapsed, found[3].collapsed, found[4].collapsed) == ([], "", "", "a b")
    assert periodic_runs(frame).count() == 6 and periodic_runs(frame.limit(0)).count() == 0


def test_registered_query_equals_brute_force(spark):
    from grantline.llm.queries import QUERIES

    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    some = 0
    for row in QUERIES["op12_periodic_runs"](spark, small).collect():
        words = WORDS.findall(texts[row.doc_id])
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(brute_kept(words, runs)).encode()).hexdigest()
        some += len(runs)
    assert some > 10
