"""Alignments against a comparison of all tokens of the two libraries' own output."""

import collections
import hashlib
import json
import random

import pytest

from grantline.llm import alignment
from grantline.llm.alignment import ByteLevelTokenizer, PieceTokenizer, align, alignment_digests, link_counts
from grantline.llm.queries import BYTE_MODEL, PIECE_MODEL, QUERIES


@pytest.fixture(scope="module")
def models():
    return ByteLevelTokenizer.read(BYTE_MODEL), PieceTokenizer.read(PIECE_MODEL)


@pytest.fixture(scope="module")
def tokens():
    """(id, start, end) of each token in bytes, by the libraries, on whole texts."""
    import sentencepiece
    import tokenizers

    first = tokenizers.Tokenizer.from_file(BYTE_MODEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    decode = tokenizers.decoders.ByteLevel()
    entries = {n: entry for entry, n in json.load(open(BYTE_MODEL))["model"]["vocab"].items()}
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table = {}
    for byte in range(256):
        table[chr(byte) if byte in shown else chr(256 + sum(b not in shown for b in range(byte)))] = byte
    assert decode.decode([entries[100]])

    def found(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        a = [(n, bytes(table[c] for c in entries[n])) for n in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for n in second.encode(text):
            piece = second.id_to_piece(n)
            b.append((n, bytes([int(piece[3:5], 16)]) if second.is_byte(n) else piece.replace("▁", " ").encode()))
        if b"".join(s for _, s in a) != whole or b"".join(s for _, s in b) != whole:
            return [], []
        out = []
        for side in (a, b):
            at, placed = 0, []
            for n, spelled in side:
                placed.append((n, at, at + len(spelled)))
                at += len(spelled)
            out.append(placed)
        return tuple(out)

    return found


def brute(texts, tokens):
    both = [tokens(text) for text in texts]
    links = [
        [(i, j) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if s < f and t < e] if len(a) < 3000
        else None for a, b in both
    ]
    counts = collections.Counter((a[i][0], b[j][0]) for (a, b), some in zip(both, links) for i, j in some)
    most = collections.Counter()
    for (_, n), c in counts.items():
        most[n] = max(most[n], c)
    rows = []
    for (a, b), some in zip(both, links):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for low, high in zip([0] + ends, ends):
            groups.append("|".join(",".join(str(n) for n, s, e in side if low <= s and e <= high) for side in (a, b)))
        ids = [(a[i][0], b[j][0]) for i, j in some]
        rows.append((
            len(a), len(b), len(groups), len(some), sum(counts[p] == most[p[1]] for p in ids), sum(counts[p] for p in ids),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        ))
    return rows, counts, links


ODD = [
    None, "", " ", "  two  spaces ", "a", "<|endoftext|> <s> </s> <unk> <0x0A>", "tab\tand\nline\r\n", "a▁b", "▁", "\x00 zero",
    "naïve café – 東京 😀👍🏽 ½ ²x", "don't we'll I'M 'tis", "x " * 50, "the end " * 30, "word" * 40, "é" * 30, "​ 　x", "٣٤ १२ Ⅻ",
    "a  b   c", "end ", "12 345 6789 a1 b2", "Same text here", "Same text here", "ﬁ ﬂ ǅ x́ y",
]


def texts():
    rng = random.Random(11)
    out = ODD + ["".join(rng.choices("abc  ée東 😀'1\n\t.½▁", k=rng.randint(1, 60))) for _ in range(150)]
    out += ["".join(rng.choices("tshe eing  éüßſ'12\n\t\r.,-", k=rng.randint(1, 60))) for _ in range(150)]
    return out + [" ".join("".join(rng.choices("etaoinsr", k=rng.randint(1, 9))) for _ in range(60)) for _ in range(20)]


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_digests_equal_brute_force(spark, models, tokens, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    table = list(enumerate(texts())) + [(None, "no id here")]
    expected, _, _ = brute([text for _, text in table], tokens)
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in table], "doc_id long, text string, block long, n_a long").repartition(3)
    found = alignment_digests(frame, *models)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {r.doc_id: tuple(r[c] for c in names) for r in found.collect()}
    assert rows == dict(zip([d for d, _ in table], expected))
    assert sum(r[0] == 0 for r in expected) >= 4 and sum(r[5] for r in expected) > 10_000


def test_lists_and_counts_equal_brute_force(spark, models, tokens):
    table = list(enumerate(texts()))
    _, counts, links = brute([text for _, text in table], tokens)
    frame = spark.createDataFrame([(d, t, "x") for d, t in table], "doc_id long, text string, b_ends string")
    found = align(frame, *models)
    assert found.columns == ["doc_id", "text", "a_ids", "b_ids", "a_ends", "b_ends", "a_links", "b_links"]
    for row in found.collect():
        a, b = tokens(row.text)
        assert row.a_ids == [n for n, _, _ in a] and row.b_ids == [n for n, _, _ in b]
        assert sorted(zip(row.a_links, row.b_links)) == sorted(links[row.doc_id])
        assert [a[k - 1][2] for k in row.a_ends] == [b[k - 1][2] for k in row.b_ends] == sorted({e for _, _, e in a} & {e for _, _, e in b})
    pairs = {(r.a_id, r.b_id): (r.n, r.best) for r in link_counts(frame, *models).collect()}
    assert {p: n for p, (n, _) in pairs.items()} == dict(counts)
    assert all(best == (n == max(m for (_, b), m in counts.items() if b == p[1])) for p, (n, best) in pairs.items())


def test_empty_table(spark, models):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert align(frame, *models).count() == 0 and alignment_digests(frame, *models).count() == 0


def test_registered_query_equals_brute_force(spark, tokens):
    small = "/root/testdata/sf0.001"
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = {r.doc_id: r for r in QUERIES["op11_tokenizer_alignment"](spark, small).collect()}
    assert len(found) == len(documents)
    for doc, text in documents:
        a, b = tokens(text)
        row = found[doc]
        ends = {e for _, _, e in a} | {e for _, _, e in b}
        common = {e for _, _, e in a} & {e for _, _, e in b}
        # Between any two neighbouring ends lies one link.
        assert (row.n_a, row.n_b, row.n_groups, row.n_links) == (len(a), len(b), len(common), len(ends))
