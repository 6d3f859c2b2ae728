"""Personal data against the fixed patterns, and the spans that the method adds."""

import hashlib
import random
import re

from grantline.llm.personal import KINDS, find_personal_data, personal_digest, personal_spans
from grantline.llm.secrets import redacted

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(part) > 255 for part in match[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((match.start(), order, match.end()))
    return sorted(found)


def texts():
    rng = random.Random(3)
    out = ["".join(rng.choices("a@.-+% 1é", k=rng.randint(0, 40))) for _ in range(4000)]
    out += ["".join(rng.choices("0123456789. -+()x", k=rng.randint(0, 60))) for _ in range(4000)]
    out += ["".join(rng.choices(["12", "255", ".", "0", "256", " "], k=20)) for _ in range(2000)]
    for _ in range(500):
        stem = "".join(rng.choices("0123456789", k=rng.randint(12, 19)))
        good = next(stem + d for d in "0123456789" if luhn(stem + d))
        out.append(f"pay {rng.choice([good, ' '.join(good), '-'.join(good), good + '1', 'x' + good + 'y', good + ' -'])} now 😀{good}")
    return out


def test_base_spans_equal_the_fixed_patterns():
    some = 0
    for text in texts():
        base = [span for span in personal_spans(text) if span[1] < 4]
        assert base == brute(text), text
        some += len(base)
    assert some > 1000


def added(text):
    return [(KINDS[kind], text[start:end]) for start, kind, end in personal_spans(text) if kind >= 4]


def test_added_spans():
    assert added("write to josé.pérez@correo-español.es, please") == [("mail", "josé.pérez@correo-español.es")]
    assert added("mail bob@example.com") == []
    assert added("see https://ann:pw1@db.example.com:8080/x and http://example.com/a@b") == [("login", "https://ann:pw1@db.example.com:8080")]
    assert added("tel:0301234567 or tel:+4930123456") == [("tel", "0301234567")]
    assert added("IBAN: DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("IBAN: DE88 3704 0044 0532 0130 00.") == []
    assert added("Account number: 12345678, SSN 078-05-1120; my accountant 12345678; account closed") == [
        ("account", "12345678"), ("account", "078-05-1120")]
    assert added("passport no. AB1234567 and xpassport 1234567") == [("account", "AB1234567")]


def test_operator_and_digest(spark, rows):
    table = [(1, None, 7), (2, "", 7), (3, "a@b.cd 10.0.0.1", 7), (3, "a@b.cd 10.0.0.1", 7), (None, "+1 (743) 555-3824", 7)]
    frame = spark.createDataFrame(table, "doc_id long, text string, spans int")
    found = find_personal_data(frame)
    assert found.columns == ["doc_id", "text", "spans"]
    empty = hashlib.sha256(b"").hexdigest()
    both = "email:0:6,ip:7:15"
    phone = "phone:0:17"
    assert rows(personal_digest(found)) == sorted([
        (1, 0, 0, 0, 0, empty, ""), (2, 0, 0, 0, 0, empty, ""),
        *[(3, 1, 1, 0, 0, hashlib.sha256(both.encode()).hexdigest(), both)] * 2,
        (None, 0, 0, 0, 1, hashlib.sha256(phone.encode()).hexdigest(), phone),
    ], key=repr)
    assert rows(redacted(found, "<pii>"), "text") == sorted([(None,), ("",), ("<pii> <pii>",), ("<pii> <pii>",), ("<pii>",)], key=repr)
    assert find_personal_data(frame.limit(0)).count() == 0


def test_long_and_dense_texts():
    text = "1.2.3.4 " * 50_000 + "x" * 1_000_000 + "@" * 20_000 + "a@b.c"
    spans = personal_spans(text)
    assert len([s for s in spans if s[1] == 1]) == 50_000 and spans[-1][1] == 0
    assert personal_spans("9" * 300_000) == []


def test_registered_query_equals_brute_force(spark):
    from grantline.llm.queries import QUERIES

    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    names = list(BASE)
    for row in QUERIES["op13_personal_data"](spark, small).collect():
        base = brute(texts[row.doc_id])
        joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(joined.split(",")) <= set(row.spans.split(","))
