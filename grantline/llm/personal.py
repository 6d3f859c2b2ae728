"""Personal data in texts, by anchor expansion.

An Aho-Corasick automaton runs over a text once and finds anchors: at-signs, plus signs, digits, schemes
and words that announce an identifier.  At each anchor a small parser expands to the left and right as
far as its grammar goes, and validates what it has read (octets, checksums, numbers of digits).

Four kinds are the base; their parsers give the leftmost non-overlapping matches of fixed patterns, of
which the invalid ones are dropped without a second try.  The others are added by the method:

* ``mail``: e-mail addresses with letters beyond ASCII, which the base pattern misses or cuts;
* ``login``: URLs with a user name or password before the host;
* ``tel``: the number of a ``tel:`` link without a plus sign;
* ``iban``: account numbers announced as IBAN, with valid check digits;
* ``account``: numbers announced by a word such as account, passport or SSN.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from grantline.llm.secrets import rendered

KINDS = ["email", "ip", "card", "phone", "mail", "login", "tel", "iban", "account"]
N_BASE = 4
EMAIL, IP, CARD, PHONE, MAIL, LOGIN, TEL, IBAN, ACCOUNT = range(len(KINDS))

# What the base patterns read to the right of their anchors.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_OCTETS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_WIDE_DOMAIN = re.compile(r"(?:[^\W_]|-)+(?:\.(?:[^\W_]|-)+)*\.[^\W\d_]{2,}")
_AUTHORITY = re.compile(r"[^\s/?#\"<>\\]+")
_HOST = re.compile(r"(?:[\w.-]+|\[[0-9A-Fa-f:.]+\])(?::[0-9]+)?")
_TEL = re.compile(r"[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?:[\x20:.=#-]|nr|no)*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_NUMBERED = re.compile(
    r"(?:\x20?(?:number|num|no|nr|id|code))?[\x20:.=#-]{0,4}([A-Za-z]{0,3}[0-9](?:[\x20-]?[0-9]){5,18})(?![A-Za-z0-9])", re.I
)
#: Words that announce a number.
CUES = ["account", "acct", "passport", "ssn", "social security", "tax id", "konto", "compte", "cuenta"]
SPANS = ArrayType(
    StructType([StructField(c, IntegerType(), False) for c in ("start", "kind", "end")]), containsNull=False
)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(number: str) -> bool:
    odd = sum(map(int, number[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in number[-2::-2])) % 10 == 0


def _octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) < 4 and int(value or 0) <= 255


class _Reader:
    """The parsers of one text; ``done`` is, for each kind, where its last match ended, valid or not."""

    def __init__(self, text: str):
        self.text = text
        self.done = [0] * len(KINDS)
        self.found: list[tuple[int, int, int]] = []

    def add(self, start: int, kind: int, end: int, valid: bool = True) -> None:
        self.done[kind] = end
        if valid:
            self.found.append((start, kind, end))

    def at_sign(self, at: int) -> None:
        text, domain = self.text, _DOMAIN.match(self.text, at + 1)
        start = at
        while start > self.done[EMAIL] and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            self.add(start, EMAIL, domain.end())
        wide = _WIDE_DOMAIN.match(text, at + 1)
        if wide:
            first = at
            while first > self.done[MAIL] and (text[first - 1] in _LOCAL or text[first - 1] > "\x7f" and text[first - 1].isalnum()):
                first -= 1
            while first < at and text[first] in "._%+-":
                first += 1
            if first < at and not text[first : wide.end()].isascii():
                self.add(first, MAIL, wide.end())

    def digit(self, at: int) -> None:
        # The first digit of a run comes first, so every parser starts where its pattern would.
        if at >= self.done[IP]:
            chain = _OCTETS.match(self.text, at)
            parts = chain.group().split(".")
            start = at
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = start + sum(map(len, four)) + 3
                self.add(start, IP, end, all(map(_octet, four)))
                start = end + 1
            self.done[IP] = chain.end()
        if at >= self.done[CARD]:
            run = _CARD.match(self.text, at)
            if run:
                number = _digits(run.group())
                self.add(at, CARD, run.end(), 14 <= len(number) <= 19 and _luhn(number))

    def plus(self, at: int) -> None:
        number = _PHONE.match(self.text, at)
        if number:
            self.add(at, PHONE, number.end(), 10 <= len(_digits(number.group())) <= 15)

    def scheme(self, at: int) -> None:
        text, start = self.text, at - 2
        while start > self.done[LOGIN] and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "+.-"):
            start -= 1
        while start < at - 2 and not text[start].isalpha():
            start += 1
        authority = _AUTHORITY.match(text, at + 1)
        if start < at - 2 and authority and "@" in authority.group():
            user_end = authority.end() - len(authority.group().rpartition("@")[2]) - 1
            host = _HOST.match(text, user_end + 1)
            if host and user_end > at + 1:
                end = host.end()
                while text[end - 1] in ".-":
                    end -= 1
                self.add(start, LOGIN, end, end > user_end + 1)

    def tel(self, at: int) -> None:
        number = _TEL.match(self.text, at + 1)
        if number:
            self.add(at + 1, TEL, number.end(), 7 <= len(_digits(number.group())) <= 15)

    def iban(self, at: int) -> None:
        read = _IBAN.match(self.text, at + 1)
        if read:
            code = read.group(1).replace(" ", "")
            number = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
            self.add(read.start(1), IBAN, read.end(1), int(number) % 97 == 1)

    def cue(self, at: int) -> None:
        read = _NUMBERED.match(self.text, at + 1)
        if read and read.start(1) >= self.done[ACCOUNT]:
            self.add(read.start(1), ACCOUNT, read.end(1))


_PARSERS = {"@": "at_sign", "+": "plus", "://": "scheme", "tel:": "tel"} | {str(d): "digit" for d in range(10)}


@lru_cache(maxsize=1)
def _automaton():
    """The anchors, each with the name of its parser and the length of a cue (0: no word)."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for needle, parser in _PARSERS.items():
        automaton.add_word(needle, (parser, 0))
    for word, parser in [("iban", "iban"), *((cue, "cue") for cue in CUES)]:
        for cased in {word, word.upper(), word.capitalize(), word.title()}:
            automaton.add_word(cased, (parser, len(word)))
    automaton.make_automaton()
    return automaton


def personal_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the personal data in a text, by start and kind."""
    if not text:
        return []
    reader = _Reader(text)
    for at, (parser, word) in _automaton().iter(text):
        if word and (at >= word and text[at - word].isalnum() or text[at + 1 : at + 2].isalpha()):
            continue  # a cue inside a longer word
        getattr(reader, parser)(at)
    return sorted(reader.found)


def find_personal_data(documents: DataFrame, text_column: str = "text", out: str = "spans") -> DataFrame:
    """The documents with a column of spans: an array of (start, kind, end) by start and kind.

    ``kind`` is the place in ``KINDS``; a span is in code points, its end exclusive.  Null and empty texts
    have no spans; rows with null ids and repeated rows are scanned each; an empty table gives an empty one.
    A text is scanned whole, however long, in time proportional to its length.  Spans of different kinds may
    overlap; ties by start are in the order of ``KINDS``.  All other columns are kept; one named like the
    new column is replaced.  It is a map over rows: nothing is shuffled.
    """
    kept = [c for c in documents.columns if c != out]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = batch.slice(at, 256)
                offsets, flat = [0], []
                for text in rows.column(text_column):
                    flat += personal_spans(text.as_py())
                    offsets.append(len(flat))
                fields = [pa.array([span[k] for span in flat], pa.int32()) for k in range(3)]
                spans = pa.StructArray.from_arrays(
                    fields, fields=[pa.field(c, pa.int32(), False) for c in ("start", "kind", "end")]
                )
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), column], [*kept, out])

    schema = StructType([documents.schema[c] for c in kept] + [StructField(out, SPANS)])
    return documents.select(*kept).mapInArrow(scanned, schema)


def personal_digest(scanned: DataFrame) -> DataFrame:
    """Counts and hashes of the spans of each document."""

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < N_BASE)
    return scanned.select(
        "doc_id", *[count(kind) for kind in range(N_BASE)],
        F.sha2(rendered(base, KINDS), 256).alias("base_sha256"), rendered(F.col("spans"), KINDS).alias("spans"),
    )
