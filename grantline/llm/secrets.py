"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Three patterns give the base spans.  The method adds runs of identifier characters that a model of
random strings explains better than a model of ordinary identifiers.  Both are first-order Markov
models over character classes (each letter of either case, digit and sign is a class), trained on
all strings that the base patterns label: random strings are the values that the patterns found, ordinary
identifiers the words of all documents, but for those with a part as long as the runs that are scored.  A run is added if its log-likelihood ratio
per transition is above a threshold.  Base spans divide a run, and its parts are scored each.

All of it is DataFrame expressions.  A text is first cut into parts of some thousand characters at places that
no match can cross, so that work grows with its length and not with the square of its matches.  Spans
are found by splitting a part at its matches: the lengths of the pieces between them and of the matches give the
places, in code points.
"""

import json

from pyspark.sql import Column, DataFrame, functions as F

from grantline.sinks.shared import stage

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]

#: Runs that are scored, and the signs of which they consist.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{%d,}"
SPAN = "array<struct<start: int, kind: int, end: int>>"

#: Characters of a part of a text, if it has a place to cut.
PART = 4000
#: Before a cut: a character that is in no match, or a space between two letters or digits, which only an equals sign or
#: a colon beside it could make part of one.
CUT = r"""(?:[^A-Za-z0-9+/_.=:"'\x20-]|(?<=[A-Za-z0-9])\x20(?=[A-Za-z0-9])|\z)"""


def _parts(text: Column) -> Column:
    """(part, at): the text, cut after the last place for it within ``PART`` characters, or else the next one."""
    pattern = f"(?s).{{0,{PART - 1}}}{CUT}|.+?{CUT}"
    state = "struct<at: int, found: array<struct<part: string, at: int>>>"

    def step(state: Column, part: Column) -> Column:
        grown = F.concat(state["found"], F.array(F.struct(part.alias("part"), state["at"].alias("at"))))
        return F.struct((state["at"] + F.char_length(part)).alias("at"), grown.alias("found"))

    parts = F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda part: part != "")
    return F.aggregate(parts, F.struct(F.lit(0), F.array()).cast(state), step, lambda state: state["found"])


def _moved(spans: Column, by: Column) -> Column:
    return F.transform(
        spans, lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"))
    )


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """The places of all matches; with ``least``, only those whose value has so many characters."""
    literal = F.lit(pattern)
    matches = F.regexp_extract_all(text, literal, F.lit(0))
    pieces = F.split(text, pattern, -1)
    # The state is the end of the match before and the spans so far.
    values = F.regexp_extract_all(text, literal, F.lit(value_group)) if value_group else matches
    zipped = F.arrays_zip(matches.alias("m"), values.alias("v"), F.slice(pieces, F.lit(1), F.size(matches)).alias("p"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + F.char_length(item["p"])
        end = start + F.char_length(item["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        grown = F.concat(state["found"], F.array(span))
        return F.struct(end.alias("at"), F.when(F.char_length(item["v"]) >= least, grown).otherwise(state["found"]).alias("found"))

    found = F.aggregate(zipped, empty, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, by start and kind.  A run of fewer than 24 hex digits, a key of
    fewer than 20 characters and a value of fewer than 6 do not count; the first two are left out by
    the pattern, as every match of the pattern without a minimum is a whole run."""
    return F.array_sort(
        F.concat(_spans(text, ASSIGN, 0, value_group=2, least=6), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    )


def _outside(runs: Column, base: Column, least_run: int) -> Column:
    """The parts of runs between base spans that have so many characters; base spans are ordered by start."""
    empty = F.array().cast(SPAN)

    def part(start: Column, run: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), run["kind"].alias("kind"), end.alias("end"))

    def parts(run: Column) -> Column:
        # The state is where the next part starts and the parts so far.
        def step(state: Column, span: Column) -> Column:
            grown = F.concat(state["found"], F.array(part(state["at"], run, span["start"])))
            return F.struct(
                F.greatest(state["at"], span["end"]).alias("at"),
                F.when(span["start"] - state["at"] >= least_run, grown).otherwise(state["found"]).alias("found"),
            )

        met = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
        rest = lambda s: F.when(
            run["end"] - s["at"] >= least_run, F.concat(s["found"], F.array(part(s["at"], run, run["end"])))
        ).otherwise(s["found"])
        return F.aggregate(met, F.struct(run["start"].alias("at"), empty.alias("found")), step, rest)

    return F.flatten(F.transform(runs, parts))


def _transitions(strings: DataFrame) -> DataFrame:
    """(first, second, n) over the characters of a column of strings."""
    codes = F.split("string", "")
    pairs = F.transform(
        F.sequence(F.lit(1), F.char_length("string") - 1),
        lambda i: F.struct(F.element_at(codes, i).alias("first"), F.element_at(codes, i + 1).alias("second")),
    )
    return (
        strings.where(F.char_length("string") > 1)
        .select(F.explode(pairs).alias("t")).groupBy("t.first", "t.second").agg(F.count(F.lit(1)).alias("n"))
    )


def markov_ratios(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """(pair, ratio): the log of how much likelier a transition is in random strings.

    Random strings have no preferred transitions, so their model starts from two counts for every pair
    of signs; that of identifiers starts from a tenth of a count.
    """
    spark = random.sparkSession
    signs = spark.createDataFrame([(c,) for c in ALPHABET], "sign string")
    every = signs.select(
        F.col("sign").alias("first"),
        F.explode(F.split(F.lit(ALPHABET), "")).alias("second"),
    )
    counts = every
    for name, strings in (("random", random), ("ordinary", ordinary)):
        counts = counts.join(_transitions(strings).withColumnRenamed("n", name), ["first", "second"], "left")
    counts = counts.select("first", "second", *[(F.coalesce(c, F.lit(0)) + start).alias(c) for c, start in (("random", 2.0), ("ordinary", 0.1))])
    totals = counts.groupBy("first").agg(F.sum("random").alias("all_random"), F.sum("ordinary").alias("all_ordinary"))
    ratio = F.log(F.col("random") / F.col("all_random")) - F.log(F.col("ordinary") / F.col("all_ordinary"))
    return counts.join(totals, "first").select(F.concat("first", "second").alias("pair"), ratio.alias("ratio"))


def _scanned(documents: DataFrame, least_run: int, threshold: float) -> DataFrame:
    """row (all columns but the text), text and ``parts``: the text in parts that no span crosses, with the spans of
    each, counted from its start."""
    ratios = stage(_fitted(documents, least_run))
    run = RUN % least_run
    # The model is one literal of the plan, with a number for every pair of signs.
    found = {row.pair: row.ratio for row in ratios.collect()}
    matrix = [round(found[a + b], 6) for a in ALPHABET for b in ALPHABET]
    table = F.from_json(F.lit(json.dumps(matrix)), "array<double>")

    def based(part: Column) -> Column:
        return F.struct(part["part"].alias("part"), part["at"].alias("at"), base_spans(part["part"]).alias("base"))

    def scored(part: Column) -> Column:
        text, base = part["part"], part["base"]
        random = F.filter(_outside(_spans(text, run, 3), base, least_run), lambda s: _mean_ratio(text, s, table) > threshold)
        # Most parts have no run at all.
        spans = F.when(text.rlike(run), F.array_sort(F.concat(base, random))).otherwise(base)
        return F.struct(text.alias("part"), part["at"].alias("at"), spans.alias("spans"))

    others = [c for c in documents.columns if c != "text"]
    scanned = documents.select(F.struct(*others).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return scanned.withColumn("parts", F.transform(_parts(F.col("text")), based)).withColumn("parts", F.transform("parts", scored))


def scan(
    documents: DataFrame,
    least_run: int = 20,
    threshold: float = 0.4,
) -> DataFrame:
    """doc_id, the text, and ``spans``: an array of (start, kind, end) by start and kind.

    ``kind`` is the place in ``KINDS``; a span is in code points, its end exclusive.  Null texts count as
    empty and have no spans; null doc_ids are scanned like others; repeated rows are scanned each; empty tables give empty
    ones.  Very long texts are worked on whole, part by part; only a stretch without a place to cut is one part at
    any length.  The models count the transitions of all documents and all pattern matches.  Other columns are
    kept; one named ``spans`` is replaced.
    """
    spans = F.flatten(F.transform("parts", lambda part: _moved(part["spans"], part["at"])))
    return _scanned(documents.drop("spans"), least_run, threshold).select("row.*", "text", spans.alias("spans"))


def without_secrets(documents: DataFrame, mark: str = "<secret>", least_run: int = 20, threshold: float = 0.4) -> DataFrame:
    """The documents with what ``scan`` finds replaced by a mark, part by part: work grows with the length of a text.
    Null texts become empty; all columns are kept."""
    text = F.array_join(F.transform("parts", lambda part: _marked(part["part"], part["spans"], mark)), "")
    return _scanned(documents, least_run, threshold).select("row.*", text.alias("text"))


def _mean_ratio(text: Column, span: Column, table: Column) -> Column:
    length = span["end"] - span["start"]
    # The state is the place of the character before in the alphabet, 0 at first, and the sum so far.
    start = F.struct(F.lit(0).alias("sign"), F.lit(0.0).alias("total"))

    def step(state: Column, character: Column) -> Column:
        sign = F.position(character, F.lit(ALPHABET))
        ratio = F.when(state["sign"] > 0, F.element_at(table, (state["sign"] - 1) * len(ALPHABET) + sign)).otherwise(F.lit(0.0))
        return F.struct(sign.alias("sign"), (state["total"] + ratio).alias("total"))

    signs = F.split(F.substr(text, span["start"] + 1, length), "")
    return F.aggregate(signs, start, step, lambda state: state["total"] / (length - 1))


def _fitted(documents: DataFrame, least_run: int) -> DataFrame:
    texts = documents.where("text IS NOT NULL").select("text")
    # Values that the patterns find, as random strings.
    values = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    random = (
        texts.where(F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}"))
        .select(F.explode(values).alias("string")).where(F.char_length("string") >= 16)
    )
    # Words, as identifiers; one with a part that could itself be an unlabelled secret is left out.
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("string"))
    ordinary = words.where(~F.col("string").rlike(f"[A-Za-z0-9]{{{least_run},}}"))
    return markov_ratios(random, ordinary)


def rendered(spans: Column, kinds: list[str] = KINDS) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and hashes of the spans of each document."""
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return scanned.select(
        "doc_id", *[count(kind) for kind in range(3)], F.sha2(rendered(base), 256).alias("base_sha256"),
        rendered(F.col("spans")).alias("spans"), count(3),
    )


def _marked(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark in place of every span, or of several that overlap."""
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.when(
            span["start"] >= state["at"],
            F.concat(state["out"], F.substr(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mark)),
        ).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), before.alias("out"))

    rest = lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.char_length(text) - s["at"]))
    return F.when(F.size(spans) > 0, F.aggregate(spans, empty, step, rest)).otherwise(text)


def redacted(scanned: DataFrame, mark: str = "<secret>") -> DataFrame:
    """Texts with ``spans`` of any operator, every span replaced by a mark; spans that overlap are replaced together."""
    return scanned.withColumn("text", _marked(F.col("text"), F.col("spans"), mark)).drop("spans")
