"""Equi-join keys for pattern matching.

A pattern can only match a text that holds the pattern's literal runs.  Each pattern has a number of
keys made from its runs, every one of which a matching text must have, and each text ALL keys it could be
found under.  So any single key of the pattern yields every true match; the join takes the one that the
fewest texts have (see ``grantline.operators.matching``), and a regular-expression join needs no nested
loop.  Three sorts of key exist:

``=name``   the pattern has no wildcard: the text itself
``^run``    the run the pattern starts with: a prefix of the text
``~gram``   1, 2, 4 or 8 characters of a run, as many as it has: any substring of the text

The functions take the name of a column.
"""

from pyspark.sql import Column, functions as F

from grantline.fixed import URL_SCHEME

PREFIX_LENGTH = 64
GRAM_LENGTHS = [8, 4, 2, 1]


def _keys_of_runs(runs: str) -> str:
    """The prefix and all grams of the runs; the empty prefix only where there is nothing else."""
    sizes = " ".join(
        f"WHEN length(r) >= {n} THEN transform(sequence(1, length(r) - {n - 1}), i -> concat('~', substring(r, i, {n})))"
        for n in GRAM_LENGTHS
    )
    grams = f"array_distinct(flatten(transform({runs}, r -> CASE {sizes} ELSE array() END)))"
    prefix = f"concat('^', left({runs}[0], {PREFIX_LENGTH}))"
    return f"if({runs}[0] = '' AND size({grams}) > 0, {grams}, concat(array({prefix}), {grams}))"


def path_keys(path: str) -> Column:
    """Keys of a path searched for anywhere in a URL, its dots read as "any character"."""
    body = f"substring({path}, {len(URL_SCHEME) + 1})"
    # A question mark makes the character before it optional, so that one is no literal either.
    return F.expr(_keys_of_runs(f"split({body}, '.?[?]|[.*]')"))


def glob_keys(glob: str) -> Column:
    """Keys of a wildcard name that has to match a whole text."""
    runs = f"split({glob}, '[*?]')"
    return F.expr(f"if({glob} RLIKE '[*?]', {_keys_of_runs(runs)}, array(concat('=', {glob})))")


def _prefix_keys(rest: str) -> str:
    return f"transform(sequence(0, length({rest})), n -> concat('^', left({rest}, n)))"


def _gram_keys(text: str) -> str:
    def grams(size: int) -> str:
        positions = f"sequence(1, greatest(length({text}) - {size - 1}, 1))"
        return (
            f"transform(filter({positions}, i -> length({text}) >= {size}),"
            f" i -> concat('~', substring({text}, i, {size})))"
        )

    return ", ".join(grams(size) for size in GRAM_LENGTHS)


def keys_of_url(url: str) -> Column:
    """All keys a URL can be found under by :func:`path_keys`."""
    scheme = len(URL_SCHEME)
    starts = f"""
        filter(sequence(1, greatest(length({url}) - {scheme - 1}, 1)),
               at -> substring({url}, at, {scheme}) = '{URL_SCHEME}')"""
    prefixes = _prefix_keys(f"substring({url}, at + {scheme}, {PREFIX_LENGTH})")
    return F.expr(f"""
        array_distinct(concat(
          array('^'), flatten(transform({starts}, at -> {prefixes})), {_gram_keys(url)}))""")


def keys_of_name(name: str) -> Column:
    """All keys a name can be found under by :func:`glob_keys`."""
    prefixes = _prefix_keys(f"left({name}, {PREFIX_LENGTH})")
    return F.expr(f"array_distinct(concat(array(concat('=', {name})), {prefixes}, {_gram_keys(name)}))")
