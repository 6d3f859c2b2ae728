"""Pattern joins: which path patterns match which texts.

The joins are equi-joins on the keys of ``grantline.functions.search_keys`` with the regular expression as
a residual condition.  Of its keys, a pattern is searched for under the one that the fewest texts have:
a frequency table of the keys in question is counted first.  Nothing is broadcast by hint and no pair
outside a shared key is ever formed; Spark picks a broadcast or a sort-merge join by the measured size of
the sides, and splits a hot key when both are large.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from grantline.functions.paths import glob_expression
from grantline.functions.search_keys import glob_keys, keys_of_name, keys_of_url, path_keys


def match_urls(paths: DataFrame, texts: DataFrame, url: str) -> DataFrame:
    """Paths whose pattern is found anywhere in the URL.

    ``paths`` has ``s3_path`` and ``s3_path_regex``, one row each.
    """
    found = pairs_by_key(paths, path_keys("s3_path"), _found_under(texts, url, keys_of_url), url)
    return found.filter(F.regexp_like(F.col(url), F.col("s3_path_regex"))).join(texts, url)


def unmatched_urls(paths: DataFrame, texts: DataFrame, url: str) -> DataFrame:
    """Paths whose pattern is found in no URL; the search for a path ends with the first hit."""
    under = _found_under(texts, url, keys_of_url)
    keyed = rarest_keys(paths, path_keys("s3_path"), under)
    under = under.withColumnRenamed("search_key", "key")
    hit = (F.col("search_key") == F.col("key")) & F.regexp_like(F.col(url), F.col("s3_path_regex"))
    return keyed.join(under, hit, "left_anti").drop("search_key")


def match_names(globs: DataFrame, names: DataFrame, glob: str, name: str) -> DataFrame:
    """Wildcard names that match the whole of a name."""
    found = pairs_by_key(globs, glob_keys(glob), _found_under(names, name, keys_of_name), name)
    return found.filter(F.regexp_like(F.col(name), glob_expression(F.col(glob)))).join(names, name)


def pairs_by_key(patterns: DataFrame, keys: Column, under: DataFrame, text: str) -> DataFrame:
    """The patterns with every distinct text that has their rarest key: all that the expression is tried on."""
    return rarest_keys(patterns, keys, under).join(under, "search_key").drop("search_key")


def rarest_keys(patterns: DataFrame, keys: Column, under: DataFrame) -> DataFrame:
    """The patterns with the ``search_key`` that the fewest texts have; of several, a longest one.

    Only keys that some pattern has are counted, which leaves little of the texts' keys to exchange.
    """
    candidates = patterns.withColumn("search_key", F.explode(keys))
    frequency = under.join(candidates.select("search_key"), "search_key", "left_semi").groupBy("search_key").agg(F.count("*").alias("n_texts"))
    place = F.struct(F.coalesce("n_texts", F.lit(0)).alias("n"), (-F.length("search_key")).alias("size"), "search_key")
    chosen = candidates.join(frequency, "search_key", "left").groupBy(*patterns.columns).agg(F.min(place).alias("place"))
    return chosen.select(*patterns.columns, "place.search_key")


def _found_under(texts: DataFrame, name: str, keys: Callable[[str], Column]) -> DataFrame:
    """The distinct texts under each of their keys; other columns are joined back to the matches."""
    wanted = texts.select(name).filter(F.col(name).isNotNull()).distinct()
    return wanted.withColumn("search_key", F.explode(keys(name)))
