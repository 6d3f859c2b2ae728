"""ARNs, storage URLs and path patterns."""

from pyspark.sql import Column, functions as F

from grantline.fixed import (
    BUCKET_ARN_PATTERN,
    BUCKET_ARN_PREFIX,
    BUCKET_NAME_PATTERN,
    BUCKET_URL_PATTERN,
    PROFILE_ARN_PATTERN,
    URL_SCHEME,
)


def _group(value: Column, pattern: str) -> Column:
    """First capture group, NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(value, pattern, 1), F.lit(""))


def profile_name(arn: Column) -> Column:
    return _group(arn, PROFILE_ARN_PATTERN)


def names_bucket(resource: Column) -> Column:
    """A policy resource that is a whole bucket, or a bucket plus ``/*``."""
    return resource.startswith(BUCKET_ARN_PREFIX) & resource.rlike(BUCKET_ARN_PATTERN)


def path_of_resource(resource: Column) -> Column:
    return F.replace(resource, F.lit(BUCKET_ARN_PREFIX), F.lit(URL_SCHEME))


def path_pattern(path: Column) -> Column:
    """The path as a regular expression: ``*`` stands for any text."""
    return F.replace(path, F.lit("*"), F.lit(".*"))


def bucket_pattern(pattern: Column) -> Column:
    """The bucket part of a path pattern, with repeated wildcards collapsed."""
    bare = F.replace(F.replace(pattern, F.lit(URL_SCHEME), F.lit("")), F.lit("/"), F.lit(""))
    return F.replace(bare, F.lit(".*.*"), F.lit(".*"))


def bucket_url(url: Column) -> Column:
    return _group(url, BUCKET_URL_PATTERN)


def bucket_name(url: Column) -> Column:
    return _group(url, BUCKET_NAME_PATTERN)


def is_searchable(path: Column) -> Column:
    """False for a path that no bucket can have and that is no well-formed expression.

    Bucket names hold letters, digits, dots and dashes; a policy adds ``*`` and ``?``.  Brackets,
    policy variables and the like would be read as expression syntax, and so would three question
    marks in a row.
    """
    return ~path.rlike(r"[\\^$|(){}\[\]+]|\?\?\?|\*\?\?")


def is_glob(path: Column) -> Column:
    """Letters, digits and signs of bucket names, and the wildcards ``*`` and ``?`` in any number."""
    return ~path.rlike(r"[\\^$|(){}\[\]+]")


def glob_expression(glob: Column) -> Column:
    """Whole-text regular expression of a wildcard name; everything but ``*`` and ``?`` is literal."""
    literal = F.regexp_replace(glob, r"([^A-Za-z0-9*?])", r"\\$1")
    wild = F.replace(F.replace(literal, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.concat(F.lit("^"), wild, F.lit("$"))
