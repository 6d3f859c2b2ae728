"""The keyed joins against brute force over all pairs."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from grantline.functions.paths import glob_expression, is_searchable, path_pattern
from grantline.functions.search_keys import keys_of_url, path_keys
from grantline.operators import matching
from grantline.operators.matching import match_names, match_urls

FIXED_PATHS = [
    "s3://foo",
    "s3://foo/*",
    "s3://foo*",
    "s3://foo*/*",
    "s3://*",
    "s3://*/*",
    "s3://*-logs/*",
    "s3://*o*",
    "s3://a.b/*",
    "s3://fo?",
    "s3://fo?/*",
    "s3://f?o*",
    "s3://?oo",
    "s3://foo??",
    "s3://prod-*-logs/*",
    "s3://" + "x" * 70 + "/*",
    "s3://" + "x" * 63 + "*",
]
FIXED_URLS = [
    "s3://foo",
    "s3://foo/",
    "s3://foo2/x",
    "s3://fo",
    "s3://f",
    "s3://aXb/",
    "s3://a.b/c",
    "s3a://foo/",
    "s3://team-logs/a",
    "s3://team/x-logs/a",
    "s3://prod-eu-logs/",
    "s3://bar/s3://foo/x",
    "s3:/foo",
    "",
    "s3://",
    "s3://" + "x" * 70 + "/",
    "s3://" + "x" * 69 + "/",
]


def random_text(chooser, letters, size):
    return "".join(chooser.choice(letters) for _ in range(chooser.randint(1, size)))


def cases():
    chooser = random.Random(7)
    paths, urls = set(FIXED_PATHS), set(FIXED_URLS)
    while len(paths) < 150:
        tail = chooser.choice(["", "/*"])
        paths.add("s3://" + random_text(chooser, "aab.-**?", 9) + tail)
    while len(urls) < 150:
        urls.add("s3://" + random_text(chooser, "aabb.-/", 12))
    paths = {p for p in paths if not re.search(r"\?\?\?|\*\?\?", p)}
    return sorted(paths), sorted(urls)


def test_url_matches_equal_brute_force(spark, rows):
    paths, urls = cases()
    frame = spark.createDataFrame([(p,) for p in paths], "s3_path string")
    frame = frame.withColumn("s3_path_regex", path_pattern(F.col("s3_path")))
    texts = spark.createDataFrame([(u,) for u in urls], "url string")
    found = match_urls(frame, texts, "url").select("s3_path", "url").collect()
    expected = {
        (p, u) for p, u in itertools.product(paths, urls) if re.search(p.replace("*", ".*"), u)
    }
    assert len(found) == len(expected), "a pair was lost or found twice"
    assert {tuple(row) for row in found} == expected


def test_name_matches_equal_brute_force(spark):
    chooser = random.Random(8)
    globs = {"*", "foo", "foo*", "*foo", "f?o", "?", "a.b", "a+b", "*-logs", "a*b*c", "x" * 70}
    while len(globs) < 150:
        globs.add(random_text(chooser, "aab.-**?", 7))
    names = {"foo", "fo", "f.o", "a.b", "axb", "aab", "my-logs", "abc", "a-b-c", "x" * 70, "", "a+b"}
    while len(names) < 150:
        names.add(random_text(chooser, "aabb.-", 9))
    glob_frame = spark.createDataFrame([(g,) for g in sorted(globs)], "glob string")
    name_frame = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    found = match_names(glob_frame, name_frame, "glob", "name").select("glob", "name").collect()

    def matches(glob, name):
        body = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob)
        return re.fullmatch(body, name)

    expected = {(g, n) for g, n in itertools.product(globs, names) if matches(g, n)}
    assert len(found) == len(expected)
    assert {tuple(row) for row in found} == expected


@pytest.mark.parametrize(
    "path, searchable",
    [
        ("s3://a-b.c_d/*", True),
        ("s3://a?b??/*", True),
        ("s3://${aws:username}/*", False),
        ("s3://a[b]/*", False),
        ("s3://a???", False),
        ("s3://a*??", False),
        ("s3://a+b", False),
    ],
)
def test_searchable_paths(spark, path, searchable):
    frame = spark.createDataFrame([(path,)], "path string")
    assert frame.select(is_searchable(F.col("path"))).first()[0] is searchable


def test_glob_expression_quotes_everything_but_wildcards(spark):
    frame = spark.createDataFrame([("a.b*c?d+",)], "glob string")
    assert frame.select(glob_expression(F.col("glob"))).first()[0] == r"^a\.b.*c.d\+$"



def test_rarest_keys_leave_fewer_pairs_than_longest_runs(spark):
    """All paths share a long run that all URLs have; what tells them apart is short."""
    paths = spark.range(200).selectExpr(
        "concat('s3://*-shared-production-data-*', char(97 + id div 26), char(97 + id % 26), '7*') AS s3_path",
        "concat('s3://.*-shared-production-data-.*', char(97 + id div 26), char(97 + id % 26), '7.*') AS s3_path_regex",
    )
    urls = spark.range(500).selectExpr(
        "concat('s3://team', id, '-shared-production-data-', char(97 + id % 20), char(97 + id % 26), id % 10) AS url"
    )
    under = matching._found_under(urls, "url", keys_of_url)
    pairs = matching.pairs_by_key(paths, path_keys("s3_path"), under, "url").count()
    # Under the longest run, every path meets every URL.
    longest = paths.join(under.filter("search_key = '~-shared-'"), F.lit(True)).count()
    assert longest == 200 * 500
    matches = matching.match_urls(paths, urls, "url").count()
    assert 0 < matches <= pairs < longest / 50


def test_no_text_has_the_rarest_key_of_a_hopeless_pattern(spark):
    paths = spark.createDataFrame([("s3://*data*qq*", "s3://.*data.*qq.*")], "s3_path string, s3_path_regex string")
    urls = spark.createDataFrame([(f"s3://data-{n}",) for n in range(50)], "url string")
    under = matching._found_under(urls, "url", keys_of_url)
    assert matching.rarest_keys(paths, path_keys("s3_path"), under).first().search_key == "~qq"
    assert matching.pairs_by_key(paths, path_keys("s3_path"), under, "url").count() == 0
    assert matching.unmatched_urls(paths, urls, "url").count() == 1
