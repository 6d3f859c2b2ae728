"""Who reaches which storage location."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantline.fixed import URL_SCHEME
from grantline.functions.paths import bucket_name, is_glob, is_searchable, profile_name
from grantline.functions.text import escape, label
from grantline.operators.addresses import confused_labels, unique_labels
from grantline.operators.matching import match_names, match_urls, unmatched_urls
from grantline.operators.policies import distinct_paths
from grantline.operators.principals import grantee
from grantline.sinks.shared import stage

PRINCIPAL = [
    "principal_type",
    "principal_id",
    "principal_display_name",
    "email_value",
    "application_id",
]
HOLDERS_PER_PART = 20_000
LOCATION_GROUPS = 256
#: Tasks that words become rows in.
EXPANDING_TASKS = 128
SET = ["set_key", "set_check"]
LOCATION = ["ext_loc_name", "credential_name", "credential_id", "url", "created"]
GRANTEE = ["principal_display_name", "grantee"]
LOCATION_NAME = ["ext_loc_name", "created"]


def governance(profiles: DataFrame, profile_roles: DataFrame, role_counts: DataFrame) -> DataFrame:
    """Principals with each role that their profiles give them.

    Profiles without a role, or with none that has enough paths, keep one row with NULLs.
    """
    reached = profile_roles.join(role_counts, "role_name")
    return (
        profiles.withColumn("profile_name", profile_name(F.col("instance_profile_arn")))
        .join(reached, "profile_name", "left")
        .select(*PRINCIPAL, "instance_profile_arn", "role_name", "n_paths")
    )


def _holders(governance: DataFrame) -> DataFrame:
    return governance.filter(
        F.col("principal_display_name").isNotNull() & F.col("role_name").isNotNull()
    )


def governance_patterns(governance: DataFrame, path_lists: DataFrame) -> DataFrame:
    """Distinct paths of the roles that some named principal holds.

    The governance relation names only roles with enough paths.
    """
    held = _holders(governance).select("role_name").distinct()
    return distinct_paths(path_lists).join(held, "role_name")


def pattern_locations(patterns: DataFrame, locations: DataFrame, anchored: bool = False) -> DataFrame:
    """Pairs of distinct path and location.

    By default the path's pattern may match anywhere in the location's URL, so ``s3://a`` also
    matches ``s3://ab``.  ``anchored`` compares whole bucket names.
    """
    paths = patterns.select("s3_path", "s3_path_regex").distinct()
    if anchored:
        globs = paths.filter(is_glob(F.col("s3_path"))).select(
            "s3_path", bucket_name(F.col("s3_path")).alias("glob")
        )
        buckets = locations.withColumn("bucket_name", bucket_name(F.col("url")))
        return match_names(globs, buckets, "glob", "bucket_name").select("s3_path", *LOCATION)
    searchable = paths.filter(is_searchable(F.col("s3_path")))
    return match_urls(searchable, _searched(locations), "searched_url").select("s3_path", *LOCATION)


def _searched(locations: DataFrame) -> DataFrame:
    # A proposed location is a whole bucket, which a path with and one without ``/*`` both cover.
    url = F.when(F.col("created"), F.col("url")).otherwise(F.concat("url", F.lit("/")))
    return locations.withColumn("searched_url", url)


def uncovered_patterns(patterns: DataFrame, matches: DataFrame) -> DataFrame:
    """Paths without a match, where the matches are at hand."""
    return (
        patterns.select("s3_path", "s3_path_regex")
        .distinct()
        .filter(is_glob(F.col("s3_path")))
        .join(matches.select("s3_path").distinct(), "s3_path", "left_anti")
    )


def unregistered_patterns(patterns: DataFrame, locations: DataFrame) -> DataFrame:
    """Paths that no registered location matches, found without forming the matches.

    A path that cannot be searched for as an expression has none.
    """
    paths = patterns.select("s3_path", "s3_path_regex").distinct().filter(is_glob(F.col("s3_path")))
    searchable = is_searchable(F.col("s3_path"))
    unmatched = unmatched_urls(paths.filter(searchable), _searched(locations), "searched_url")
    return unmatched.unionByName(paths.filter(~searchable))


def unsearchable_paths(patterns: DataFrame) -> DataFrame:
    """Audit: paths that cannot be searched for as an expression; only whole names are compared."""
    return patterns.select("s3_path").distinct().filter(~is_searchable(F.col("s3_path")))


def proposed_locations(uncovered: DataFrame, buckets: DataFrame, credential_name: str) -> DataFrame:
    """Pairs of uncovered path and new location, one location per matching bucket."""
    globs = uncovered.select("s3_path", bucket_name(F.col("s3_path")).alias("glob"))
    return match_names(globs, buckets, "glob", "bucket_name").select(
        "s3_path",
        F.col("bucket_name").alias("ext_loc_name"),
        F.lit(credential_name).alias("credential_name"),
        F.lit("").alias("credential_id"),
        F.concat(F.lit(URL_SCHEME), "bucket_name").alias("url"),
        F.lit(False).alias("created"),
    )


def new_locations(proposals: DataFrame) -> DataFrame:
    return proposals.select(*LOCATION).distinct()


def role_locations(patterns: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct locations per role."""
    return (
        patterns.select("role_name", "s3_path")
        .distinct()
        .join(matches, "s3_path")
        .select("role_name", *LOCATION)
        .distinct()
    )


def reach(
    governance: DataFrame,
    role_locations: DataFrame,
    keys: list[str | Column],
    described: DataFrame | None = None,
) -> DataFrame:
    """Distinct locations per holder, where ``keys`` say who a holder is.

    ``described`` has further columns per holder, under the names of the keys; they are joined before the
    holders meet their locations.

    Locations depend on the set of roles only, and sets may be nearly as many as holders.  So locations are
    numbered without gaps, a role's locations are bits of 64-bit words, and the words of a set are united by
    ``bit_or``, a hash aggregate with map-side combine.  A set goes by two hashes of its roles, since the roles
    themselves, on each of its words, would be most of what is exchanged.  The holders are joined to the words
    of their set, and a word becomes rows last of all, in many tasks: it is words that are shuffled, and no rows
    are compared for duplicates.  A set that many principals hold is divided into parts of ``HOLDERS_PER_PART``, and its words
    are repeated for each, so one set is not one join key.  Columns of a location may be null.
    """
    role_set = F.sort_array(F.collect_set("role_name")).alias("role_set")
    holders = _holders(governance).groupBy(*keys).agg(role_set).withColumns(
        {"set_key": F.xxhash64("role_set"), "set_check": F.xxhash64(F.lit("set"), "role_set")}
    )
    sets = holders.groupBy(*SET, "role_set").agg(
        F.ceil(F.count("*") / F.lit(HOLDERS_PER_PART)).cast("int").alias("n_parts")
    )
    holders = holders.drop("role_set")
    if described is not None:
        holders = holders.join(described, [c for c in holders.columns if c not in SET])
    numbers = stage(location_numbers(role_locations))  # small, and known to be so when the joins are planned
    by_set = (
        set_words(sets, role_words(numbered_locations(role_locations, numbers)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        .drop("n_parts")
    )
    # Only the few large sets have parts; most holders are part 0 without meeting them.
    large = sets.filter("n_parts > 1").select(*SET, "n_parts")
    spread = F.pmod(F.xxhash64(*[c for c in holders.columns if c not in SET]), F.col("n_parts"))
    dealt = holders.join(large, SET, "left").withColumn("part", F.coalesce(spread, F.lit(0)).cast("int"))
    words = dealt.drop("n_parts").join(by_set, [*SET, "part"]).drop(*SET, "part")
    return _expanded(words, numbers)


def location_numbers(role_locations: DataFrame) -> DataFrame:
    """``location`` (a struct), and the word and bit that stand for it, once per location.

    Locations are ranked within ``LOCATION_GROUPS`` groups by hash, so no task numbers all of them.  A group
    goes on where the one before ends, so all words but the last have 64 locations.
    """
    located = _located(role_locations).select("location").distinct()
    located = located.withColumn("location_group", F.pmod(F.xxhash64("location"), F.lit(LOCATION_GROUPS)))
    rank = F.row_number().over(Window.partitionBy("location_group").orderBy("location")) - 1
    before = Window.orderBy("location_group").rowsBetween(Window.unboundedPreceding, -1)
    first = located.groupBy("location_group").agg(F.count("*").alias("n")).select(
        "location_group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    return located.withColumn("rank", rank).join(first, "location_group").select(
        "location", F.expr("(first + rank) div 64").alias("word"), F.expr("cast((first + rank) % 64 AS int)").alias("bit")
    )


def _located(role_locations: DataFrame) -> DataFrame:
    location = F.struct(*[c for c in role_locations.columns if c != "role_name"])
    return role_locations.select("role_name", location.alias("location"))


def numbered_locations(role_locations: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Role, ``location`` (a struct), and the word and bit that stand for the location."""
    if numbers is None:
        numbers = location_numbers(role_locations)
    return _located(role_locations).join(numbers, "location").select("role_name", "location", "word", "bit")


def role_words(numbered: DataFrame) -> DataFrame:
    """A role's locations as bits, one row per word that has any."""
    return numbered.groupBy("role_name", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def set_words(sets: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of ``sets`` with, for their ``role_set``, the united words of all roles in it."""
    keys = [c for c in sets.columns if c != "role_set"]
    return (
        sets.select(*keys, F.explode("role_set").alias("role_name"))
        .join(words, "role_name")
        .groupBy(*keys, "word")
        .agg(F.bit_or("bits").alias("bits"))
    )


def _expanded(words: DataFrame, numbers: DataFrame) -> DataFrame:
    """A row per set bit, with the columns of its location.

    Words are small next to the rows they become, so adaptive execution, which goes by bytes, would leave a
    few tasks to write all of these.  They are dealt to a fixed number of tasks, which it does not merge.
    """
    entries = numbers.groupBy("word").agg(F.collect_list(F.struct("bit", "location")).alias("entries"))
    kept = [c for c in words.columns if c not in ("word", "bits")]
    words = words.repartition(EXPANDING_TASKS, *kept, "word")
    chosen = F.expr("filter(entries, e -> (bits & shiftleft(1L, e.bit)) <> 0)")
    rows = words.join(entries, "word").select(*kept, F.explode(chosen).alias("entry"))
    return rows.select(*kept, "entry.location.*")


def location_access(governance: DataFrame, role_locations: DataFrame) -> DataFrame:
    """Locations that each principal reaches."""
    return reach(governance, role_locations, PRINCIPAL)


def grantee_names(governance: DataFrame) -> DataFrame:
    """Display name and grantee of every principal with a role."""
    return _holders(governance).select("principal_display_name", grantee().alias("grantee")).distinct()


def grantee_labels(grantees: DataFrame) -> DataFrame:
    """The grantees with a label each; namesakes are told apart."""
    return unique_labels(grantees, GRANTEE, label(F.col("principal_display_name")), "principal_label")


def location_labels(locations: DataFrame, principal_labels: DataFrame) -> DataFrame:
    """Locations by name, and whether they exist, with a label each, so that no two grants have one address."""
    names = locations.select(*LOCATION_NAME).na.drop()
    plain = label(F.col("ext_loc_name"))
    confused = confused_labels(principal_labels, "principal_label", names, LOCATION_NAME, plain)
    return unique_labels(names, LOCATION_NAME, plain, "ext_loc_label", confused)


def location_grants(
    governance: DataFrame, role_locations: DataFrame, principal_labels: DataFrame, labels: DataFrame
) -> DataFrame:
    """Locations to grant to each grantee; principals that share name and grantee are one.

    Labels and quoted texts are made beforehand, once per grantee and once per location, and not for
    each pair of them: see ``grantee_labels`` and ``location_labels``.
    """
    locations = role_locations.select("role_name", *LOCATION_NAME).join(labels, LOCATION_NAME)
    described = principal_labels.withColumn("grantee_text", escape(F.col("grantee")))
    return reach(governance, locations, ["principal_display_name", grantee().alias("grantee")], described)
